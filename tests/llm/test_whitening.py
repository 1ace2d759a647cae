"""Whitening against numpy over all rows, and the exact parts against Python's integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import queries, whitening
from ebbtide.llm.scratch import ship

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, key int, count int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], SCHEMA).repartition(5)


def quantise(v) -> list[int]:
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def brute(rows, components=8):
    """(n, deviation by row place, whitened (rows x components, any sign), explained)."""
    x = np.array([quantise(v) for _, v in rows], np.int64)
    n = len(x)
    total = [sum(col) for col in zip(*x.tolist(), strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x.tolist()]
    centred = x - x.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(df, rows, components=8, clean=None):
    """``rows`` are (id, vector) with distinct ids; ``clean`` those that remain."""
    got = df.collect()
    n, deviation, white, explained = brute(rows, components)
    assert len(got) == n * white.shape[1]
    by = {(r.vec_id, r.component): r for r in got}
    assert set(by) == {(i, k) for i, _ in rows for k in range(1, white.shape[1] + 1)}
    for k in range(white.shape[1]):
        own = np.array([by[i, k + 1].whitened for i, _ in rows])
        sign = np.sign(own @ white[:, k])
        np.testing.assert_allclose(own * sign, white[:, k], rtol=1e-6, atol=1e-8)
        assert all(by[i, k + 1].explained == pytest.approx(explained[k], rel=1e-9) for i, _ in rows)
    assert [int(by[i, 1].deviation) for i, _ in rows] == deviation
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    own = np.array([[by[i, k + 1].whitened for k in range(white.shape[1])] for i, _ in rows])
    own = own - own.mean(0)
    assert np.abs(own.T @ own / n - np.eye(white.shape[1])).max() < 1e-9


def vectors(seed, n, d):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(d, d)) * np.geomspace(3, 0.1, d)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(r.normal(size=(n, d)) @ mix)]


def test_equals_numpy_with_copies(spark):
    rows = vectors(1, 300, 12)
    rows += [(1000 + i, rows[i % 7][1]) for i in range(200)] + [(2000 + i, rows[0][1]) for i in range(300)]
    odd = [(3000, None), (3001, []), (3002, [float("nan")] * 12), (3003, [None] + [1.0] * 11), (3004, [float("inf")] + [0.0] * 11), (3005, [3e38] * 12), (3006, [1.0] * 5), (None, None)]
    df = whitening.whiten(frame(spark, rows + odd))
    check(df, rows)
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_fewer_dimensions_than_components(spark):
    rows = vectors(2, 60, 3)
    check(whitening.whiten(frame(spark, rows)), rows)


def test_zero_variance_gives_no_component(spark):
    same = [(i, [0.5, -0.25, 1e6]) for i in range(9)]
    assert whitening.whiten(frame(spark, same)).collect() == []
    assert whitening.whiten(frame(spark, same[:1])).collect() == []
    flat = [(i, [float(i % 5), 2.0, float(i % 5) * 2]) for i in range(40)]  # one direction only
    assert {r.component for r in whitening.whiten(frame(spark, flat)).collect()} == {1}
    assert whitening.whiten(frame(spark, [])).collect() == [] and whitening.whiten(frame(spark, [(1, None)])).collect() == []


def test_repeated_and_missing_ids_are_rows_of_their_own(spark):
    rows = vectors(3, 30, 4)
    twice = frame(spark, rows + [(5, rows[5][1]), (None, rows[6][1])])
    got = whitening.whiten(twice)
    assert got.count() == 32 * 4
    assert got.filter("vec_id = 5").count() == 8 and got.filter("vec_id is null").count() == 4
    assert got.groupBy("vec_id", "component").agg(F.count_distinct("whitened").alias("n")).filter("n > 1").count() == 0


def test_weights_of_one_fit_distinct_vectors(spark):
    rows = vectors(4, 80, 5)
    copies = [(500 + i, rows[0][1]) for i in range(400)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame(spark, rows + copies), weights="one").collect()}
    n, deviation, white, _ = brute(rows)
    for k in range(5):
        own = np.array([got[i, k + 1].whitened for i, _ in rows])
        np.testing.assert_allclose(own * np.sign(own @ white[:, k]), white[:, k], rtol=1e-6, atol=1e-8)
    assert {r.n for r in got.values()} == {n} and [int(got[i, 1].deviation) for i, _ in rows] == deviation
    assert len(got) == 480 * 5 and len({got[500 + i, 1].whitened for i in range(400)} | {got[0, 1].whitened}) == 1
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(frame(spark, rows), weights="two")


def test_deviations_beyond_64_bits_are_exact():
    r = np.random.default_rng(5)
    x = r.integers(0, 10**11, (4, 6))
    total = [int(v) for v in r.integers(0, 2**50, 6)]
    expected = [sum((10**9 * v - t) ** 2 for v, t in zip(row, total, strict=True)) for row in x.tolist()]
    assert whitening._deviation(x, 10**9, total) == expected and max(expected) > 2**64
    small = r.integers(99_000, 101_000, (50, 6))
    total = [int(v) for v in small.sum(0)]
    assert whitening._deviation(small, 50, total) == [sum((50 * v - t) ** 2 for v, t in zip(row, total, strict=True)) for row in small.tolist()]


def test_sums_of_large_counts_are_exact(spark):
    x = np.array([[2**41, -(2**41) + 3], [7, 100_001]], "<i8")
    counts = [2**38, 5]
    distinct = spark.createDataFrame([(bytearray(x[k].tobytes()), counts[k]) for k in range(2)], "x binary, weight bigint")
    n, total = whitening._sums(distinct, 2)
    assert (n, total) == (sum(counts), [sum(int(x[k, j]) * counts[k] for k in range(2)) for j in range(2)])


def test_the_whole_table(spark):
    """The registered query over all embeddings, with its long deviation."""
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    df = queries.all_queries()["op13_whitening"](spark, path)
    assert dict(df.dtypes)["deviation"] == "bigint"
    check(df, rows)
