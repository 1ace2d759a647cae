"""Whitening of embeddings by a covariance weighted with multiplicities.

1. Entries become whole numbers x = floor(1024 c) + 100000, and equal x vectors one
   row with their number (aggregated before the shuffle).
2. Fit weights are these numbers (``weights="counts"``), or one for every distinct
   vector (``"one"``). Sums are exact; the covariance is a weighted GEMM of centred
   rows, a block of rows at a time, whose d x d results are added up by Spark.
3. The driver takes the eigenvectors of this one matrix.
4. Every distinct vector is whitened once and joined back to the rows that have it;
   vectors that hold a large share of all rows are broadcast to them.

What reaches the driver is d sums and d x d / 2 entries, whatever the number of rows.

Rows whose vector is null or empty, or holds null or non-finite entries, are left
out, and so are entries beyond ``LARGEST`` in size (their x could not be added up
exactly) and vectors of another length than most (of equal shares the longest).
Rows with equal ids or without one are rows of their own. Components whose
eigenvalue is zero up to rounding are not returned: equal vectors, or a single
one, give no rows, and neither does an empty table. Of equal eigenvalues the order
is that of the solver. Columns other than id and vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classes import attach
from .scratch import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000

#: Entries of larger size count as non-finite.
LARGEST = 2.0**31

#: Bytes of x vectors multiplied at once.
GEMM_BYTES = 8 << 20


def quantised(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, d, x): the rows that remain, with x as little-endian 64-bit integers."""

    def run(batches):
        for batch in batches:
            vectors = batch.column(1).cast(pa.large_list(pa.float64()))
            size = np.diff(vectors.offsets.to_numpy())
            c = vectors.flatten().to_numpy(zero_copy_only=False)  # null entries become NaN, null vectors have none
            held = vectors.is_valid().to_numpy(zero_copy_only=False)
            size = np.where(held, size, 0)
            bad = ~(np.abs(c) <= LARGEST)
            n_bad = np.diff(np.concatenate([[0], np.cumsum(bad)])[np.concatenate([[0], np.cumsum(size)])])
            x = (np.floor(SCALE * np.where(bad, 0, c)) + SHIFT).astype("<i8").tobytes()
            at = np.concatenate([[0], np.cumsum(size)]) * 8
            keep = np.flatnonzero((size > 0) & (n_bad == 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(keep)),
                pa.array(size[keep], pa.int32()),
                pa.array([x[at[i] : at[i + 1]] for i in keep.tolist()], pa.binary()),
            ], ["id", "d", "x"])

    named = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return named.mapInArrow(run, f"id {dict(named.dtypes)['id']}, d int, x binary")


@dataclass
class Fit:
    n: int  # rows in the fit list, with repeats
    total: list[int]  # exact sum of each dimension
    mean: np.ndarray
    values: np.ndarray  # the components' eigenvalues, falling
    vectors: np.ndarray  # d x components
    trace: float


def _matrices(batch: pa.RecordBatch, d: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """x and the counts of some rows of (x, count, ...) at a time."""
    step = max(1, GEMM_BYTES // (8 * d))
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        x = np.frombuffer(b"".join(part.column(0).to_pylist()), "<i8").reshape(-1, d)
        yield x, part.column(1).to_numpy(zero_copy_only=False), part


def _sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and the exact sums of all dimensions."""

    def run(batches):
        for batch in batches:
            for x, w, _ in _matrices(batch, d):
                # halves of 22 bits keep the products of a block within 64 bits for 2^40 rows a vector
                low, high = x & 0x3FFFFF, x >> 22
                whole = [int(a) + (int(b) << 22) for a, b in zip(w @ low, w @ high, strict=True)]
                yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(-1, d), pa.int32()), "s": pa.array([int(w.sum()), *whole], pa.decimal128(38, 0))})

    rows = distinct.select("x", "weight").mapInArrow(run, "pos int, s decimal(38,0)").groupBy("pos").agg(F.sum("s").alias("s"))
    got = {r.pos: int(r.s) for r in rows.collect()}  # d + 1 rows
    return got.get(-1, 0), [got.get(k, 0) for k in range(d)]


def _covariance(distinct: DataFrame, d: int, n: int, mean: np.ndarray) -> np.ndarray:
    """The weighted centred products of all rows, divided by ``n``."""
    upper = np.triu_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for x, w, _ in _matrices(batch, d):
                centred = x - mean
                total += (centred * w[:, None]).T @ centred
        yield pa.RecordBatch.from_pydict({"pos": pa.array(np.arange(len(upper[0])), pa.int32()), "s": pa.array(total[upper], pa.float64())})

    rows = distinct.select("x", "weight").mapInArrow(run, "pos int, s double").groupBy("pos").agg(F.sum("s").alias("s"))
    out = np.zeros((d, d))
    for r in rows.collect():  # d * (d + 1) / 2 rows
        out[upper[0][r.pos], upper[1][r.pos]] = out[upper[1][r.pos], upper[0][r.pos]] = r.s / n
    return out


def fit(distinct: DataFrame, d: int, components: int = COMPONENTS) -> Fit:
    """The components of ``distinct``: (x, weight) of vectors with ``d`` dimensions."""
    n, total = _sums(distinct, d)
    mean = np.array([s / n for s in total])
    cov = _covariance(distinct, d, n, mean)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    # eigenvalues this small are rounding: of the products, and of x in the mean
    floor = d * np.finfo(float).eps * max(float(values[-1]), float(np.abs(mean).max()))
    order = order[values[order] > floor]
    return Fit(n, total, mean, values[order], vectors[:, order], float(np.trace(cov)))


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    """The exact sum of (n * x - total)^2 for every row."""
    far = max((max(abs(n * int(a) - t), abs(n * int(b) - t)) for a, b, t in zip(x.min(0), x.max(0), total, strict=True)), default=0)
    if far * far * x.shape[1] < 2**63 and n * int(np.abs(x).max()) < 2**63:
        apart = n * x - np.array(total, np.int64)
        return (apart * apart).sum(1).tolist()
    # beyond 64 bits the same sum in Python's integers
    return [sum((n * v - t) ** 2 for v, t in zip(row, total, strict=True)) for row in x.tolist()]


def _whitened(distinct: DataFrame, d: int, model: Fit) -> DataFrame:
    """(key, count, weight, deviation, z): every distinct vector, whitened."""
    projection = model.vectors / np.sqrt(model.values)

    def run(batches):
        for batch in batches:
            for x, _, part in _matrices(batch, d):
                z = (x - model.mean) @ projection
                yield pa.RecordBatch.from_arrays([
                    part.column(2), part.column(3), part.column(1),
                    pa.array(_deviation(x, model.n, model.total), pa.decimal128(38, 0)),
                    pa.FixedSizeListArray.from_arrays(pa.array(z.ravel()), z.shape[1]).cast(pa.list_(pa.float64())),
                ], ["key", "count", "weight", "deviation", "z"])

    return distinct.select("x", "weight", "key", "count").mapInArrow(run, "key string, count bigint, weight bigint, deviation decimal(38,0), z array<double>")


def _identity_error(white: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of z's covariance minus the identity."""
    w = F.col("weight").cast("double")
    z = [F.col("z")[k] for k in range(components)]
    mean = white.agg(*[(F.sum(w * z[k]) / n).alias(f"m{k}") for k in range(components)]).first()
    apart = [z[k] - F.lit(mean[k]) for k in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    cov = white.agg(*[(F.sum(w * apart[a] * apart[b]) / n).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(cov, pairs, strict=True))


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """One row per remaining row and component: id, component, n, deviation, whitened, explained, identity_error.

    ``n`` is the length of the fit list; ``deviation`` is a whole decimal.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are 'counts' or 'one', not {weights!r}")
    source = quantised(rows, id_col, vec_col)
    kind = dict(source.dtypes)["id"]
    empty = rows.sparkSession.createDataFrame([], f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double").withColumnRenamed("id", id_col)
    groups = source.groupBy("d", "x").agg(F.count(F.lit(1)).alias("count"))
    groups = stored(groups.select("d", F.md5("x").alias("key"), "x", "count", (F.col("count") if weights == "counts" else F.lit(1).cast("bigint")).alias("weight")), "vectors")
    sizes = groups.groupBy("d").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        return empty
    distinct = groups.filter(F.col("d") == sizes.d)
    if distinct.groupBy("key").count().filter("count > 1").take(1):
        raise ValueError("two vectors share an MD5")
    model = fit(distinct, sizes.d, components)
    if not len(model.values):
        return empty
    white = stored(_whitened(distinct, sizes.d, model), "whitened")
    error = _identity_error(white, model.n, len(model.values))
    members = source.filter(F.col("d") == sizes.d).select("id", F.md5("x").alias("key"))
    joined = attach(members, white.drop("weight"), ["key"], "count", sizes.n)
    explained = F.array(*[F.lit(float(v) / model.trace) for v in model.values])
    return joined.select("id", "deviation", F.posexplode("z").alias("k", "whitened")).select(
        F.col("id").alias(id_col), (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", explained[F.col("k")].alias("explained"), F.lit(float(error)).alias("identity_error"))
