"""Exact duplicates: the code, the exchange of fingerprints, and whole results against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbtide.llm import exact_dedup, golomb
from ebbtide.llm.classes import attach
from ebbtide.llm.scratch import ship

from .conftest import SCHEMA


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def brute(rows: list[tuple]) -> list[tuple]:
    """(id, keep_id, size, kept, sha), sorted; rows are (id, text)."""
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append((doc is None, doc or 0, i))
    out = []
    for text, members in groups.items():
        first = min(members)
        keep = None if first[0] else first[1]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(None if none else doc, keep, len(members), (none, doc, i) == first, sha) for none, doc, i in members]
    return sorted(out, key=repr)


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@given(st.sets(st.integers(0, 2**40 - 1), max_size=200), st.integers(0, 8))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip(values, shift):
    v = np.array(sorted(x >> shift for x in values), np.int64)
    v = np.unique(v)
    code = golomb.encode(v, 2**40 >> shift)
    assert golomb.decode(code, len(v), 2**40 >> shift).tolist() == v.tolist()


def test_a_code_is_shorter_than_its_values():
    v = np.unique(np.random.default_rng(3).integers(0, 2**48, 50_000))
    assert len(golomb.encode(v, 2**48)) * 8 / len(v) < np.log2(2**48 / len(v)) + 2


def test_edge_rows_equal_brute_force(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert result(exact_dedup.duplicates(edge_docs)) == brute(rows)


@pytest.mark.parametrize("bits", [1, 6, 48])
def test_texts_of_one_fingerprint_are_told_apart(spark, bits):
    """Few bits make nearly every text a suspect; short lists and small owners cut the exchange finely."""
    rows = [(i, f"text {i % 97}" + "  \n" * (i % 3)) for i in range(600)] + [(None, "text 5 "), (None, None), (7, ""), (None, " "), (None, "\t\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = exact_dedup.duplicates(docs, bits=bits, owner_rows=16, source_rows=50, filter_bits=1 << 10)
    assert result(got) == brute(rows)


def test_one_group_of_copies_holds_most_rows(spark):
    rows = [(i, "the same text in most rows" if i % 3 else f"own {i}") for i in range(3000)]
    got = exact_dedup.duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(11), owner_rows=64)
    assert result(got) == brute(rows)


def test_repeated_rows_leave_one(spark):
    rows = [(4, "again and again")] * 5 + [(None, "nobody")] * 3 + [(4, "other")]
    got = result(exact_dedup.duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)))
    assert got == brute(rows) and sum(r[3] for r in got) == 3


def test_text_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([("b", "x  y"), ("a", "x y"), ("c", None)], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.duplicates(docs).collect()} == {("a", "a", True), ("b", "a", False), ("c", "c", True)}
    empty = exact_dedup.duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1, "y"), (2, "a", "x", 2, "z")], "doc_id bigint, text string, sha string, fp int, body string")
    assert result(exact_dedup.duplicates(docs)) == brute([(1, "a"), (2, "a")])


def test_suspects_are_the_fingerprints_of_two_rows(spark):
    rows = [(int(x),) for x in np.random.default_rng(5).integers(0, 2**12, 2000)]
    marks = spark.createDataFrame(rows, "fp bigint").repartition(9)
    got = {r.fp for r in exact_dedup.suspects(marks, len(rows), bits=12, owner_rows=32, source_rows=100).collect()}
    seen = [r[0] for r in rows]
    assert got == {x for x in seen if seen.count(x) > 1}


def test_large_classes_are_joined_apart(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 2 = 0, 0, id) as k")
    classes = spark.createDataFrame([(0, 2500, "large"), (3, 1, "small")], "k bigint, n bigint, name string")
    got = {(r.id, r.name) for r in attach(rows, classes, ["k"], "n", 5000).collect()}
    assert got == {(i, "large" if i % 2 == 0 else "small" if i == 3 else None) for i in range(5000)}
