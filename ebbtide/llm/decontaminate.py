"""Benchmark decontamination as a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item (a shorter item is one
window). Its shingles (word trigrams) are ordered by rarity, counted over all
documents; since a window must be contained whole, its necessary prefix is its
rarest shingle. Documents join on these prefix shingles only. A match at word p
with the shingle at offset o of the window places the window at p - o: the
positional bound (not before the text's first word) and the length bound (all
of the window's words before its end) prune candidates, and the rest is
verified word by word.

The benchmark is taken in blocks of ``BLOCK_BYTES`` of text (an item is not cut), one
at a time: a block's windows take about 90 bytes a byte of text in the driver and in
each Python worker, some 100 MB, and three times that while they are made. Each block
is run against all documents, what it found is stored, and its broadcast destroyed
before the next is made; so memory stays bounded however large the benchmark is, and
the work is documents times blocks. Texts of any length are taken whole. Null and empty texts and items have no words and hit nothing; an
item without an id counts as ``null``; items with equal ids count once.
Repeated documents give repeated rows. Columns other than id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import drop_stored, stored
from .words import ALNUM, LOWER, Words, gram_hashes, split, text_slices

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 1 << 20


def _words(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for rows, data, at in text_slices(batch, column):
        yield rows, split(data, at, ALNUM, LOWER)


class Block:
    """The windows of some items, their shingles, and which shingle is the prefix of each."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE):
        self.window, self.shingle = window, shingle
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            words = bytes(LOWER[np.frombuffer(text.encode(), np.uint8)]).translate(_BLANK).split()
            for at in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[at : at + window]), set()).add(item)
        self.texts = list(found)
        self.items = [sorted(x) for x in found.values()]
        self.sizes = np.array([len(x) for x in self.texts], np.int64)
        #: Of each length of shingle: distinct shingle hashes, and (shingle, window, offset) of each place.
        self.places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        by: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.hashes: list[np.ndarray] = []
        for w, words in enumerate(self.texts):
            data = np.frombuffer(b" ".join(words), np.uint8)
            h = split(data, np.array([0, len(data)]), ALNUM).hashes()
            self.hashes.append(h)
            k = min(shingle, len(words))
            g = gram_hashes(h, k)
            by.setdefault(k, []).append((g, np.full(len(g), w), np.arange(len(g))))
        for k, rows in by.items():
            g, w, o = (np.concatenate(x) for x in zip(*rows, strict=True))
            distinct, index = np.unique(g, return_inverse=True)
            self.places[k] = (distinct, index, w, o)
        self.prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keeps of each window only its rarest shingle (of equals the first)."""
        for k, (distinct, index, w, o) in self.places.items():
            order = np.lexsort((o, counts[k][index], w))
            first = order[np.concatenate([[True], w[order][1:] != w[order][:-1]])]
            first = first[np.argsort(index[first], kind="stable")]
            used, at = np.unique(index[first], return_index=True)
            self.prefix[k] = (distinct[used], np.append(at, len(first)), w[first], o[first])
        self.places = {}


_BLANK = bytes(c if ALNUM[c] else 32 for c in range(256))


def _present(g: np.ndarray, sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``g`` whose hash is in the sorted ones, and where there."""
    bits = 20
    seen = np.zeros(1 << bits, bool)
    seen[sorted_hashes >> np.uint64(64 - bits)] = True
    at = np.flatnonzero(seen[g >> np.uint64(64 - bits)])
    where = np.searchsorted(sorted_hashes, g[at])
    ok = sorted_hashes[np.minimum(where, len(sorted_hashes) - 1)] == g[at]
    return at[ok], where[ok]


def _count(docs: DataFrame, block, text_col: str) -> DataFrame:
    """How often each shingle of the block occurs in the documents: (k, shingle, n)."""

    def run(batches):
        counts = {k: np.zeros(len(p[0]), np.int64) for k, p in block.value.places.items()}
        for batch in batches:
            for _, words in _words(batch, text_col):
                h = words.hashes()
                for k, (distinct, *_) in block.value.places.items():
                    _, where = _present(gram_hashes(h, k), distinct)
                    counts[k] += np.bincount(where, minlength=len(distinct))
        for k, n in counts.items():
            some = np.flatnonzero(n)
            if len(some):
                yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(some), k), pa.int32()), "shingle": pa.array(some, pa.int32()), "n": pa.array(n[some], pa.int64())})

    counted = docs.select(text_col).mapInArrow(run, "k int, shingle int, n bigint")
    return counted.groupBy("k", "shingle").agg(F.sum("n").alias("n"))


def _occurrences(words: Words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every verified occurrence."""
    h, text_of = words.hashes(), words.text_of()
    out_at, out_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (distinct, first, w, o) in block.prefix.items():
        at, where = _present(gram_hashes(h, k), distinct)
        n = first[where + 1] - first[where]
        rows = np.repeat(first[where], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start, window = np.repeat(at, n) - o[rows], w[rows]
        doc = text_of[np.repeat(at, n)]
        fits = (start >= words.first[doc]) & (start + block.sizes[window] <= words.first[doc + 1])
        start, window = start[fits], window[fits]
        ok = np.ones(len(start), bool)
        for j in range(int(block.sizes[window].max(initial=0))):
            live = np.flatnonzero(ok & (j < block.sizes[window]))
            ok[live] = h[start[live] + j] == block.flat[block.flat_at[window[live]] + j]
        keep = np.flatnonzero(ok)
        keep = [i for i in keep.tolist() if _same(words, int(start[i]), block.texts[window[i]])]
        out_at.append(start[keep])
        out_w.append(window[keep])
    return np.concatenate(out_at), np.concatenate(out_w)


def _same(words: Words, at: int, window: tuple[bytes, ...]) -> bool:
    return all(words.data[words.start[at + j] : words.end[at + j]].tobytes() == x for j, x in enumerate(window))


def blocks(spark: SparkSession, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    items, held = [], 0
    for row in rows.toLocalIterator():
        items.append((row.i, row.t))
        held += len(row.t)
        if held >= limit:
            yield Block(items)
            items, held = [], 0
    if items:
        yield Block(items)


def _prepared(source: DataFrame, benchmark: DataFrame, limit: int) -> Iterator:
    """The benchmark's blocks with their prefixes chosen over all of ``source``, broadcast."""
    sc = source.sparkSession.sparkContext
    for block in blocks(source.sparkSession, benchmark, limit=limit):
        sent = sc.broadcast(block)
        counts = {k: np.zeros(len(p[0]), np.int64) for k, p in block.places.items()}
        for row in _count(source, sent, "text").toLocalIterator():  # at most the block's shingles
            counts[row.k][row.shingle] = row.n
        sent.destroy()
        block.choose(counts)
        block.flat = np.concatenate([*block.hashes, np.zeros(0, np.uint64)])
        block.flat_at = np.cumsum(block.sizes) - block.sizes
        block.hashes = []
        yield sc.broadcast(block)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no window of any item."""

    def without(rows: DataFrame, block) -> DataFrame:
        def run(batches):
            for batch in batches:
                for some, words in _words(batch, text_col):
                    at, _ = _occurrences(words, block.value)
                    clean = np.ones(some.num_rows, bool)
                    clean[np.searchsorted(words.first, at, side="right") - 1] = False
                    yield some.filter(pa.array(clean))

        return rows.mapInArrow(run, docs.schema)

    kept, last, held = docs, None, None
    for block in _prepared(docs.select(F.col(text_col).alias("text")), benchmark, limit):
        if last is not None:  # one block in memory at a time
            kept = stored(without(kept, last), "clean")
            if held is not None:
                drop_stored(held)
            held = kept
            last.destroy()
        last = block
    return kept if last is None else without(kept, last)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans (word from, to), items.

    Spans are disjoint and ascending; items are distinct item ids as strings, sorted.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))
    schema = f"doc {kind}, n_words bigint, n_hit bigint, spans array<struct<a:bigint,b:bigint>>, items array<string>"
    found, last = [], None

    def hit(block) -> DataFrame:
        rows = _scan(source, block, schema, True).filter("n_hit > 0").select("doc", "fp", "spans", "items").dropDuplicates(["doc", "fp"])
        out = stored(rows, "hits")
        block.destroy()
        return out

    for block in _prepared(source, benchmark, limit):
        if last is not None:  # one block in memory at a time
            found.append(hit(last))
        last = block
    if last is None:
        empty = Block([])
        empty.flat, empty.flat_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return _scan(source, spark.sparkContext.broadcast(empty), schema)
    if not found:
        return _scan(source, last, schema)
    return _union(source, [*found, hit(last)], schema)


def _scan(source: DataFrame, block, schema: str, fingerprint: bool = False) -> DataFrame:
    def run(batches):
        b = block.value
        for batch in batches:
            for rows, words in _words(batch, "text"):
                n = np.diff(words.first)
                spans: list[list] = [[] for _ in n]
                items: list[list] = [[] for _ in n]
                n_hit = np.zeros(len(n), np.int64)
                if b.prefix:
                    at, w = _occurrences(words, b)
                    doc = np.searchsorted(words.first, at, side="right") - 1
                    cover = np.zeros(len(words.start) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + b.sizes[w], -1)
                    hit = np.cumsum(cover[:-1]) > 0
                    total = np.concatenate([[0], np.cumsum(hit)])
                    n_hit = total[words.first[1:]] - total[words.first[:-1]]
                    for d in np.unique(doc).tolist():
                        own = np.flatnonzero(np.diff(np.concatenate([[0], hit[words.first[d] : words.first[d + 1]].view(np.int8), [0]])))
                        spans[d] = [{"a": x, "b": y} for x, y in own.reshape(-1, 2).tolist()]
                    for d, x in zip(doc.tolist(), w.tolist(), strict=True):
                        items[d].append(x)
                    items = [sorted({i for x in xs for i in b.items[x]}) for xs in items]
                yield pa.RecordBatch.from_pydict({
                    "doc": rows.column(0), "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
                    "spans": pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    "items": pa.array(items, pa.list_(pa.string())),
                } | ({"fp": rows.column(2)} if fingerprint else {}))

    rows = source if fingerprint else source.select("doc", "text")
    return rows.mapInArrow(run, schema + (", fp string" if fingerprint else ""))


def _union(source: DataFrame, parts: list[DataFrame], schema: str) -> DataFrame:
    """Merges what each block found in a document; equal rows of documents count as one here."""
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    merged = (
        found.groupBy("doc", "fp")
        .agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .selectExpr(
            "doc as d", "fp as f", "items",
            """aggregate(s, cast(array() as array<struct<a:bigint,b:bigint>>), (o, x) -> case
                when size(o) = 0 or x.a > element_at(o, -1).b then concat(o, array(x))
                else concat(slice(o, 1, size(o) - 1), array(named_struct('a', element_at(o, -1).a, 'b', greatest(element_at(o, -1).b, x.b)))) end) as spans""",
        )
    )
    nothing = Block([])
    nothing.flat, nothing.flat_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    every = _scan(source, source.sparkSession.sparkContext.broadcast(nothing), schema, True).select("doc", "fp", "n_words")
    joined = every.join(merged, F.col("doc").eqNullSafe(F.col("d")) & F.col("fp").eqNullSafe(F.col("f")), "left")
    return joined.selectExpr(
        "doc", "n_words",
        "coalesce(aggregate(spans, 0L, (n, x) -> n + x.b - x.a), 0L) as n_hit",
        "coalesce(spans, cast(array() as array<struct<a:bigint,b:bigint>>)) as spans",
        "coalesce(items, cast(array() as array<string>)) as items",
    )


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """``hits`` with the number and digest of the items: one row per document."""
    return hits(docs, benchmark, id_col, text_col, limit).select(
        F.col("doc").alias(id_col), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )
