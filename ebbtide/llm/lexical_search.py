"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items stand between blanks in one automaton, and a document is
scanned with every run of other characters as blanks, so that a match is a whole
word: the automaton counts each term's occurrences straight from the text, and
there is no index of the documents. A match leads to the items that hold the term.

The first scan counts the documents and words and the documents of each term; the
second scores every document for the items whose terms it holds and keeps a task's
best ``TOP`` of each item. These meet in two steps, by task group and then by item.

Items are taken in blocks (``BLOCK_BYTES`` of distinct terms, ``BLOCK_PAIRS`` pairs of
item and term; a larger item is a block of its own) that are broadcast one after
the other: an automaton takes some 60 bytes a term character in each Python worker.
All documents are scanned twice a block, so the work is documents times blocks. A
task's memory is bounded by the block and one text; texts of any length are whole.

Null and empty texts have no words and are not counted; nor do they score. Items
with equal ids are one item with the terms of all; one without terms has no rows.
Ids of documents are integers; of equal scores the smaller id comes first and a
document without id last. Repeated documents are ranked one by one. Empty tables
give an empty result. Columns other than ids and texts are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .scratch import drop_stored, stored
from .words import ALNUM, LOWER, split, text_slices

TOP = 50
BLOCK_BYTES = 1 << 20
BLOCK_PAIRS = 1 << 20
SALTS = 64

#: Matches and scored pairs handled at once in a task.
CHUNK = 1 << 20

#: Bytes of words in lower case, all others as blanks.
_SCAN = np.where(ALNUM[LOWER], LOWER, np.uint8(32)).astype(np.uint8)

_MATCH = np.dtype([("end", np.int64), ("term", np.int64)])


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms): the distinct terms of every item that has one, as UTF-8."""

    def run(batches):
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                words = split(data, at, ALNUM, LOWER)
                found = [words.data[a:b].tobytes() for a, b in zip(words.start, words.end, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(words.text_of())), pa.array(found, pa.binary())], ["item", "term"])

    named = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    pairs = named.mapInArrow(run, f"item {dict(named.dtypes)['item']}, term binary").distinct()
    return pairs.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))


class Block:
    """The terms of some items: an automaton, built where it is used, and the items of each term."""

    def __init__(self, items: list[tuple[object, list[bytes]]]):
        self.items = [i for i, _ in items]
        self.terms = sorted({t for _, terms in items for t in terms})
        at = {t: k for k, t in enumerate(self.terms)}
        term = np.array([at[t] for _, terms in items for t in terms], np.int64)
        item = np.repeat(np.arange(len(items)), [len(terms) for _, terms in items])
        order = np.argsort(term, kind="stable")
        self.item_of = item[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        #: Set between the scans.
        self.n_docs, self.n_words, self.weight = 0, 0, np.zeros(0, np.int64)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    @cached_property
    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, t in enumerate(self.terms):
            out.add_word(f" {t.decode('latin-1')} ", k)
        out.make_automaton()
        return out

    def weigh(self, n_docs: int, n_words: int, df: np.ndarray) -> None:
        self.n_docs, self.n_words = n_docs, n_words
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def counts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; and text, term and occurrences of all terms found, by text."""
        guarded = np.insert(_SCAN[data], at, 32)
        guards = at + np.arange(len(at))
        inside = guarded != 32
        n = np.diff(np.searchsorted(np.flatnonzero(inside[1:] & ~inside[:-1]), guards))
        matches = self.automaton.iter(guarded.tobytes().decode("latin-1"))
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(found := np.fromiter(islice(matches, CHUNK), _MATCH)):
            text = np.searchsorted(guards, found["end"]) - 1
            k, c = np.unique(text * len(self.terms) + found["term"], return_counts=True)
            keys.append(k)
            times.append(c)
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.zeros(len(key), np.int64)
        np.add.at(tf, where, np.concatenate(times))
        return n, key // len(self.terms), key % len(self.terms), tf

    def scores(self, n: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, item and score above 0, for all texts and items that share a term; a text in one piece."""
        m = np.array([50 + 50 * x * self.n_docs // self.n_words if x else 0 for x in n.tolist()], np.int64)
        share = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[text]))
        n_items = self.first[term + 1] - self.first[term]
        ends = np.cumsum(n_items)
        texts = np.flatnonzero(np.diff(text, prepend=-1))  # where each text's terms begin
        while len(texts):
            lo = texts[0]
            done = ends[lo] - n_items[lo]
            to = max(1, int(np.searchsorted(ends[np.append(texts[1:], len(text)) - 1], done + CHUNK, side="right")))
            hi = texts[to] if to < len(texts) else len(text)
            reps = n_items[lo:hi]
            rows = np.repeat(self.first[term[lo:hi]] - (ends[lo:hi] - reps - done), reps) + np.arange(reps.sum())
            key = np.repeat(text[lo:hi], reps) * len(self.items) + self.item_of[rows]
            order = np.argsort(key, kind="stable")
            key = key[order]
            begin = np.flatnonzero(np.diff(key, prepend=-1))
            score = np.add.reduceat(np.repeat(share[lo:hi], reps)[order], begin) if len(begin) else np.zeros(0, np.int64)
            some = score > 0
            yield key[begin][some] // len(self.items), key[begin][some] % len(self.items), score[some]
            texts = texts[to:]


class Best:
    """The best ``top`` documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top, self.limit = top, max(4 * n_items * top, CHUNK // 4)
        self.least = np.ones(n_items, np.int64)  # lower scores are out
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, item: np.ndarray, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        some = score >= self.least[item]
        self.parts.append((item[some], score[some], none[some], doc[some]))
        self.held += int(some.sum())
        if self.held > self.limit:
            self.best()

    def best(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 4
        item, score, none, doc = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.least[item[last]] = score[order][last]
        keep = order[rank < self.top]
        self.parts = [tuple(np.concatenate(x)[keep] for x in zip(*self.parts, strict=True))]
        self.held = len(keep)
        return self.parts[0]


def _blocks(terms: DataFrame, block_bytes: int, block_pairs: int) -> Iterator[Block]:
    """Blocks of the items of a stored table; one is held at a time."""
    items, size, pairs = [], 0, 0
    for row in terms.toLocalIterator():
        own = [bytes(t) for t in row.terms]
        own_size = sum(map(len, own))
        if items and (size + own_size > block_bytes or pairs + len(own) > block_pairs):
            yield Block(items)
            items, size, pairs = [], 0, 0
        items.append((row.item, own))
        size, pairs = size + own_size, pairs + len(own)
    if items:
        yield Block(items)


def _statistics(docs: DataFrame, sent) -> DataFrame:
    """(term, n): documents that hold each term; as term -1 documents with words, as -2 words."""

    def run(batches):
        block = sent.value
        df, n_docs, n_words = np.zeros(len(block.terms), np.int64), 0, 0
        for batch in batches:
            for _, data, at in text_slices(batch, "text"):
                n, _, term, _ = block.counts(data, at)
                df += np.bincount(term, minlength=len(df))
                n_docs, n_words = n_docs + int((n > 0).sum()), n_words + int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.concatenate([some, [-1, -2]]), pa.int64()), "n": pa.array(np.concatenate([df[some], [n_docs, n_words]]), pa.int64())})

    return docs.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _best(docs: DataFrame, sent, item_type, top: int) -> DataFrame:
    """(item, salt, doc, score): the best documents of each item in every partition."""
    item_arrow = to_arrow_type(item_type)

    def run(batches):
        block = sent.value
        best = Best(len(block.items), top)
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                ids = rows.column(0)
                none, doc = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
                n, text, term, tf = block.counts(data, at)
                for t, item, score in block.scores(n, text, term, tf):
                    best.add(item, score, none[t], doc[t])
        item, score, none, doc = best.best()
        salt = TaskContext.get().partitionId() % SALTS
        for a in range(0, len(item), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([
                pa.array([block.items[i] for i in item[part].tolist()], item_arrow),
                pa.array(np.full(len(item[part]), salt), pa.int32()),
                pa.array(doc[part], pa.int64(), mask=none[part].astype(bool)),
                pa.array(score[part], pa.int64()),
            ], ["item", "salt", "doc", "score"])

    return docs.select("doc", "text").mapInArrow(run, f"item {item_type.simpleString()}, salt int, doc bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Each item's ``top`` best documents: item, rank from 1, document, score."""
    sc = docs.sparkSession.sparkContext
    source = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    terms = stored(item_terms(items, item_col, item_text), "terms")
    item_type = terms.schema["item"].dataType
    found = docs.sparkSession.createDataFrame([], f"item {item_type.simpleString()}, salt int, doc bigint, score bigint")
    for block in _blocks(terms, block_bytes, block_pairs):
        sent = sc.broadcast(block)
        counted = {r.term: r.n for r in _statistics(source, sent).toLocalIterator()}  # at most the block's terms
        sent.destroy()
        if not counted.get(-2):
            break  # no document has a word
        block.weigh(counted[-1], counted[-2], np.array([counted.get(k, 0) for k in range(len(block.terms))]))
        sent = sc.broadcast(block)
        found = found.unionByName(stored(_best(source, sent, item_type, top), "best"))
        sent.destroy()
    drop_stored(terms)
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return found.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
