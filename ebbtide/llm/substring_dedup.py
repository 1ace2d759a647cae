"""Substring deduplication with compressed FM-indexes over shards.

A window is ``WINDOW`` consecutive words. Each window has an anchor: the word
``GRAM``-gram with the smallest hash in it, the leftmost of equals. Equal
windows have equal anchors, so a document is cut into segments (maximal runs of
windows with one anchor) and only segments whose anchor occurs in two documents
or more can hold repeats. These go to the shard of their anchor. A shard's
distinct segments are indexed (suffix array, Burrows-Wheeler transform in a
wavelet matrix), documents' segments are streamed through it by backward search,
and the matching statistics give for every window that matches over the
threshold the smallest id of a document with it. A window is removed if that id
is smaller than its document's own.

Shards hold whole anchors, about ``SHARD_WORDS`` words. An anchor with over
``HOT_ROWS`` segments would make an unbounded shard: its windows are grouped by
the hash of the window itself instead, aggregated before the shuffle.

Null and empty texts have no words. Rows without an id take no part: nothing is
removed from them or for their sake. Rows with equal ids are no repeats of each
other. Columns other than id and text are not looked at. Words compare by
64-bit hashes, windows of hot anchors by 128-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.semijoin import bitmap
from .scratch import stored
from .words import SPACED, gram_hashes, mix, split, text_slices

WINDOW = 50
GRAM = 8
SHARD_WORDS = 1 << 18
HOT_ROWS = 1 << 15
#: Bits of the reducer that keeps documents without repeats out of the shuffles.
REDUCER_BITS = 1 << 24
_PLACE = np.uint64(26)  # bits of a word's place beside its hash: texts of up to 2 ** 26 words


class WaveletMatrix:
    """Ranks of symbols in a sequence, in packed bits with a count every 64."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n = len(symbols)
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            one = (symbols >> level) & 1 == 1
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            self.bits.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32))
            self.zeros.append(self.n - int(one.sum()))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def place(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the occurrences of each symbol before i end in the order of the last level."""
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            word = i >> 6
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where((symbol >> level) & 1 == 1, ones + self.zeros[k], i - ones)
        return i


class FMIndex:
    """An index of sequences of codes (1 and up); matches never reach over a sequence's end."""

    def __init__(self, sequences: list[np.ndarray], n_codes: int):
        sizes = np.array([len(s) for s in sequences], np.int64)
        n = int(sizes.sum()) + len(sequences)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(n, np.int64)  # 0 ends a sequence
        text[np.setdiff1d(np.arange(n), ends, assume_unique=True)] = np.concatenate(sequences) if len(sequences) else []
        self.n, self.sequence = n, np.repeat(np.arange(len(sequences)), sizes + 1)
        rank = text + len(sequences)
        rank[ends] = np.arange(len(sequences))  # every end is a symbol of its own
        #: Ranks of suffixes by their first 1, 2, 4 ... symbols.
        self.ranks = [rank.astype(np.int32)]
        self.order = np.zeros(0, np.int64)
        width = 1
        while True:
            later = np.zeros(n, np.int64)
            later[: n - width] = rank[width:] + 1 if width < n else 0
            key = rank * (int(rank.max(initial=0)) + n + 2) + later
            order = np.argsort(key)
            step = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], step[1:] != step[:-1]])) if n else []
            rank, width = new, width * 2
            self.ranks.append(rank.astype(np.int32))
            if n == 0 or rank.max() == n - 1:
                self.order = order
                break
        before = text[self.order - 1] if n else text
        self.wavelet = WaveletMatrix(before, n_codes + 1)
        codes = np.arange(n_codes + 1)
        starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_codes + 1))])
        self.base = starts[:-1] - self.wavelet.place(codes, np.zeros(n_codes + 1, np.int64))
        self._lcp: np.ndarray | None = None
        self._least: list[np.ndarray] = []

    def same(self, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
        """Whether the suffixes at i and j share their first ``length`` symbols."""
        ok, at = np.ones(len(i), bool), 0
        for k in range(len(self.ranks) - 1, -1, -1):
            while length - at >= 1 << k:
                inside = np.maximum(i, j) + at < self.n
                a, b = np.where(inside, i + at, 0), np.where(inside, j + at, 0)
                ok &= inside & (self.ranks[k][a] == self.ranks[k][b])
                at += 1 << k
        return ok

    @property
    def lcp(self) -> np.ndarray:
        """Common symbols of neighbours in the suffix order; 0 at both borders."""
        if self._lcp is None:
            i, j = self.order[:-1], self.order[1:]
            at = np.zeros(len(i), np.int64)
            for k in range(len(self.ranks) - 1, -1, -1):
                inside = np.maximum(i, j) + at < self.n
                a, b = np.where(inside, i + at, 0), np.where(inside, j + at, 0)
                at += np.where(inside & (self.ranks[k][a] == self.ranks[k][b]), 1 << k, 0)
            self._lcp = np.concatenate([[0], at, [0]])
            self._least = [self._lcp]
            while (1 << len(self._least)) <= self.n:
                half = 1 << (len(self._least) - 1)
                self._least.append(np.minimum(self._least[-1][:-half], self._least[-1][half:]))
        return self._lcp

    def _widen(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The whole interval of the first ``depth`` symbols of these intervals."""
        for k in range(len(self._least) - 1, -1, -1):
            step, least = 1 << k, self._least[k]
            at = low - step + 1  # lcp[low - step + 1 .. low] all reach the depth
            ok = (at > 0) & (least[np.clip(at, 0, len(least) - 1)] >= depth)
            low = np.where(ok, low - step, low)
            ok = (high + step <= self.n) & (least[np.clip(high, 0, len(least) - 1)] >= depth) & (high < self.n)
            high = np.where(ok, high + step, high)
        return low, high

    def matching_statistics(self, queries: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Backward search of all queries at once, one step from the right at a time.

        Yields (queries still read, their place, length of the longest match that
        starts there, and its suffix interval low, high). Codes that the index
        lacks are given as 0.
        """
        sizes = np.array([len(q) for q in queries], np.int64)
        first = np.cumsum(sizes) - sizes
        flat = np.concatenate(queries) if len(queries) else np.zeros(0, np.int64)
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.n)
        depth = np.zeros(len(queries), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero(sizes > step)
            code = flat[first[live] + sizes[live] - 1 - step]
            a, b, d = low[live], high[live], depth[live]
            na, nb, nd = np.zeros_like(a), np.full_like(b, self.n), np.zeros_like(d)
            todo = np.flatnonzero(code > 0)
            while len(todo):
                both = self.wavelet.place(np.tile(code[todo], 2), np.concatenate([a[todo], b[todo]])) + np.tile(self.base[code[todo]], 2)
                x, y = both[: len(todo)], both[len(todo) :]
                hit = x < y
                done = todo[hit]
                na[done], nb[done], nd[done] = x[hit], y[hit], d[done] + 1
                todo = todo[~hit & (d[todo] > 0)]
                if len(todo):  # no such extension: shorten the match to the enclosing interval
                    lcp = self.lcp
                    d[todo] = np.minimum(d[todo] - 1, np.maximum(lcp[a[todo]], lcp[b[todo]]))
                    a[todo], b[todo] = self._widen(a[todo], b[todo], d[todo])
            low[live], high[live], depth[live] = na, nb, nd
            yield live, sizes[live] - 1 - step, nd, na, nb


def smallest_holders(segments: list[np.ndarray], holders: np.ndarray, n_codes: int, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """For every window of every segment, the smallest holder of a segment with it.

    Returns a matrix (segment, window start), int64 maximum where there is none.
    """
    index = FMIndex(segments, n_codes)
    starts = max(0, max((len(s) for s in segments), default=0) - window + 1)
    out = np.full((len(segments), max(starts, 1)), np.iinfo(np.int64).max)
    order = index.order
    # suffixes that share a window are neighbours: the smallest holder of each such group
    new = np.concatenate([[True], ~index.same(order[:-1], order[1:], window)])
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(holders[index.sequence[order]], np.flatnonzero(new))
    for live, at, depth, low, _ in index.matching_statistics(segments):
        over = depth >= window
        out[live[over], at[over]] = least[group[low[over]]]
    return out, starts


def anchors(h: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of consecutive texts: text, anchor hash, first and last window start (by word over all texts)."""
    empty = np.zeros(0, np.int64)
    g = gram_hashes(h, gram)
    span = window - gram + 1
    if len(h) < window:
        return empty, empty.astype(np.uint64), empty, empty
    best = (mix(g) >> _PLACE << _PLACE) | np.arange(len(g), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[: len(g) - span + 1], best[span - width : len(g) - width + 1])
    at = (best & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
    n = np.diff(first)
    inside = np.zeros(len(h) + 1, np.int64)
    long = np.flatnonzero(n >= window)
    np.add.at(inside, first[long], 1)
    np.add.at(inside, first[long] + n[long] - window + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1])[: len(at)] > 0)
    if not len(starts):
        return empty, empty.astype(np.uint64), empty, empty
    text = np.searchsorted(first, starts, side="right") - 1
    new = np.concatenate([[True], (at[starts][1:] != at[starts][:-1]) | (text[1:] != text[:-1])])
    begin = np.flatnonzero(new)
    last = np.concatenate([begin[1:], [len(starts)]]) - 1
    return text[begin], g[at[starts[begin]]], starts[begin], starts[last]


def _cut(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc, fp, h, s, n): each document's anchors, first window starts, and numbers of further ones."""

    def run(batches):
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                words = split(data, at, SPACED)
                text, h, a, b = anchors(words.hashes(), words.first, window, gram)
                cuts = np.searchsorted(text, np.arange(rows.num_rows + 1)).astype(np.int32)
                lists = lambda x, kind, cuts=cuts: pa.ListArray.from_arrays(pa.array(cuts), pa.array(x, kind))
                yield pa.RecordBatch.from_pydict({
                    "doc": rows.column(0), "fp": rows.column(2),
                    "h": lists(h.view(np.int64), pa.int64()), "s": lists((a - words.first[text]).astype(np.int32), pa.int32()), "n": lists((b - a).astype(np.int32), pa.int32()),
                })

    return docs.mapInArrow(run, "doc bigint, fp bigint, h array<bigint>, s array<int>, n array<int>").filter("size(h) > 0")


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """(h, doc, fp, s, raw): the text of every segment listed in ``runs``."""

    def run(batches):
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                words = split(data, at, SPACED)
                out: dict[str, list] = {c: [] for c in ("h", "doc", "fp", "s", "raw")}
                for k, (doc, fp, runs) in enumerate(zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)):
                    w = int(words.first[k])
                    for r in runs:
                        a, b = w + r["s"], w + r["s"] + r["n"] + window - 1
                        out["h"].append(r["h"])
                        out["doc"].append(doc)
                        out["fp"].append(fp)
                        out["s"].append(r["s"])
                        out["raw"].append(data[words.start[a] : words.end[b]].tobytes())
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(out["h"], pa.int64()), "doc": pa.array(out["doc"], pa.int64()), "fp": pa.array(out["fp"], pa.int64()),
                    "s": pa.array(out["s"], pa.int32()), "raw": pa.array(out["raw"], pa.binary()),
                })

    return texts.mapInArrow(run, "h bigint, doc bigint, fp bigint, s int, raw binary")


def _shard(raw: list[bytes], doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment of a shard, the first and last removed window start (-1: none)."""
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(r, len(number)) for r in raw])
    data = np.frombuffer(b"".join(number), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(r) for r in number])])
    words = split(data, at, SPACED)
    distinct, codes = np.unique(words.hashes(), return_inverse=True)
    codes = codes + 1
    holders = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(holders, which, doc)
    segments = np.split(codes, words.first[1:-1])
    least, starts = smallest_holders(segments, holders, len(distinct), window)
    first, last = np.full(len(raw), -1), np.full(len(raw), -1)
    for a in range(0, len(raw), 1 << 14):
        gone = least[which[a : a + (1 << 14)]] < doc[a : a + (1 << 14), None]
        some = gone.any(axis=1)
        first[a : a + (1 << 14)] = np.where(some, gone.argmax(axis=1), -1)
        last[a : a + (1 << 14)] = np.where(some, starts - 1 - gone[:, ::-1].argmax(axis=1), -1)
    return first, last


def _indexed(segments: DataFrame, tasks: int, window: int, shard_words: int) -> DataFrame:
    """(doc, fp, a, b): word spans to remove, found shard by shard."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        doc, s = rows.column("doc").to_numpy(), rows.column("s").to_numpy().astype(np.int64)
        first, last = _shard(rows.column("raw").to_pylist(), doc, window)
        ok = np.flatnonzero(first >= 0)
        return pa.RecordBatch.from_pydict({
            "doc": pa.array(doc[ok]), "fp": pa.array(rows.column("fp").to_numpy()[ok]),
            "a": pa.array((s + first)[ok], pa.int64()), "b": pa.array((s + last)[ok] + window, pa.int64()),
        })

    def run(batches):
        held, size, at = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            width = np.diff(np.frombuffer(batch.column("raw").buffers()[1], np.int32)[batch.column("raw").offset :][: batch.num_rows + 1])
            cuts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)]])
            begin = 0
            for a, b in zip(cuts, cuts[1:], strict=False):
                if size >= shard_words and h[a] != at:
                    held.append(batch.slice(begin, a - begin))
                    yield flush(held)
                    held, size, begin = [], 0, a
                size += int(width[a:b].sum()) // 6 + 1
                at = h[a]
            held.append(batch.slice(begin))
        if held:
            yield flush(held)

    ordered = segments.repartition(tasks, "h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, "doc bigint, fp bigint, a bigint, b bigint")


def _hot_spans(texts: DataFrame, window: int) -> DataFrame:
    """(doc, fp, a, b) to remove in hot anchors' segments, by hashes of whole segments and whole windows.

    Equal segments are aggregated to one before their windows are taken apart;
    a document whose segment a smaller one has too loses all of it.
    """

    def run(batches):
        kinds = {"w1": pa.list_(pa.int64()), "w2": pa.list_(pa.int64())}
        for batch in batches:
            for rows, data, at in text_slices(batch, "text"):
                words = split(data, at, SPACED)
                h = words.hashes()
                one = gram_hashes(h, window)
                two = gram_hashes(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), window)
                out: dict[str, list] = {c: [] for c in ("k1", "k2", "doc", "fp", "s", "n", "w1", "w2")}
                for k, (doc, fp, runs) in enumerate(zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)):
                    for r in runs:
                        own = slice(words.first[k] + r["s"], words.first[k] + r["s"] + r["n"] + 1)
                        w1, w2 = one[own], two[own]
                        out["w1"].append(w1.view(np.int64)), out["w2"].append(w2.view(np.int64))
                        out["k1"].append(int(gram_hashes(w1, len(w1)).view(np.int64)[0])), out["k2"].append(int(gram_hashes(w2, len(w2)).view(np.int64)[0]))
                        out["doc"].append(doc), out["fp"].append(fp), out["s"].append(r["s"]), out["n"].append(r["n"])
                yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    rows = texts.mapInArrow(run, "k1 bigint, k2 bigint, doc bigint, fp bigint, s bigint, n bigint, w1 array<bigint>, w2 array<bigint>")
    segments = rows.groupBy("k1", "k2").agg(F.min("doc").alias("least"), F.first("w1").alias("w1"), F.first("w2").alias("w2"))
    windows = segments.select("k1", "k2", "least", F.posexplode(F.arrays_zip("w1", "w2")).alias("at", "w")).select("k1", "k2", "least", "at", "w.w1", "w.w2")
    held = windows.groupBy("w1", "w2").agg(F.min("least").alias("smallest"), F.max("least").alias("largest")).filter("smallest < largest")
    own = windows.join(held, ["w1", "w2"]).filter("smallest < least").groupBy("k1", "k2").agg(F.min("at").alias("x"), F.max("at").alias("y"))
    # windows between the first and the last removed one are covered by them: starts are less than a window apart
    gone = rows.select("k1", "k2", "doc", "fp", "s", "n").join(segments.select("k1", "k2", "least"), ["k1", "k2"]).join(own, ["k1", "k2"], "left")
    whole = F.col("doc") > F.col("least")
    return gone.filter(whole | F.col("x").isNotNull()).select(
        "doc", "fp",
        (F.col("s") + F.when(whole, 0).otherwise(F.col("x"))).alias("a"),
        (F.col("s") + F.when(whole, F.col("n")).otherwise(F.col("y")) + window).alias("b"),
    )


def _maybe(docs: DataFrame, mask: DataFrame) -> DataFrame:
    """``docs`` with a flag: false only for documents that are not among the mask's."""
    slot = F.pmod(F.xxhash64("doc"), F.lit(REDUCER_BITS))
    tagged = docs.withColumns({"_word": F.shiftright(slot, 6), "_pos": slot.bitwiseAND(63).cast("int")})
    met = tagged.join(F.broadcast(mask), "_word", "left")  # at most REDUCER_BITS / 64 rows
    bit = F.call_function("shiftright", F.col("_mask"), F.col("_pos")).bitwiseAND(1) == 1
    return met.withColumn("maybe", F.coalesce(bit, F.lit(False))).drop("_word", "_pos", "_mask")


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_rows: int = HOT_ROWS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc, fp, cuts): the word spans to remove of each document that has any; docs has doc, text, fp."""
    spark = docs.sparkSession
    known = docs.filter("doc is not null")
    cut = stored(_cut(known, window, gram), "anchors")
    by_anchor = cut.select("doc", F.explode("h").alias("h")).groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("c"))
    repeated = stored(by_anchor.filter("least < most").select("h", (F.col("c") > hot_rows).alias("hot")), "repeated")
    runs = cut.select("doc", "fp", F.explode(F.arrays_zip("h", "s", "n")).alias("x")).select("doc", "fp", "x.h", "x.s", "x.n").join(repeated, "h")
    grouped = runs.groupBy("doc", "fp").agg(
        F.collect_set(F.when(~F.col("hot"), F.struct("h", "s", "n"))).alias("runs"),
        F.collect_set(F.when(F.col("hot"), F.struct("h", "s", "n"))).alias("hot_runs"),
    )
    wanted = stored(grouped, "runs")
    near = _maybe(known, bitmap(wanted, "doc", REDUCER_BITS)).filter("maybe").drop("maybe")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = near.join(wanted.filter("size(runs) > 0").select("doc", "fp", "runs"), ["doc", "fp"]).select("doc", "text", "fp", "runs")
    found = _indexed(_segments(texts, window), tasks, window, shard_words)
    if not repeated.filter("hot").isEmpty():
        hot = near.join(wanted.filter("size(hot_runs) > 0").select("doc", "fp", "hot_runs"), ["doc", "fp"])
        found = found.unionByName(_hot_spans(hot.select("doc", "text", "fp", "hot_runs"), window))
    return found.groupBy("doc", "fp").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("cuts"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, **options) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and the kept words (joined by one space)."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("fp"))
    cuts = stored(spans(rows, **options), "cuts")

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "kept")}
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()  # bytes split at just these six characters
                n, kept, at = len(words), [], 0
                for c in own or ():
                    if c["b"] > at:
                        kept += words[at : max(at, c["a"])]
                        at = max(at, c["b"])
                kept = kept + words[at:] if at else words
                joined = b" ".join(kept)
                out["n_words"].append(n)
                out["n_removed"].append(n - len(kept))
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    out["kept"].append(joined.decode())
            kinds = {"kept_sha256": pa.string(), "kept": pa.string()}
            yield pa.RecordBatch.from_pydict({"doc": batch.column(0)} | {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items() if with_text or c != "kept"})

    flagged = _maybe(rows, bitmap(cuts, "doc", REDUCER_BITS))
    none = F.lit(None).cast("array<struct<a:bigint,b:bigint>>")
    apart = flagged.filter("not maybe").select("doc", "text", none.alias("cuts"))
    joined = flagged.filter("maybe").join(cuts, ["doc", "fp"], "left").select("doc", "text", "cuts")
    schema = f"doc bigint, n_words bigint, n_removed bigint, kept_sha256 string{', kept string' if with_text else ''}"
    done = apart.unionByName(joined).mapInArrow(run, schema)
    return done.select(F.col("doc").cast(kind).alias(id_col), *[c for c in done.columns if c != "doc"])
