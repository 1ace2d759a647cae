"""N-gram Jaccard join with rare-first prefix filtering.

A document's set holds its distinct shingles of ``K`` words (ASCII lower case);
two documents link when their sets' Jaccard similarity is at least
``PERCENT``/100. Shingles are ordered rare first by their counts over all
documents, kept in a fixed number of hashed counters (any total order gives
right results; the counts make it a good one). Two sets that link share a
shingle within their first n - ceil(t n) + 1, their prefixes; documents join on
these only. Candidates must pass the length filter, the positional filter (what
may still follow the shared shingle is enough) and the suffix filter (halving
both sets around a probe shingle) and a bound from their whole prefixes, and are
then verified once on whole texts. Where many sets share a shingle, the suffix
filter's idea comes first in a form that needs no sets: a set's parities over 512
hash ranges differ between two sets in no more ranges than they have shingles apart.

Documents with equal sets are one node from the start. A group of copies would
make pairs in the square of its size, so a shingle of over ``SMALL`` nodes pairs
them with ``HUBS`` of them at first, and of the hubs of its shingles a node meets
few: the one that it shares most with, and the first ones in some orders that all agree on. Shingles whose nodes are known to be in one
component through verified links are done, and the rest gets other hubs in the
next round, until the rest can be compared by parities at a bounded cost a row
(or after ``ROUNDS``): that is joined in full between nodes not known to be connected, so that no link between components is
missed.

Documents without words have no set and link with nothing; with fewer than
``K`` words the whole sequence is the one shingle. Null texts have no words.
Texts of any length are taken whole; a text's set is held in memory.
Rows with equal ids are rows of their own with the same id.
Rows without an id link like others, but are never the smallest id: in a
component without any id both component_id and class_id are null. Columns other than
id and text are not looked at. An empty table has an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.semijoin import bitmap, keep_members
from .components import components
from .scratch import stored
from .words import LOWER, SPACED, Words, gram_hashes, mix, split, text_slices

K = 5
PERCENT = 80
#: Counters of shingles are 2 ** COUNTER_BITS; they are summed in parts of PART.
COUNTER_BITS = 20
PART = 1 << 12
#: Bits of the reducer that keeps documents without candidates out of a shuffle.
REDUCER_BITS = 1 << 24
#: Shingles of so many nodes at most are joined in full at once; others get rounds of hubs.
SMALL = 16
#: Hash ranges whose parities bound how far two sets are apart, in 64-bit words.
PARITY_WORDS = 8
#: Hubs of a shingle in the first round and in later ones, where few nodes are left; links between
#: rounds within which nodes are known to be connected.
HUBS = 1
LATER_HUBS = 8
HOPS = 4
#: Rounds at most (the last joins in full). That is done before, but after ``STARS`` rounds of hubs, where
#: the pairs left to compare by parities are no more than these for each row at the start, and for one shingle.
ROUNDS = 5
STARS = 2
FULL_BELOW = 256
FULL_SHINGLE = 1 << 28
#: Pairs whose sets are held at once.
PAIRS = 256


def _grams(words: Words, k: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    h = words.hashes()
    g = gram_hashes(h, k)
    first = words.first.tolist()
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(g[a : b - k + 1]))
        elif b > a:
            out.append(gram_hashes(h[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _texts(batch: pa.RecordBatch, k: int):
    for rows, data, at in text_slices(batch, "text"):
        yield rows, _grams(split(data, at, SPACED, LOWER), k)


def _rarity(docs: DataFrame, k: int) -> np.ndarray:
    """Order of each counter: its logarithm, in 16 bits. 2 ** COUNTER_BITS of them."""
    size, shift = 1 << COUNTER_BITS, np.uint64(64 - COUNTER_BITS)

    def count(batches):
        n = np.zeros(size, np.int64)
        for batch in batches:
            for _, sets in _texts(batch, k):
                if sets:
                    n += np.bincount((np.concatenate(sets) >> shift).astype(np.int64), minlength=size)
        n = n.reshape(-1, PART)
        some = np.flatnonzero(n.any(axis=1))
        if len(some):
            yield pa.RecordBatch.from_pydict({"part": pa.array(some, pa.int32()), "n": pa.array([n[i].astype("<u4").tobytes() for i in some], pa.binary())})

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(n, "<u4").astype("<i8")
        if total:
            order = {p: np.minimum(np.log2(1.0 + x) * 1500, 65535).astype("<u2") for p, x in total.items()}
            yield pa.RecordBatch.from_pydict({"part": pa.array(list(order), pa.int32()), "o": pa.array([x.tobytes() for x in order.values()], pa.binary())})

    summed = docs.mapInArrow(count, "part int, n binary").repartition(16, "part").mapInArrow(add, "part int, o binary")
    out = np.zeros((size // PART, PART), np.uint16)
    for row in summed.collect():  # size / PART rows
        out[row.part] = np.frombuffer(row.o, "<u2")
    return out.reshape(-1)


def _fingerprint(shingles: np.ndarray) -> int:
    return int(mix(shingles).sum(dtype=np.uint64).astype(np.int64))


def parities(shingles: np.ndarray) -> np.ndarray:
    """Of each hash range, whether it holds an odd number of the set's shingles, as 64-bit words.

    A shingle that one of two sets has flips one bit, so the words of two sets differ
    in as many bits at most as the sets have shingles apart.
    """
    size = 64 * PARITY_WORDS
    odd = np.bincount((mix(shingles) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def describe(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc, key, n, node, check, prefix, parity): the set's size, two fingerprints, its rarest shingles and its parities."""
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(_rarity(docs.select("text"), k))  # 2 MB
    shift = np.uint64(64 - COUNTER_BITS)

    def run(batches):
        rank = order.value
        for batch in batches:
            for rows, sets in _texts(batch, k):
                n, node, check, prefix, parity = [], [], [], [], []
                for s in sets:
                    m = len(s)
                    n.append(m)
                    parity.append(parities(s))
                    node.append(_fingerprint(s))
                    check.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    token = (rank[s >> shift].astype(np.uint64) << np.uint64(48)) | (s & np.uint64((1 << 48) - 1))
                    token.sort()
                    prefix.append(token[: m - (m * percent + 99) // 100 + 1].view(np.int64) if m else token.view(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "doc": rows.column(0), "key": rows.column(2), "n": pa.array(n, pa.int32()), "node": pa.array(node, pa.int64()),
                    "check": pa.array(check, pa.int64()), "prefix": pa.array(prefix, pa.list_(pa.int64())), "parity": pa.array(parity, pa.list_(pa.int64())),
                })

    kind = dict(docs.dtypes)["doc"]
    return docs.mapInArrow(run, f"doc {kind}, key bigint, n int, node bigint, check bigint, prefix array<bigint>, parity array<bigint>")


def _alike(percent: int, na: str = "na", nb: str = "nb") -> str:
    return f"100L * least({na}, {nb}) >= {percent}L * greatest({na}, {nb})"


def _enough(percent: int) -> str:
    """Positional filter: what may follow suffices if this is the pair's first shared shingle (which every link passes)."""
    need = f"ceil({percent}.0 * (na + nb) / {100 + percent})"
    return f"1 + least(na - pa - 1, nb - pb - 1) >= {need}"


def _near(percent: int, x: str, y: str) -> str:
    """Whether the parities allow a link: differing bits against the shingles that two linked sets may have apart."""
    apart = " + ".join(f"bit_count({x}[{i}] ^ {y}[{i}])" for i in range(PARITY_WORDS))
    return f"{apart} <= na + nb - 2 * ceil({percent}.0 * (na + nb) / {100 + percent})"


def may_overlap(x: np.ndarray, y: np.ndarray, need: int, depth: int = 2) -> bool:
    """Suffix filter: bounds the overlap by halving both ascending sets around a probe."""
    return _bound(x, y, depth) >= need


def _bound(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    if depth == 0 or not len(x) or not len(y):
        return min(len(x), len(y))
    mid = len(y) // 2
    at = int(np.searchsorted(x, y[mid]))
    there = int(at < len(x) and x[at] == y[mid])
    return _bound(x[:at], y[:mid], depth - 1) + there + _bound(x[at + there :], y[mid + 1 :], depth - 1)


def _needed(nx: int, ny: int, percent: int) -> int:
    return -(-percent * (nx + ny) // (100 + percent))


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two ascending sets."""
    if not len(x) or not len(y):
        return 0
    at = np.searchsorted(x, y)
    return int((x[np.minimum(at, len(x) - 1)] == y).sum())


def prefixes_allow(x: np.ndarray, nx: int, y: np.ndarray, ny: int, percent: int) -> bool:
    """Bounds the overlap by the prefixes: exact up to where the first one ends, all of the rest beyond."""
    last = min(x[-1], y[-1])
    rx, ry = int(np.searchsorted(x, last, "right")), int(np.searchsorted(y, last, "right"))
    return _common(x[:rx], y[:ry]) + min(nx - rx, ny - ry) >= _needed(nx, ny, percent)


def _heads(described: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, prefix) of these nodes, once each."""
    mask = bitmap(nodes, "node", REDUCER_BITS)
    return keep_members(described.filter("n > 0").select("node", "n", "prefix"), mask, "node", REDUCER_BITS).dropDuplicates(["node"])


def _wanted_texts(docs: DataFrame, reps: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, text) of these nodes, from one document each."""
    wanted = stored(reps.join(nodes, "node").select("node", "key"), "wanted")
    mask = bitmap(wanted, "key", REDUCER_BITS)  # keys, not ids: documents without an id have one too
    texts = keep_members(docs.select("key", "text"), mask, "key", REDUCER_BITS).join(wanted, "key").select("node", "text")

    def run(batches):  # a document with an equal key but another text must not lend it to the node
        for batch in batches:
            for rows, sets in _texts(batch, k):
                own = pa.array([_fingerprint(s) for s in sets], pa.int64())
                yield rows.filter(pc.equal(rows.column(0), own))

    return texts.mapInArrow(run, "node bigint, text string").dropDuplicates(["node"])


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Pairs with these columns of both nodes."""
    x = table.select(F.col("node").alias("a"), *[F.col(c).alias(c + "_a") for c in columns])
    y = table.select(F.col("node").alias("b"), *[F.col(c).alias(c + "_b") for c in columns])
    return pairs.join(x, "a").join(y, "b")


def verify(pairs: DataFrame, docs: DataFrame, described: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: bounded by their prefixes, then verified on whole texts."""

    def bounded(batches):
        for batch in batches:
            na, nb = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            x, y = batch.column("prefix_a"), batch.column("prefix_b")
            ok = [
                prefixes_allow(x[i].values.to_numpy().view(np.uint64), na[i], y[i].values.to_numpy().view(np.uint64), nb[i], percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def checked(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, PAIRS):
                batch = whole.slice(at, PAIRS)
                x, y = ([s for _, sets in _texts(batch.select([c]).rename_columns(["text"]), k) for s in sets] for c in ("text_a", "text_b"))
                ok = []
                for s, t in zip(x, y, strict=True):
                    need = _needed(len(s), len(t), percent)
                    ok.append(may_overlap(s, t, need) and _common(s, t) >= need)
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    left = stored(_both(pairs, _heads(described, nodes), "n", "prefix").select("a", "b", "n_a", "n_b", "prefix_a", "prefix_b").mapInArrow(bounded, "a bigint, b bigint"), "bounded")
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _wanted_texts(docs, reps, nodes, k)
    return _both(left, texts, "text").select("a", "b", "text_a", "text_b").mapInArrow(checked, "a bigint, b bigint")


def _shared(described: DataFrame) -> DataFrame:
    """(token, node, n, pos, c) of prefix shingles that c > 1 nodes have.

    Of shingles with the same nodes, only the first in order is kept: it shows
    all their pairs, and is the first shared one of those where any of them is.
    """
    rows = described.filter("n > 0").select("node", F.col("n").cast("long").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    first = rows.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").select("token")
    packed = rows.select("token", "node", (F.shiftleft("n", 32) + F.col("pos")).alias("np"))  # size and place travel as one long
    found = stored(packed.join(first, "token").repartition("token", "node").dropDuplicates(["token", "node"]), "found")
    # The order of tokens is that of unsigned numbers: flip the sign to compare.
    order = F.expr("token ^ (-9223372036854775807L - 1L)")
    total = lambda seed: F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(38,0)"))
    who = found.groupBy("token").agg(F.count(F.lit(1)).alias("c"), total(1).alias("s1"), total(2).alias("s2"))
    kept = who.groupBy("c", "s1", "s2").agg(F.min_by("token", order).alias("token")).select("token", "c")
    out = found.join(kept, "token")
    return out.select("token", "node", F.shiftright("np", 32).alias("n"), F.expr("np & 4294967295").alias("pos"), "c")


def _star(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """Candidates between hubs of each token and its other nodes, of other components; a node meets few hubs."""
    place = F.struct("node", "n", "pos", "root", "parity")
    n = HUBS if turn == 0 else LATER_HUBS
    hubs = rows.groupBy("token").agg(*[F.min_by(place, F.xxhash64("node", F.lit(turn * LATER_HUBS + i))).alias(f"h{i}") for i in range(n)])
    hub = hubs.select("token", F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(n)]))).alias("h"))
    met = rows.join(hub, "token").filter("node <> h.node and root <> h.root")
    met = met.selectExpr("node", "h.node as hub", "n as na", "h.n as nb", "pos as pa", "h.pos as pb", "parity as x", "h.parity as y")
    met = met.filter(_alike(percent)).filter(_enough(percent)).filter(_near(percent, "x", "y"))
    shared = met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("shared"))
    orders = [F.xxhash64("hub", F.lit(turn * LATER_HUBS + i)) for i in range(n)]
    met = [F.max_by("hub", F.struct("shared", orders[0])), F.min_by("hub", F.xxhash64("hub", F.lit(-1 - turn))), *[F.min_by("hub", o) for o in orders]]
    each = shared.groupBy("node").agg(F.array_distinct(F.array(*met)).alias("hubs")).select("node", F.explode("hubs").alias("hub"))
    return each.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def _early(percent: int) -> str:
    """Whether a shingle stands early enough to be the first one shared with a set of the same size or more."""
    return f"pos < n - ceil({percent}.0 * 2 * n / {100 + percent}) + 1"


def _full(rows: DataFrame, percent: int) -> DataFrame:
    """All candidates between nodes of different components: early shingles of the smaller set meet all of larger ones."""
    parity = "parity" in rows.columns
    x = rows.filter(_early(percent)).selectExpr("token", "node as a", "n as na", "pos as pa", "root as ra", *["parity as x"] * parity)
    y = rows.selectExpr("token as token_b", "node as b", "n as nb", "pos as pb", "root as rb", *["parity as y"] * parity)
    near = f" and {_near(percent, 'x', 'y')}" if parity else ""
    met = x.join(y, F.expr(f"token = token_b and (na < nb or na = nb and a <> b) and ra <> rb and {_alike(percent)} and {_enough(percent)}{near}"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _pairable(rows: DataFrame, percent: int) -> DataFrame:
    """(token, work): shingles with nodes of different components of which one has it early; the pairs they may make."""
    by_root = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.expr(_early(percent))).alias("e"))
    wide = "cast({} as decimal(38,0)) * {}"
    per = by_root.groupBy("token").agg(F.sum("m").alias("m"), F.sum("e").alias("e"), F.sum(F.expr(wide.format("e", "m"))).alias("inner"), F.count(F.lit(1)).alias("roots"))
    return per.filter("roots > 1 and e > 0").select("token", F.expr(wide.format("e", "m") + " - inner").alias("work"))


def _labels(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node within HOPS links. Equal roots mean one component."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.unionAll(both.select("a", F.col("a").alias("b")))
    root = both.groupBy("a").agg(F.min("b").alias("root"))
    for _ in range(HOPS - 1):
        near = root.select(F.col("a").alias("b"), "root")
        root = both.join(near, "b").groupBy("a").agg(F.min("root").alias("root"))
    return root.withColumnRenamed("a", "node")


def linked(docs: DataFrame, described: DataFrame, reps: DataFrame, k: int, percent: int, rounds: int = ROUNDS, small: int = SMALL) -> DataFrame | None:
    """(node, root) of the nodes that have links, or None without any."""
    rows = _shared(described).withColumn("root", F.col("node"))
    early = rows.groupBy("token").agg(F.max(F.expr(_early(percent))).alias("early")).filter("early").select("token")
    rows = stored(rows.join(early, "token"), "shared")
    volume = rows.count()
    if not volume:
        return None
    tested = links = None
    # the nodes of shingles that many share carry their parities along
    wide = rows.filter(F.col("c") > small)
    mask = bitmap(wide, "node", REDUCER_BITS)
    parity = keep_members(described.filter("n > 0").select("node", "parity"), mask, "node", REDUCER_BITS).dropDuplicates(["node"])
    few, rows = rows.filter(F.col("c") <= small), stored(wide.join(parity, "node"), "wide")
    for turn in range(rounds + 1):
        pairs = _full(rows, percent) if turn == rounds else _star(rows, percent, turn)
        if turn == 0:
            pairs = pairs.unionAll(_full(few, percent))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(verify(pairs, docs, described, reps, k, percent), "links")
        links = found if links is None else links.unionAll(found)
        if turn == rounds:
            break
        # Shingles of one component are done.
        rows = rows.drop("root").join(_labels(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        left = stored(_pairable(rows, percent), "left")
        rows = stored(rows.join(left.select("token"), "token"), "rows")
        work = left.agg(F.sum("work").alias("all"), F.max("work").alias("most")).first()
        if work["all"] is None:
            break
        bounded = work["all"] <= FULL_BELOW * volume and work["most"] <= FULL_SHINGLE
        if (turn + 1 >= STARS and bounded) or turn + 2 >= rounds:
            rounds = turn + 1  # the next is the full join
        tested = pairs if tested is None else tested.unionAll(pairs)
    return stored(components(links), "roots")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Tells documents with equal ids apart by their texts."""
    return F.xxhash64(id_col, text_col)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT, rounds: int = ROUNDS, with_keys: bool = False
) -> DataFrame:
    """One row per document: id, n_shingles, component_id and class_id.

    component_id is the smallest id reachable by links, class_id the smallest id
    with an equal set; both are the own id for a document without a set. With
    keys, also row_key and component_key, the (smallest) row_key of a document
    with the component's smallest id in the component.
    """
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    described = stored(describe(docs, k, percent), "described")
    own = F.when(F.col("doc").isNotNull(), F.struct("doc", "key"))
    same = described.filter("n > 0").groupBy("node").agg(F.min(own).alias("own"), F.min("key").alias("any_key"), F.min("check").alias("low"), F.max("check").alias("high"))
    # Two different sets with one fingerprint would be wrong results: stop instead.
    doc = F.when(F.col("low") == F.col("high"), F.col("own.doc")).otherwise(F.raise_error(F.lit("two sets share a fingerprint")))
    reps = stored(same.select("node", doc.alias("doc"), F.coalesce("own.key", "any_key").alias("key")), "reps")
    roots = linked(docs, described, reps, k, percent, rounds)
    classes = reps.select("node", F.col("doc").alias("class_id"), "key")
    if roots is None:
        placed = classes.select("node", "class_id", F.col("class_id").alias("component_id"), F.col("key").alias("component_key"))
    else:
        of_node = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = of_node.groupBy("root").agg(F.min(F.when(F.col("class_id").isNotNull(), F.struct("class_id", "key"))).alias("least"))
        placed = of_node.join(least, "root").select("node", "class_id", F.col("least.class_id").alias("component_id"), F.col("least.key").alias("component_key"))
    out = described.select("doc", "key", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(placed, "node", "left")
    return out.select(
        F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"), F.coalesce("class_id", "doc").alias("class_id"),
        *([F.col("key").alias("row_key"), F.coalesce("component_key", "key").alias("component_key")] if with_keys else []),
    )
