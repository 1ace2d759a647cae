"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors link when their cosine is at least ``THRESHOLD``, that is when
their squared distance is at most 2 - 2 * THRESHOLD. Vectors are rotated (one
fixed random rotation for each dimension), and split into blocks of about
``BLOCK_DIM`` coordinates; every block gets a share of the squared distance in
proportion to its energy over all vectors. By the pigeonhole principle a
linking pair keeps within the share in at least one block, so range joins in
every block find all candidates; each is verified exactly, in double precision,
in the first block that has it, so that no pair counts twice.

A block's range join runs on a grid of its first two coordinates with cells of
twice the radius: a vector is at home in one cell and visits the neighbouring
cells that come later and lie within the radius. Homes of a cell are cut into
chunks of ``CHUNK``; a task holds one chunk and streams its visitors, so no
group is held whole. Pairs are never emitted: a task gives, for each vector, how
many it links with, and enough links to keep components whole.

Equal vectors are one from the start, with a count. Vectors that are null, zero
or hold null or non-finite components link with nothing, as do vectors of
different dimensions and rows without an id; rows with equal ids are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import stored

THRESHOLD = 0.9
BLOCK_DIM = 16
#: Homes of a cell that a task holds at once, and visitors compared with them at once.
CHUNK = 8192
TILE = 512
#: Cells are no narrower, which bounds their number.
MIN_CELL = 0.04


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> np.ndarray:
    n = max(1, dim // BLOCK_DIM)
    return np.linspace(0, dim, n + 1).astype(int)


class Layout:
    """Rotation, blocks, budgets and cells of one dimension."""

    def __init__(self, dim: int, energy: np.ndarray, limit: float):
        self.dim, self.turn, self.edges = dim, rotation(dim), block_edges(dim)
        share = energy / energy.sum() if energy.sum() > 0 else np.full(len(energy), 1.0 / len(energy))
        self.budget = limit * share * (1 + 1e-9) + 1e-12
        self.radius = np.sqrt(self.budget)
        self.cell = np.maximum(2 * self.radius, MIN_CELL)

    def turned(self, raw: list[bytes]) -> np.ndarray:
        """Rotated unit vectors, in double precision."""
        x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), self.dim)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
        return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))) @ self.turn

    def places(self, x: np.ndarray, b: int) -> np.ndarray:
        """The first two coordinates of a block (0 where it has one)."""
        own = x[:, self.edges[b] : min(self.edges[b] + 2, self.edges[b + 1])]
        return own if own.shape[1] == 2 else np.hstack([own, np.zeros((len(x), 1))])

    def homes(self, x: np.ndarray, b: int) -> np.ndarray:
        return np.floor(self.places(x, b) / self.cell[b]).astype(np.int64)

    def visits(self, x: np.ndarray, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows, and the later neighbouring cell that they may have partners in."""
        at, home = self.places(x, b), self.homes(x, b)
        low = at - home * self.cell[b]
        gap = {-1: low, 0: np.zeros_like(low), 1: self.cell[b] - low}
        for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1)):
            near = gap[dx][:, 0] ** 2 + gap[dy][:, 1] ** 2 <= self.budget[b] * (1 + 1e-9)
            rows = np.flatnonzero(near)
            if len(rows):
                yield rows, home[rows] + (dx, dy)

    def distance(self, x: np.ndarray, y: np.ndarray, b: int) -> np.ndarray:
        d = x[:, self.edges[b] : self.edges[b + 1]] - y[:, self.edges[b] : self.edges[b + 1]]
        return (d * d).sum(axis=1)


def _vectors(rows: DataFrame) -> DataFrame:
    """(id, raw): usable vectors as doubles."""

    def run(batches):
        for batch in batches:
            ids, raw = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False), strict=True):
                if i is None or v is None or not len(v):
                    continue
                x = np.array([np.nan if c is None else c for c in v], "<f8") if v.dtype == object else v.astype("<f8")
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    raw.append((x + 0.0).tobytes())
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "raw": pa.array(raw, pa.binary())})

    return rows.mapInArrow(run, "id bigint, raw binary")


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, list[int], list[bytes]]]:
    raw = batch.column("raw").to_pylist()
    dims: dict[int, list[int]] = {}
    for k, r in enumerate(raw):
        dims.setdefault(len(r) // 8, []).append(k)
    for dim, rows in dims.items():
        yield dim, rows, [raw[k] for k in rows]


def _layouts(distinct: DataFrame, limit: float) -> dict[int, Layout]:
    """A layout for each dimension, with the blocks' energies over all vectors."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, raw in _by_dim(batch):
                edges = block_edges(dim)
                plain = Layout(dim, np.ones(len(edges) - 1), 1.0)
                square = (plain.turned(raw) ** 2).sum(axis=0)
                total[dim] = total.get(dim, 0) + np.add.reduceat(square, edges[:-1])
        keys = list(total)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array([d for d in keys for _ in total[d]], pa.int32()),
            "block": pa.array([b for d in keys for b in range(len(total[d]))], pa.int32()),
            "e": pa.array([float(e) for d in keys for e in total[d]], pa.float64()),
        })

    summed = distinct.select("raw").mapInArrow(run, "dim int, block int, e double").groupBy("dim", "block").agg(F.sum("e").alias("e"))
    energy: dict[int, dict[int, float]] = {}
    for row in summed.collect():  # a row for each block of each dimension
        energy.setdefault(row.dim, {})[row.block] = row.e
    return {d: Layout(d, np.array([e[b] for b in sorted(e)]), limit) for d, e in energy.items()}


def _chunks(distinct: DataFrame, layouts, chunk: int) -> dict[tuple[int, int, int, int], int]:
    """Chunks of each cell that has more than one; the number of cells is bounded by MIN_CELL."""

    def run(batches):
        total: dict[tuple[int, int, int, int], int] = {}
        for batch in batches:
            for dim, _, raw in _by_dim(batch):
                layout = layouts.value[dim]
                x = layout.turned(raw)
                for b in range(len(layout.budget)):
                    cells, n = np.unique(layout.homes(x, b), axis=0, return_counts=True)
                    for (cx, cy), c in zip(cells.tolist(), n.tolist(), strict=True):
                        total[dim, b, cx, cy] = total.get((dim, b, cx, cy), 0) + c
        keys = list(total)
        columns = {c: pa.array([k[i] for k in keys], pa.int32()) for i, c in enumerate(("dim", "block", "cx", "cy"))}
        yield pa.RecordBatch.from_pydict(columns | {"n": pa.array([total[k] for k in keys], pa.int64())})

    counted = distinct.select("raw").mapInArrow(run, "dim int, block int, cx int, cy int, n bigint")
    full = counted.groupBy("dim", "block", "cx", "cy").agg(F.sum("n").alias("n")).filter(F.col("n") > chunk)
    return {(r.dim, r.block, r.cx, r.cy): -(-r.n // chunk) for r in full.collect()}


UNIT = ("dim", "block", "cx", "cy", "chunk")


def _placed(distinct: DataFrame, layouts, chunks) -> DataFrame:
    """Every vector at home in one chunk of its cell in every block, and as a visitor (role 1) where partners may be."""

    def run(batches):
        many = chunks.value
        for batch in batches:
            for dim, own, raw in _by_dim(batch):
                layout = layouts.value[dim]
                x = layout.turned(raw)
                own = np.array(own)
                for b in range(len(layout.budget)):
                    home = layout.homes(x, b)
                    k = np.array([many.get((dim, b, cx, cy), 1) for cx, cy in home.tolist()])
                    # the id decides the chunk, whatever batch or attempt brings the row
                    ids = batch.column("id").take(pa.array(own)).to_numpy()
                    mine = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % k
                    rows, cells, chunk, role = [np.arange(len(own))], [home], [mine], [np.zeros(len(own), np.int64)]

                    def visit(r, c, j, rows=rows, cells=cells, chunk=chunk, role=role):
                        rows.append(r), cells.append(c), chunk.append(j), role.append(np.ones(len(r), np.int64))

                    for j in range(1, int(k.max())):
                        later = np.flatnonzero((mine < j) & (j < k))
                        visit(later, home[later], np.full(len(later), j))
                    for r, c in layout.visits(x, b):
                        kc = np.array([many.get((dim, b, cx, cy), 1) for cx, cy in c.tolist()])
                        for j in range(int(kc.max())):
                            has = kc > j
                            visit(r[has], c[has], np.full(int(has.sum()), j))
                    r, c = np.concatenate(rows), np.concatenate(cells)
                    out = batch.take(pa.array(own[r]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(r), dim), pa.int32()), pa.array(np.full(len(r), b), pa.int32()), pa.array(c[:, 0], pa.int32()), pa.array(c[:, 1], pa.int32()),
                         pa.array(np.concatenate(chunk), pa.int32()), pa.array(np.concatenate(role), pa.int32()), *out.columns],
                        names=[*UNIT, "role", *out.schema.names],
                    )

    return distinct.select("id", "raw", "n").mapInArrow(run, "dim int, block int, cx int, cy int, chunk int, role int, id bigint, raw binary, n bigint")


class Unit:
    """A chunk of homes, what it has found, and the visitors as they come."""

    def __init__(self, layout: Layout, block: int, threshold: float):
        self.layout, self.block, self.threshold = layout, block, threshold
        self.ids = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.x = np.zeros((0, layout.dim))
        self.cut = slice(layout.edges[block], layout.edges[block + 1])
        #: Homes in the block's coordinates so that one product gives squared distances.
        self.sides = np.zeros((0, self.cut.stop - self.cut.start + 2), np.float32)
        self.links = np.zeros(0, np.int64)
        self.root = np.zeros(0, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []

    def add_homes(self, ids: np.ndarray, n: np.ndarray, x: np.ndarray) -> None:
        at = len(self.ids)
        self.ids, self.n, self.x = np.concatenate([self.ids, ids]), np.concatenate([self.n, n]), np.concatenate([self.x, x])
        own = x[:, self.cut].astype(np.float32)
        self.sides = np.concatenate([self.sides, np.hstack([-2 * own, np.ones((len(own), 1), np.float32), (own * own).sum(axis=1, keepdims=True)])])
        self.links = np.concatenate([self.links, np.zeros(len(ids), np.int64)])
        self.root = np.concatenate([self.root, np.arange(at, at + len(ids))])
        for a in range(at, len(self.ids), TILE):
            b = min(a + TILE, len(self.ids))
            self._meet(self.ids[a:b], self.n[a:b], self.x[a:b], a)

    def visit(self, ids: np.ndarray, n: np.ndarray, x: np.ndarray) -> None:
        for a in range(0, len(ids), TILE):
            self._meet(ids[a : a + TILE], n[a : a + TILE], x[a : a + TILE], None)

    def _meet(self, ids: np.ndarray, n: np.ndarray, x: np.ndarray, own: int | None) -> None:
        """Compares a tile with the homes (its own tile and those before it, if it is one of them)."""
        lay, b = self.layout, self.block
        until = len(self.ids) if own is None else own + len(ids)
        if not until:
            return
        v = x[:, self.cut].astype(np.float32)
        v = np.hstack([v, (v * v).sum(axis=1, keepdims=True), np.ones((len(v), 1), np.float32)])
        near = np.flatnonzero((v @ self.sides[:until].T).ravel() <= np.float32(lay.budget[b] + 1e-5))
        i, j = near // until, near % until
        if own is not None:
            below = j < i + own
            i, j = i[below], j[below]
        keep_i, keep_j = [], []
        for a in range(0, len(i), 1 << 16):
            p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
            ok = np.einsum("ij,ij->i", x[p], self.x[q]) >= self.threshold
            p, q = p[ok], q[ok]
            first = lay.distance(x[p], self.x[q], b) <= lay.budget[b]
            for c in range(b):
                first &= lay.distance(x[p], self.x[q], c) > lay.budget[c]
            keep_i.append(p[first])
            keep_j.append(q[first])
        i, j = np.concatenate([np.zeros(0, np.int64), *keep_i]), np.concatenate([np.zeros(0, np.int64), *keep_j])
        if len(i):
            self.links += np.bincount(j, weights=n[i], minlength=len(self.ids)).astype(np.int64)
            mine = np.bincount(i, weights=self.n[j], minlength=len(ids)).astype(np.int64)
            if own is None:
                self.counts.append((ids, mine))
            else:
                self.links[own:until] += mine
            self._merge(ids, i, j, own)

    def _merge(self, ids: np.ndarray, i: np.ndarray, j: np.ndarray, own: int | None) -> None:
        """Joins the homes' components through the tile, and notes only links that join something."""
        roots = self.root[j]
        if own is not None:
            left = self.root[i + own]
            pairs = np.unique(np.stack([left, roots], axis=1), axis=0)
            label = np.arange(len(self.ids))
            while True:
                low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
                after = label.copy()
                np.minimum.at(after, pairs[:, 0], low)
                np.minimum.at(after, pairs[:, 1], low)
                if (after == label).all():
                    break
                label = after
        else:
            pairs = np.unique(np.stack([i, roots], axis=1), axis=0)
            label = np.arange(len(self.ids))
            while True:
                mine = np.full(len(ids), len(self.ids))
                np.minimum.at(mine, pairs[:, 0], label[pairs[:, 1]])
                after = label.copy()
                np.minimum.at(after, pairs[:, 1], mine[pairs[:, 0]])
                if (after == label).all():
                    break
                label = after
            met = np.flatnonzero(mine < len(self.ids))
            self.edges.append((ids[met], self.ids[mine[met]]))
        moved = np.flatnonzero(label != np.arange(len(self.ids)))
        self.edges.append((self.ids[moved], self.ids[label[moved]]))
        self.root = label[self.root]

    def found(self) -> pa.RecordBatch:
        ids, n = (np.concatenate(c) for c in zip((self.ids, self.links), *self.counts, strict=True))
        some = n > 0
        a, b = (np.concatenate(c) for c in zip((np.zeros(0, np.int64),) * 2, *self.edges, strict=True))
        return pa.RecordBatch.from_pydict({
            "a": pa.array(np.concatenate([ids[some], a]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(b, pa.int64())]),
            "n": pa.concat_arrays([pa.array(n[some], pa.int64()), pa.nulls(len(a), pa.int64())]),
        })


def _joined(placed: DataFrame, layouts, threshold: float, tasks: int) -> DataFrame:
    """(a, b, n): numbers of links by vector (b null), and links that keep components whole (n null)."""

    def run(batches):
        at, unit = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in (*UNIT, "role")], axis=1)
            cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                key = tuple(keys[a, :5].tolist())
                if key != at:
                    if unit is not None:
                        yield unit.found()
                    at, unit = key, Unit(layouts.value[key[0]], key[1], threshold)
                part = batch.slice(a, b - a)
                ids, n = part.column("id").to_numpy(), part.column("n").to_numpy()
                x = unit.layout.turned(part.column("raw").to_pylist())
                (unit.visit if keys[a, 5] else unit.add_homes)(ids, n, x)
        if unit is not None:
            yield unit.found()

    ordered = placed.repartition(tasks, *UNIT).sortWithinPartitions(*UNIT, "role")
    return ordered.mapInArrow(run, "a bigint, b bigint, n bigint")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ids = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    usable = stored(_vectors(ids), "vectors")
    equal = usable.groupBy("raw").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    distinct = stored(equal, "distinct")
    layouts = spark.sparkContext.broadcast(_layouts(distinct, 2 - 2 * threshold))
    chunks = spark.sparkContext.broadcast(_chunks(distinct, layouts, chunk))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(_joined(_placed(distinct, layouts, chunks), layouts, threshold, tasks), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    roots = components(found.filter("b is not null"))
    same = distinct.select("raw", F.col("id").alias("rep"), "n")
    of = usable.join(same, "raw").select("id", "rep", "n")
    of = of.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    of = of.select("id", (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "rep").alias("root"))
    of = of.groupBy("id").agg(F.max("links").alias("links"), F.min("root").alias("root"))
    out = ids.select("id").join(of, "id", "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"), F.coalesce(F.col("id") == F.coalesce("root", "id"), F.lit(True)).alias("kept"),
    )
