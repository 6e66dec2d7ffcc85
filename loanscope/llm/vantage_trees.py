"""Nearest neighbours by inner product with vantage-point trees per shard and relaxed triangle pruning.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) for the longest length M (0 for queries); Euclidean order is then the
order by inner product, and the triangle inequality holds. A vantage point splits its points into a near and a far half;
a half whose distance from the query, times `factor`, is more than the k-th best distance so far is not entered. Factor
one restores exact search, larger ones skip more. How much a factor loses depends on the data, so unless one is given, the
largest of a few that finds nearly all neighbours within the sample is taken.

A top tree over a bounded sample deals all vectors to regions, each cut into shards of bounded size by position, so that
a vector that a third of all rows repeat is spread. Each query starts with the k-th distance within the sample as its
bound and goes to the shards of the regions that the same rule does not rule out. A task builds the tree of a shard and
streams blocks of queries through it; a block walks the tree together, so that a leaf is one matrix product. The scores
of what may be among the nearest are then summed again, component by component in order, in doubles: they depend on
nothing but the two vectors, and equal vectors tie exactly.

Vectors that are null or zero, or have a null or non-finite component, rows without identifier, and vectors whose length
is not the table's most frequent one (the smaller of two) take no part. All rows with a query's identifier are its own;
of several vectors of one query identifier the smallest asks. Repeated rows are candidates of their own. Ties go to the
smaller identifier. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Factors tried on the sample, and the recall that the first one taken reaches there; else factor one.
FACTORS, RECALL = (2.0, 1.5, 1.25, 1.1, 1.05), 0.99
#: Sample vectors that are searched for in the sample to measure recall.
TRIALS = 128
#: Bytes of the sample that the top tree is fit on and that gives queries their first bound.
SAMPLE_BYTES = 2 << 20
#: Bytes of the vectors of a shard, as doubles.
SHARD_BYTES = 2 << 20
#: Sample vectors of a region at least.
REGION_SAMPLE = 16
LEAF = 256
#: Queries that walk a tree together, and pairs whose scores are summed again at a time.
BLOCK, PAIRS = 2048, 1 << 16
#: Rounding of matrix products, as a share of the largest value.
SLACK = 1e-9


@dataclass
class Node:
    """A vantage point with its two halves and the ranges of their distances, or a leaf with its members."""

    members: np.ndarray | None = None
    vantage: np.ndarray | None = None
    radius: float = 0.0
    near: Node | None = None
    far: Node | None = None
    near_range: tuple[float, float] = (0.0, 0.0)
    far_range: tuple[float, float] = (0.0, 0.0)


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the coordinate that makes all of them as long as the longest."""
    return np.hstack([x, np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0))[:, None]])


def distances(points: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    """Distances of lifted points (or queries, lifted with 0) from a lifted vantage point."""
    square = np.einsum("ij,ij->i", points, points) + vantage @ vantage - 2 * (points @ vantage)
    return np.sqrt(np.maximum(square, 0))


def build(points: np.ndarray, leaf: int = LEAF) -> Node:
    """A tree over lifted points; equal points stay in one leaf, however many."""
    root = Node(members=np.arange(len(points)))
    todo = [root]
    while todo:
        node = todo.pop()
        inside = node.members
        if len(inside) <= leaf:
            continue
        # of a few points evenly spread, the one whose distances vary most
        tried = inside[np.linspace(0, len(inside) - 1, 6).astype(int)]
        found = [distances(points[inside], points[t]) for t in tried]
        best = int(np.argmax([d.var() for d in found]))
        d, radius = found[best], float(np.median(found[best]))
        near = d <= radius
        if near.all():
            near = d < radius
            radius = float(d[near].max()) if near.any() else radius
        if not near.any():
            continue
        node.members, node.vantage, node.radius = None, points[tried[best]], radius
        node.near_range, node.far_range = (d[near].min(), d[near].max()), (d[~near].min(), d[~near].max())
        node.near, node.far = Node(members=inside[near]), Node(members=inside[~near])
        todo += [node.near, node.far]
    return root


def _gap(d: np.ndarray, span: tuple[float, float]) -> np.ndarray:
    """How far queries at distances d from a vantage point are from all points whose distances lie in `span`, at least."""
    return np.maximum(np.maximum(span[0] - d, d - span[1]), 0)


class Search:
    """The k nearest of a shard for a block of queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, tree: Node, longest: float, k: int, factor: float) -> None:
        self.ids, self.x, self.tree, self.longest, self.k, self.factor = ids, x, tree, longest, k, factor
        self.x_columns, self.scanned = np.ascontiguousarray(x.T), 0

    def run(self, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the query, identifier, score) of what may be among the nearest; `bound` is a distance per query."""
        n = len(q)
        self.columns = np.ascontiguousarray(q.T)
        self.q, self.query_ids, self.lift = q, query_ids, np.hstack([q, np.zeros((n, 1))])
        self.size = np.einsum("ij,ij->i", q, q) + self.longest
        self.slack = SLACK * self.size
        with np.errstate(invalid="ignore"):
            self.least = np.where(np.isfinite(bound), (self.size - bound**2) / 2 - self.slack, -np.inf)
        self.scores, self.found = np.full((n, self.k), -np.inf), np.zeros((n, self.k), np.int64)
        if len(self.ids):
            self._visit(self.tree, np.arange(n))
        row, place = np.nonzero(np.isfinite(self.scores))
        return row, self.found[row, place], self.scores[row, place]

    def _bound(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return np.sqrt(np.maximum(self.size[rows] - 2 * self.least[rows], 0))

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if node.members is not None:
            for at in range(0, len(node.members), LEAF):
                self._scan(rows, node.members[at:at + LEAF])
            return
        d = distances(self.lift[rows], node.vantage)
        near, far = _gap(d, node.near_range), _gap(d, node.far_range)
        first = (near < far) | ((near == far) & (d <= node.radius))
        for mine, one, gap_one, other, gap_other in ((first, node.near, near, node.far, far), (~first, node.far, far, node.near, near)):
            some = rows[mine]
            for half, gap in ((one, gap_one[mine]), (other, gap_other[mine])):
                rough = np.sqrt(self.slack[some])
                self._visit(half, some[(gap - rough) * self.factor <= self._bound(some)])

    def _scan(self, rows: np.ndarray, members: np.ndarray) -> None:
        self.scanned += len(rows) * len(members)
        rough = self.q[rows] @ self.x[members].T
        rough[self.query_ids[rows][:, None] == self.ids[members][None, :]] = -np.inf
        least = self.least[rows]
        if len(members) > self.k:
            best = np.partition(rough, len(members) - self.k, axis=1)[:, len(members) - self.k]
            least = np.maximum(least, best - self.slack[rows])
        r, c = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
        if not len(r):
            return
        scores = np.concatenate([
            products(self.columns, rows[r[at:at + PAIRS]], self.x_columns, members[c[at:at + PAIRS]]) for at in range(0, len(r), PAIRS)
        ])
        changed, local = np.unique(r, return_inverse=True)
        kept = rows[changed]
        owner = np.concatenate([np.repeat(np.arange(len(kept)), self.k), local])
        ids = np.concatenate([self.found[kept].ravel(), self.ids[members[c]]])
        scores = np.concatenate([self.scores[kept].ravel(), scores])
        order = np.lexsort((ids, -scores, owner))
        owner, ids, scores = owner[order], ids[order], scores[order]
        start = np.searchsorted(owner, np.arange(len(kept)))
        take = (start[:, None] + np.arange(self.k)).ravel()
        self.found[kept], self.scores[kept] = ids[take].reshape(-1, self.k), scores[take].reshape(-1, self.k)
        self.least[kept] = np.maximum(self.least[kept], self.scores[kept, -1] - self.slack[kept])


def products(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Inner products of columns of a and b, summed in the order of the components."""
    out = np.zeros(len(of_a))
    for x, y in zip(a, b):
        out += x[of_a] * y[of_b]
    return out


def thinned(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a shard without those that no query can have among its nearest: of equal vectors the 2k smallest
    identifiers are enough, an identifier at most k times (a query leaves out its own)."""
    if not len(ids):
        return ids, x
    order = np.lexsort((ids, *x.T[::-1]))
    ids, x = ids[order], x[order]
    for most, new in ((k, True), (2 * k, False)):
        change = np.any(x[1:] != x[:-1], axis=1)
        begins = np.concatenate([[True], change | (ids[1:] != ids[:-1]) if new else change])
        starts = np.flatnonzero(begins)
        place = np.arange(len(ids)) - starts[np.cumsum(begins) - 1]
        ids, x = ids[place < most], x[place < most]
    return ids, x


@dataclass
class Top:
    """The top tree: its regions' shards, and the sample that queries take their first bound from."""

    tree: Node
    ids: np.ndarray
    x: np.ndarray
    longest: float
    first_shard: np.ndarray
    shards: np.ndarray

    def regions(self) -> list[Node]:
        out, todo = [], [self.tree]
        while todo:
            node = todo.pop()
            if node.members is not None:
                out.append(node)
            else:
                todo += [node.far, node.near]
        return out

    def deal(self, x: np.ndarray) -> np.ndarray:
        """The region of each vector."""
        points, out = lifted(x, self.longest), np.empty(len(x), np.int64)
        todo = [(self.tree, np.arange(len(x)))]
        number = {id(node): n for n, node in enumerate(self.regions())}
        while todo:
            node, rows = todo.pop()
            if node.members is not None:
                out[rows] = number[id(node)]
                continue
            near = distances(points[rows], node.vantage) <= node.radius
            todo += [(node.far, rows[~near]), (node.near, rows[near])]
        return out

    def ask(self, ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, region): whether the query goes there, and with what bound.

        In its own region it has none, so that k are found; where the sample can't promise that many, it has none anywhere.
        """
        size = np.einsum("ij,ij->i", q, q) + self.longest
        scores = q @ self.x.T
        scores[ids[:, None] == self.ids[None, :]] = -np.inf
        bound = np.full(len(q), np.inf)
        if len(self.ids) >= k:
            best = np.partition(scores, len(self.ids) - k, axis=1)[:, len(self.ids) - k]
            bound = np.where(np.isfinite(best), np.sqrt(np.maximum(size - 2 * (best - SLACK * size), 0)), np.inf)
        lift, gaps = np.hstack([q, np.zeros((len(q), 1))]), []
        todo = [(self.tree, np.zeros(len(q)))]
        while todo:  # in the order of regions()
            node, gap = todo.pop()
            if node.members is not None:
                gaps.append(gap)
                continue
            d = distances(lift, node.vantage)
            todo += [(node.far, np.maximum(gap, node.radius - d)), (node.near, np.maximum(gap, d - node.radius))]
        rough, gaps = np.sqrt(SLACK * size)[:, None], np.stack(gaps, axis=1)
        home = gaps <= 0
        others = np.stack([(self.ids[node.members][None, :] != ids[:, None]).sum(axis=1) for node in self.regions()], axis=1)
        bound = np.where((home & (others >= k)).any(axis=1), bound, np.inf)[:, None]
        return (gaps - rough) * factor <= bound, np.where(home, np.inf, bound)


def fit(rows: DataFrame, count: int, dim: int, longest: float) -> Top:
    """The top tree from a bounded sample of (id, x) by order of a hash."""
    most, per_shard = max(1, SAMPLE_BYTES // (8 * dim)), max(1, SHARD_BYTES // (8 * dim))
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(most).collect()
    ids, x = np.array([r.id for r in taken], np.int64), np.array([r.x for r in taken], float).reshape(-1, dim)
    regions = max(1, min(count // per_shard, len(taken) // REGION_SAMPLE))
    top = Top(build(lifted(x, longest), max(1, -(-len(taken) // regions))), ids, x, longest, None, None)
    share = np.array([len(node.members) for node in top.regions()]) / max(1, len(taken))
    top.shards = np.maximum(1, np.ceil(share * count / per_shard)).astype(np.int64)
    top.first_shard = np.concatenate([[0], np.cumsum(top.shards)[:-1]])
    return top


def measured_factor(ids: np.ndarray, x: np.ndarray, longest: float, k: int) -> float:
    """The largest of FACTORS whose search of the sample finds RECALL of what comparing all pairs finds."""
    asked = np.linspace(0, len(x) - 1, min(len(x), TRIALS)).astype(int)
    scores = x[asked] @ x.T
    scores[ids[asked][:, None] == ids[None, :]] = -np.inf
    best = np.sort(scores, axis=1)[:, -min(k, len(x)):]
    least, wanted = best[:, :1] - SLACK * longest, np.isfinite(best).sum()
    tree, unbounded = build(lifted(x, longest), max(8, len(x) // 32)), np.full(len(asked), np.inf)
    for factor in FACTORS:
        row, _, score = Search(ids, x, tree, longest, k, factor).run(ids[asked], x[asked], unbounded)
        if (score >= least[row, 0]).sum() >= RECALL * wanted:
            return factor
    return 1.0


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def _lists(x: np.ndarray, dim: int, single: bool) -> pa.Array:
    flat = x.ravel().astype(np.float32 if single else float)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dim, dtype=np.int32)), pa.array(flat))


_COLUMNS = ["shard", "mark", "id", "x", "bound"]


def usable(vectors: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """id, x, is_query of the rows that take part, whatever their length."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda v: v != 0))
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"  # travels as it is
    x = F.col(vector) if single else F.col(vector).cast("array<double>")
    return rows.select(F.col(key).cast("long").alias("id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, factor: float | None = None, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest of all other rows; without a factor, by a measured one."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, is_query)
    x_type = rows.schema["x"].dataType.simpleString()
    single, dealt = x_type == "array<float>", f"shard long, mark int, id long, x {x_type}, bound double"
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    # one row per length of vectors; the most frequent length is the table's
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest"))
    first = sizes.orderBy(F.desc("n"), "dim").first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, count, longest = first
    rows = rows.filter(F.size("x") == dim)
    fitted = fit(rows.select("id", "x"), count, dim, longest)
    factor = measured_factor(fitted.ids, fitted.x, longest, k) if factor is None else factor
    top = spark.sparkContext.broadcast(fitted)
    shards = int(top.value.shards.sum())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, done = top.value, (TaskContext.get().partitionId() * 7919) if TaskContext.get() else 0
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            region = at.deal(x)
            shard = at.first_shard[region] + (done + np.arange(len(x))) % at.shards[region]
            done += len(x)
            n = len(x)
            yield pa.record_batch(
                [pa.array(shard), pa.array(np.zeros(n, np.int32)), batch.column(0), _lists(x, dim, single), pa.array(np.zeros(n))], _COLUMNS)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = top.value
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            goes, bound = at.ask(ids, x, k, factor)
            for region in range(goes.shape[1]):
                some = np.flatnonzero(goes[:, region])
                for shard in range(at.first_shard[region], at.first_shard[region] + at.shards[region]):
                    yield pa.record_batch(
                        [pa.array(np.full(len(some), shard)), pa.array(np.ones(len(some), np.int32)), pa.array(ids[some]),
                         _lists(x[some], dim, single), pa.array(bound[some, region])], _COLUMNS)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(shard, mark, identifiers, vectors, bounds): the vectors of a shard at once, then its queries in blocks."""
        held, kind, size = [], None, 0
        for batch in batches:
            shard, mark = (batch.column(n).to_numpy() for n in (0, 1))
            edges = [0, *(np.flatnonzero((np.diff(shard) != 0) | (np.diff(mark) != 0)) + 1), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and ((shard[a], mark[a]) != kind or (kind[1] and size >= BLOCK)):
                    yield *kind, *map(np.concatenate, zip(*held))
                    held, size = [], 0
                kind, piece = (shard[a], mark[a]), batch.slice(a, b - a)
                held.append((piece.column(2).to_numpy(), _matrix(piece.column(3), dim), piece.column(4).to_numpy()))
                size += b - a
        if held:
            yield *kind, *map(np.concatenate, zip(*held))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, now = None, None
        for shard, mark, ids, x, bound in runs(batches):
            if shard != now:
                ready, now = None, shard
            if not mark:
                ids, x = thinned(ids, x, k)
                ready = Search(ids, x, build(lifted(x, longest)), longest, k, factor)
            elif ready:  # a shard may have no vectors
                row, found, score = ready.run(ids, x, bound)
                yield pa.record_batch([pa.array(ids[row]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    asked = rows.filter("is_query").groupBy("id").agg(F.min("x").alias("x"))
    both = rows.select("id", "x").mapInArrow(deal, dealt).unionAll(asked.mapInArrow(ask, dealt))
    # as many partitions as shards, so that none is joined to others; a partition of several takes one after the other
    placed = both.repartition(min(shards, 1 << 17), "shard").sortWithinPartitions("shard", "mark", "id")
    found = placed.mapInArrow(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
