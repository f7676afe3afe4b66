"""Approximate nearest neighbours: Gaussian (2-stable) projections to a few dimensions, indexed by kd-trees.

The ratio of a squared projected distance to the true one has a chi-square distribution with as many degrees of freedom
as there are projected dimensions.  Projected neighbours come out of a tree in order of distance and their true distances are computed,
until the next one's is so large that, by the chi-square quantile, a point nearer than the k-th best would hardly lie beyond it.

The index is one for all rows.  A bounded sample (``sample_rows`` projected rows) fits a kd-tree of at most ``most_cells`` cells; every row is
dealt to its cell, and a cell's rows to shards of bounded size, each with a box and a tree of its own.  Queries go to the shard of the
nearest box first; the k-th distance found there goes along to the others, and only those are visited whose box the stopping test doesn't
rule out.  A task holds one shard and streams the queries that visit it; the nearest of all visits are merged by query.  The boxes and
shard sizes that are broadcast have at most ``most_cells`` rows.

Of rows of one vector only those of the k + 1 smallest ids can be among a query's k nearest, so others aren't indexed.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows without an id, take no part; vectors
are compared with those of the same length only; an id that is repeated counts as one candidate, with its nearest row, and
as one query, with its least vector; equal distances go to the smaller id; with fewer candidates than k all are returned; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common


def chi_square_quantile(p: float, degrees: int) -> float:
    """The quantile for an even number of degrees, where the distribution function is a finite sum."""
    if degrees % 2:
        raise ValueError("an even number of dimensions is asked for")

    def cdf(x: float) -> float:
        term = total = 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


def projection(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, m))


class Tree:
    """A kd-tree over projected points: an order of the points, leaf bounds within it, and the leaves' boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.starts: list[int] = []
        stack = [(0, len(points))]
        while stack:
            a, b = stack.pop()
            if b - a <= leaf:
                self.starts.append(a)
                continue
            own = self.order[a:b]
            spread = points[own]
            axis = int(np.argmax(spread.max(axis=0) - spread.min(axis=0)))
            middle = (b - a) // 2  # also splits equal points
            self.order[a:b] = own[np.argpartition(spread[:, axis], middle)]
            stack += [(a, a + middle), (a + middle, b)]
        self.starts.sort()
        self.ends = [*self.starts[1:], len(points)]
        self.points = points[self.order]
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in zip(self.starts, self.ends, strict=True)])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in zip(self.starts, self.ends, strict=True)])

    def near(self, query: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """(places, bound) some points at a time, nearest first; the points that are left are at least the bound's squared distance away."""
        away = np.maximum(0, np.maximum(self.low - query, query - self.high))
        bounds = (away * away).sum(axis=1)
        order = np.argsort(bounds, kind="stable")
        waiting, distance = np.empty(0, np.int64), np.empty(0)
        for i, leaf in enumerate(order):
            a, b = self.starts[leaf], self.ends[leaf]
            gap = self.points[a:b] - query
            waiting, distance = np.r_[waiting, np.arange(a, b)], np.r_[distance, (gap * gap).sum(axis=1)]
            beyond = bounds[order[i + 1]] if i + 1 < len(order) else np.inf
            out = np.flatnonzero(distance <= beyond)
            if not len(out):
                yield out, beyond
                continue
            out = out[np.argsort(distance[out], kind="stable")]
            for j in range(0, len(out), STEP):
                yield waiting[out[j : j + STEP]], distance[out[j + STEP]] if j + STEP < len(out) else beyond
            left = distance > beyond
            waiting, distance = waiting[left], distance[left]


STEP = 64  # projected neighbours between two stopping tests


def search(ids: np.ndarray, vectors: np.ndarray, tree: Tree, own_id: int, query: np.ndarray, projected: np.ndarray, k: int, limit: float, reach: float = np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, distances, number verified) of the nearest found; ``ids`` and ``vectors`` are in the tree's order, ``reach`` is the k-th distance known before."""
    best_ids, best, verified = np.empty(0, np.int64), np.empty(0), 0
    for at, bound in tree.near(projected):
        at = at[ids[at] != own_id]
        if len(at):
            gap = vectors[at] - query
            verified += len(at)
            away = np.sqrt((gap * gap).sum(axis=1))
            if len(best) == k:  # what is farther than the k-th changes nothing
                nearer = away <= best[-1]
                at, away = at[nearer], away[nearer]
            if len(at):
                best_ids, best = np.r_[best_ids, ids[at]], np.r_[best, away]
                by = np.lexsort((best, best_ids))
                by = by[np.r_[True, np.diff(best_ids[by]) != 0]]  # an id's nearest row
                by = by[np.lexsort((best_ids[by], best[by]))][:k]
                best_ids, best = best_ids[by], best[by]
                if len(best) == k:
                    reach = min(reach, best[-1])
        if bound > reach**2 * limit:
            break
    return best_ids, best, verified


def _valid(column: Column) -> Column:
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return column.isNotNull() & finite & F.exists(column, lambda x: x != 0)


class Cells:
    """A kd-tree over a sample of projected points: which cell a point falls in."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis, self.cut = [], []
        self.depth = max(0, (cells - 1).bit_length())
        groups = [points]
        for _ in range(self.depth):  # the nodes of a level, from the left
            halves = []
            for own in groups:
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if len(own) else 0
                cut = float(np.median(own[:, axis])) if len(own) else 0.0
                self.axis.append(axis)
                self.cut.append(cut)
                halves += [own[own[:, axis] <= cut], own[own[:, axis] > cut]]
            groups = halves

    def of(self, points: np.ndarray) -> np.ndarray:
        axis, cut, node = np.array(self.axis, np.int64), np.array(self.cut), np.zeros(len(points), np.int64)
        for level in range(self.depth):
            at = (1 << level) - 1 + node
            node = node * 2 + (points[np.arange(len(points)), axis[at]] > cut[at])
        return node


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _celled(cells: Cells, dim: int, m: int, seed: int):
    """Rows with their cell, and the least and greatest coordinates of their projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = projection(dim, m, seed)
        for batch in batches:
            cell = cells.of(_matrix(batch.column("v"), dim) @ g) if batch.num_rows else np.empty(0, np.int64)
            yield batch.append_column("cell", pa.array(cell))

    return run


FOUND = "query_id long, vec_id long, score double, verified long"


def _searcher(dim: int, k: int, m: int, limit: float, leaf: int, seed: int):
    """Rows of a shard (``kind`` 0) and then of the queries that visit it (1, with the k-th distance they know)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, shard, held, index = projection(dim, m, seed), None, [], None
        for batch in batches:
            names, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.r_[0, np.flatnonzero((np.diff(names) != 0) | (np.diff(kinds) != 0)) + 1, len(names)] if len(names) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(a, b - a)
                if names[a] != shard:
                    shard, held, index = names[a], [], None
                if kinds[a] == 0:
                    held.append(part)
                    continue
                if index is None and held:
                    rows = pa.Table.from_batches(held)
                    own, ids = _matrix(rows.column("v"), dim), rows.column("id").to_numpy()
                    tree = Tree(own @ g, leaf)
                    held, index = [], (ids[tree.order], own[tree.order], tree)
                if index is None:
                    continue
                queries, out = _matrix(part.column("v"), dim), []
                for name, query, projected, reach in zip(part.column("id").to_pylist(), queries, queries @ g, part.column("reach").to_pylist(), strict=True):
                    near, away, n = search(*index, name, query, projected, k, limit, math.inf if reach is None else reach)
                    out.append((np.full(len(near) + 1, name), np.r_[near, -1], np.r_[away, 0.0], np.r_[np.zeros(len(near), np.int64), n]))
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                none = np.concatenate([np.r_[np.zeros(len(x[0]) - 1, bool), True] for x in out])  # the row that tells the number verified
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], mask=none), pa.array(columns[2], mask=none), pa.array(columns[3])], names=["query_id", "vec_id", "score", "verified"])

    return run


def _visits(shards: list[tuple], dim: int, m: int, limit: float, seed: int, first: bool):
    """Queries, once for each shard that they visit: that of the nearest box, or then the others whose box isn't ruled out by the k-th distance known."""
    names = np.array([s[0] for s in shards], np.int64)
    low, high = (np.array([s[i] for s in shards], float).reshape(-1, m) for i in (1, 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = projection(dim, m, seed)
        for batch in common.slices(batches, 256):
            points = _matrix(batch.column("v"), dim) @ g
            reach = np.array([math.inf if x is None else x for x in batch.column("reach").to_pylist()])
            row, to = [], []
            for i, p in enumerate(points):
                away = np.maximum(0, np.maximum(low - p, p - high))
                bound = (away * away).sum(axis=1)
                home = int(np.lexsort((names, bound))[0])
                own = np.array([home]) if first else np.flatnonzero((bound <= reach[i] ** 2 * limit) & (np.arange(len(names)) != home))
                row += [i] * len(own)
                to += names[own].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *(batch.column(c).take(pa.array(row, pa.int64())) for c in ("id", "v", "reach"))], names=["shard", "id", "v", "reach"])

    return run


def _found(embeddings: DataFrame, queries: DataFrame, dim: int, *, k: int, m: int, confidence: float, shard_rows: int, most_cells: int, sample_rows: int, leaf: int, seed: int) -> DataFrame:
    """``FOUND`` for vectors of one length."""
    limit, g = chi_square_quantile(confidence, m), projection(dim, m, seed)
    n = embeddings.count()
    per_cell = max(shard_rows, -(-n // most_cells))
    sample = embeddings.orderBy(F.xxhash64("v"), "id").limit(sample_rows).select("v").toPandas()["v"]
    cells = Cells(np.array([np.asarray(v, float) for v in sample]).reshape(-1, dim) @ g, min(most_cells, -(-n // per_cell)))
    celled = common.settled(embeddings.mapInArrow(_celled(cells, dim, m, seed), "id long, v array<double>, cell long"))
    parts = F.ceil(F.col("rows") / shard_rows).cast("long")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("rows")).select(F.col("cell").alias("of"), parts.alias("parts"))  # at most ``most_cells`` rows
    shard = (F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("id", "v"), F.col("parts"))).alias("shard")
    index = celled.join(F.broadcast(sizes), F.col("cell") == F.col("of")).select(shard, "id", "v", F.lit(0).alias("kind"), F.lit(None).cast("double").alias("reach"))
    # A box for each cell serves all of its shards: they are samples of it.
    boxes = celled.select("cell", "v").mapInArrow(_boxes(dim, m, seed), "cell long, low array<double>, high array<double>")
    at = [F.min(F.col("low")[i]) for i in range(m)], [F.max(F.col("high")[i]) for i in range(m)]
    cell_boxes = boxes.groupBy("cell").agg(F.array(*at[0]).alias("low"), F.array(*at[1]).alias("high")).join(sizes, F.col("cell") == F.col("of")).collect()
    shards = [((r["cell"] << 32) + i, r["low"], r["high"]) for r in cell_boxes for i in range(r["parts"])]

    def visited(asked: DataFrame, first: bool) -> DataFrame:
        to = asked.mapInArrow(_visits(shards, dim, m, limit, seed, first), "shard long, id long, v array<double>, reach double").withColumn("kind", F.lit(1))
        met = index.unionByName(to).repartition("shard").sortWithinPartitions("shard", "kind", "id")
        return met.mapInArrow(_searcher(dim, k, m, limit, leaf, seed), FOUND)

    home = common.settled(visited(queries.withColumn("reach", F.lit(None).cast("double")), True))
    nearest_k = F.slice(F.array_sort(F.collect_list("score")), k, 1)  # a home shard gives k at most
    known = home.groupBy(F.col("query_id").alias("of")).agg(F.get(nearest_k, F.lit(0)).alias("reach"))
    return home.unionByName(visited(queries.join(known, F.col("id") == F.col("of"), "left").select("id", "v", "reach"), False))


def _boxes(dim: int, m: int, seed: int):
    """The box of each cell's projections, for every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = projection(dim, m, seed)
        for batch in batches:
            points, cell = _matrix(batch.column("v"), dim) @ g, batch.column("cell").to_numpy()
            own = np.unique(cell)
            low, high = ([list(f(points[cell == c], axis=0)) for c in own] for f in (np.min, np.max))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(low, pa.list_(pa.float64())), pa.array(high, pa.list_(pa.float64()))], names=["cell", "low", "high"])

    return run


def visits(embeddings: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, m: int = 16, confidence: float = 0.93, shard_rows: int = 8192, most_cells: int = 4096, sample_rows: int = 65_536, leaf: int = 256, seed: int = 0) -> DataFrame:
    """``FOUND``: what each visit of a query to a shard found, and how many vectors it verified (in a row without ``vec_id``)."""

    def vectors(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        return rows.filter(F.col("id").isNotNull() & _valid(F.col("v")))

    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    rows = common.settled(vectors(embeddings).distinct().withColumn("place", place).filter(F.col("place") <= k + 1).drop("place"))
    asked = common.settled(vectors(queries).groupBy("id").agg(F.min("v").alias("v")))
    dims = [r[0] for r in asked.select(F.size("v")).distinct().collect()]  # lengths of vectors, few
    found = [_found(rows.filter(F.size("v") == d), asked.filter(F.size("v") == d), d, k=k, m=m, confidence=confidence, shard_rows=shard_rows, most_cells=most_cells, sample_rows=sample_rows, leaf=leaf, seed=seed) for d in dims]
    out = embeddings.sparkSession.createDataFrame([], FOUND)
    for f in found:
        out = out.unionByName(f)
    return out


def nearest(embeddings: DataFrame, queries: DataFrame, *, k: int = 10, **options) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of all rows to each query row, in double precision."""
    found = visits(embeddings, queries, k=k, **options)
    best = found.filter(F.col("vec_id").isNotNull()).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
