"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are scaled to length one, where the Euclidean distance orders them as the cosine does and obeys
the triangle inequality. A node of a tree holds a vantage point and the median distance to it; points
within that distance are inside, the others outside. A query at the distance d from the vantage point,
whose k-th nearest so far is at the distance t, can't find anything nearer on the other side of the
median m if |d - m| > t. `factor` relaxes that: a side is passed over if |d - m| > factor * t. With
factor 1 the search is exact, below it passes over more.

Vectors are dealt over cells, and a task builds the trees of a cell, one for each shard of bounded
rows. The queries are copied once for each cell, not for each shard, and stream past its trees in
blocks; what comes back is at most k rows a query and cell. Nothing is joined: the planner takes
copies for one row each, and would send all of them through the driver to broadcast them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import read, ready_for_python

#: Vectors of a shard and queries of a block at most, about; points of a leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF = 4096, 2048, 48
#: Cells, if the shards are as many. Bytes of a cell's vectors, as doubles: more of them make more cells; and of a block's.
CELLS, CELL_BYTES, BLOCK_BYTES = 64, 64 << 20, 8 << 20
#: Recall at this factor is measured in the tests; 1 is exact.
FACTOR = 0.8
NEIGHBOURS, QUERY_MODULUS = 5, 50
#: Points that all queries of a block are compared with at a time.
PIECE = 256


class Tree:
    """A tree over rows of unit vectors. Nodes are numbered as made; a leaf has no vantage point."""

    def __init__(self, unit: np.ndarray, seed: int = 3):
        self.unit = unit
        self.point: list[int] = []
        self.median: list[float] = []
        self.inside: list[int] = []
        self.outside: list[int] = []
        self.rows: list[np.ndarray] = []
        self.rng = np.random.default_rng(seed)
        self.make(np.arange(len(unit)))

    def make(self, rows: np.ndarray) -> int:
        node = len(self.point)
        for own, empty in ((self.point, -1), (self.median, 0.0), (self.inside, -1), (self.outside, -1), (self.rows, rows)):
            own.append(empty)
        if len(rows) <= LEAF:
            return node
        # Of a few points, that which spreads the others' distances most.
        tried = self.rng.choice(rows, 5, replace=False)
        some = self.unit[self.rng.choice(rows, min(len(rows), 100), replace=False)]
        best = max(tried, key=lambda i: float(np.var(some @ self.unit[i])))
        rest = rows[rows != best]
        far = distance(self.unit[rest] @ self.unit[best])
        median = float(np.median(far))
        within = far <= median
        if within.all():  # ties: nothing is gained by a vantage point here
            return node
        self.point[node], self.median[node], self.rows[node] = int(best), median, rows[:0]
        self.inside[node] = self.make(rest[within])
        self.outside[node] = self.make(rest[~within])
        return node

    def search(self, queries: np.ndarray, same: np.ndarray, names: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest to each query, without rows whose name is the query's
        (`same`). Missing ones are row -1 at an infinite distance. Ties go to the smaller row.

        All vantage points are offered first, then the leaf each query falls into. What is found there
        bounds the way through the tree, which meets each node once for all queries that reach it.
        """
        n = len(queries)
        best = np.full((n, k), -1)
        far = np.full((n, k), np.inf)
        every = np.arange(n)

        def offer(active: np.ndarray, rows: np.ndarray, c: np.ndarray) -> None:
            worst = far[active, -1]
            floor = 1 - worst * worst / 2 - 1e-12  # a hair's breadth less, for rounding
            if np.isinf(worst).any() and len(rows) > k:
                c[names[rows][None, :] == same[active][:, None]] = -np.inf
                floor = np.maximum(floor, np.partition(c, -k, axis=1)[:, -k] - 1e-12)
            who, which = np.nonzero(c >= floor[:, None])
            q, r, d = active[who], rows[which], distance(c[who, which])
            nearer = (d < far[q, -1]) | ((d == far[q, -1]) & (r < best[q, -1]))
            nearer &= names[r] != same[q]
            q, r, d = q[nearer], r[nearer], d[nearer]
            if not len(q):
                return
            own, found = np.unique(q, return_counts=True)
            all_q = np.concatenate([np.repeat(own, k), q])
            all_d, all_r = np.concatenate([far[own].ravel(), d]), np.concatenate([best[own].ravel(), r])
            order = np.lexsort((all_r, all_d, all_q))
            start = np.cumsum(found + k) - found - k
            first = order[start[:, None] + np.arange(k)]
            far[own], best[own] = all_d[first], all_r[first]

        def offer_leaf(node: int, active: np.ndarray) -> None:
            asked = queries if len(active) == n else queries[active]
            for a in range(0, len(self.rows[node]), PIECE):  # a leaf of equal points may hold any number
                rows = self.rows[node][a : a + PIECE]
                offer(active, rows, asked @ self.unit[rows].T)

        point, median = np.array(self.point), np.array(self.median)
        inside, outside = np.array(self.inside), np.array(self.outside)
        column = np.cumsum(point >= 0) - 1
        vantage = point[point >= 0]
        c = queries @ self.unit[vantage].T
        to = distance(c)
        if len(vantage):
            offer(every, vantage, c)

        home, on = np.zeros(n, int), every
        while len(on := on[point[home[on]] >= 0]):
            at = home[on]
            home[on] = np.where(to[on, column[at]] <= median[at], inside[at], outside[at])
        by_home = np.argsort(home, kind="stable")
        for active in np.split(by_home, np.flatnonzero(np.diff(home[by_home])) + 1):
            if len(active):
                offer_leaf(int(home[active[0]]), active)

        # Nodes to visit, those who may have to, and how far beyond the border they lie. (No function that
        # calls itself: it would keep its arrays until Python looks for cycles.)
        waiting = [(0, every, np.zeros(n))]
        while waiting:
            node, active, beyond = waiting.pop()
            # A hair's breadth more, for rounding.
            active = active[beyond <= factor * far[active, k - 1] + 1e-7]
            if not len(active):
                continue
            if point[node] >= 0:
                beyond = to[active, column[node]] - median[node]
                waiting += [(outside[node], active, -beyond), (inside[node], active, beyond)]
            elif len(active := active[home[active] != node]):
                offer_leaf(node, active)
        return best, far


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as doubles, and their lengths. Scaling by the largest component keeps very long and very
    short ones from overflowing."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x, np.sqrt((x * x).sum(axis=1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of `a` and `b`, from the vectors as they are."""
    (a, long_a), (b, long_b) = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (long_a * long_b)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x, long = scaled(x)
    return x / long[:, None]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, np.ndarray, np.ndarray]]:
    """Of sorted rows those of one dimension, cell and kind in a batch: dimension and cell, whether they are
    queries, ids and vectors."""
    for batch in batches:
        dim, cell, asks, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "cell", "asks", "id"))
        new = (np.diff(dim) != 0) | (np.diff(cell) != 0) | (asks[1:] != asks[:-1])
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(ids)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                vectors = batch.column("vector").slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                yield (int(dim[a]), int(cell[a])), bool(asks[a]), ids[a:b].copy(), vectors.reshape(b - a, -1).copy()


class Cell:
    """Trees over the vectors of a cell: shards of about as many, at most `SHARD_ROWS`."""

    def __init__(self, ids: list[np.ndarray], vectors: list[np.ndarray]):
        ids, raw = np.concatenate(ids), np.concatenate(vectors)
        order = np.argsort(ids, kind="stable")
        n = math.ceil(len(ids) / SHARD_ROWS)
        # Dealt out by turns: neighbouring ids may be alike.
        self.shards = [(ids[rows], raw[rows]) for rows in (order[i::n] for i in range(n))]
        self.trees = [Tree(unit_rows(x)) for _, x in self.shards]

    def search(self, ids: list[np.ndarray], vectors: list[np.ndarray], k: int, factor: float) -> pa.RecordBatch:
        """The k nearest of the cell to each query: by score, ties to the smaller id."""
        q_ids, q_raw = np.concatenate(ids), np.concatenate(vectors)
        unit, found = unit_rows(q_raw), []
        so_far = np.full((len(q_ids), k), np.inf)
        for (names, raw), tree in zip(self.shards, self.trees, strict=True):
            best, far = tree.search(unit, q_ids, names, k, factor)
            so_far = np.sort(np.concatenate([so_far, far], axis=1), axis=1)[:, :k]
            # Only what no k others of the cell are nearer than, and a hair's breadth more, for rounding.
            who, which = np.nonzero((best >= 0) & (far * far <= so_far[:, -1:] ** 2 + 1e-12))
            rows = best[who, which]
            found.append((who, names[rows], cosine(q_raw[who], raw[rows])))
        who, near, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((near, -score, who))
        who = who[order]
        order = order[np.arange(len(who)) - np.searchsorted(who, who) < k]
        who = np.concatenate([f[0] for f in found])[order]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (q_ids[who], near[order], score[order])], ["query_id", "vec_id", "score"])


FOUND = "query_id bigint, vec_id bigint, score double"


def nearest(spark: SparkSession, vectors: DataFrame, queries: Column, k: int = NEIGHBOURS, factor: float = FACTOR, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: for the rows of `vectors` that meet `queries`, the
    k nearest other rows by cosine, ties to the smaller id; all there are if fewer.

    Unusable vectors (null, zero, or with a null or non-finite component) and null ids take no part.
    Only vectors of the same dimension are compared. Rows that repeat an id and vector are one; an id
    with several vectors has a point for each, and none of them is its own neighbour. `vectors` is read
    three times: counted, dealt out as points, and searched for queries.
    """
    ready_for_python(spark)
    kind = vectors.select(vector_col).schema[0].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)  # half the bytes, and the same numbers
    known = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"), queries.alias("asked"))
    known = known.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    n, components = known.agg(F.count("*"), F.sum(F.size("vector").cast("bigint"))).first()
    cells = max(1, min(CELLS, math.ceil(n / SHARD_ROWS)), math.ceil(8 * (components or 0) / CELL_BYTES))
    points = known.select("id", "vector").distinct().withColumn("cell", F.pmod(F.xxhash64("id", "vector"), F.lit(cells)).cast("int"))
    asked = known.filter("asked").select("id", "vector").distinct()
    # Every query is asked of every cell of its dimension: the stated queries against all rows.
    copies = asked.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    met = points.withColumn("asks", F.lit(False)).unionByName(copies.withColumn("asks", F.lit(True))).withColumn("dim", F.size("vector"))
    # More partitions than cells, for few cells to meet in one.
    dealt = met.repartition(4 * cells, "dim", "cell").sortWithinPartitions("dim", "cell", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell, ids, held = None, None, [], []
        for key, asks, some, x in runs(batches):
            if key != at:
                if cell and ids:
                    yield cell.search(ids, held, k, factor)
                at, cell, ids, held = key, None, [], []
            if asks and not cell:
                if not ids:  # nothing of this dimension in the cell
                    continue
                cell, ids, held = Cell(ids, held), [], []
            ids.append(some)
            held.append(x)
            if cell and sum(map(len, ids)) >= min(BLOCK_ROWS, BLOCK_BYTES // (8 * at[0])):
                yield cell.search(ids, held, k, factor)
                ids, held = [], []
        if cell and ids:
            yield cell.search(ids, held, k, factor)

    found = dealt.mapInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th vector."""
    return nearest(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_MODULUS == 0)
