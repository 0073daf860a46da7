"""Centroid clustering in whole numbers: the nearest centroid by a tournament of bisectors.

Of two centroids a and b, b is nearer to x exactly where `x . normal > threshold`, the normal being
2 (b - a) and the threshold |b|^2 - |a|^2. Normals and thresholds of all pairs are computed once a round; a
vector's first champion is centroid 0, each further centroid meets the champion in one sign test, and
zero keeps the champion, whose number is smaller. After k - 1 tests the exact distance to the champion
is taken. All of it is whole numbers, so ties are ties.

A round reads the vectors once. A task adds up its vectors by cluster, and of all sums only one row
for each cluster, component and limb reaches the driver. Numbers a long can't add up take Python's.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import read, ready_for_python

#: Clusters, rounds, components, steps of a component's unit.
CLUSTERS, ROUNDS, SIZE, SCALE = 40, 5, 64, 256
SEED = 2
#: Components up to this size leave dot products and distances of 64 components within a long.
LEAST_BIG = 2**27
#: A sum goes to Spark in limbs of so many bits, so that it may be of any size.
LIMB = 40


def usable(vector: str, size: int = SIZE) -> Column:
    """Whether a vector has exactly `size` components, none null, not a number or infinite."""
    v = F.col(vector)
    inside = (F.array_max(v) < float("inf")) & (F.array_min(v) > float("-inf"))  # not-a-number is the largest
    return F.coalesce((F.size(v) == size) & (F.size(F.array_compact(v)) == size) & inside, F.lit(False))


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: longs where they're small, else Python's integers."""
    x = values.astype(np.float64)
    if not x.size or np.abs(x).max() * scale < LEAST_BIG:
        return np.floor(x * scale).astype(np.int64)
    exact = [int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


class Tournament:
    """The bisectors of some centroids. Holds k * k * size numbers."""

    def __init__(self, centroids: list[list[int]]):
        big = max((abs(c) for row in centroids for c in row), default=0) >= LEAST_BIG
        self.centroids = np.array(centroids, dtype=object if big else np.int64)
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])  # [a, b]
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's nearest centroid."""
        champion = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            side = _dots(x, self.normals[champion, b]) - self.thresholds[champion, b]
            champion[(side > 0).astype(bool)] = b
        return champion

    def distances(self, x: np.ndarray, champion: np.ndarray) -> np.ndarray:
        gap = x - self.centroids[champion]
        return _dots(gap, gap)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype == object or b.dtype == object:
        return (a * b).sum(axis=1)
    return np.einsum("nd,nd->n", a, b)


def _vectors(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors of a batch of `id`, `vector`, one per row."""
    return whole(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """(number, part) with the sum of part * 2**(LIMB * number) equal to `total`; the last may be negative."""
    k = 0
    while not -(2**LIMB) < total < 2**LIMB:
        yield k, total & (2**LIMB - 1)
        total >>= LIMB
        k += 1
    yield k, total


def _sums(kept: DataFrame, tournament: Tournament, size: int) -> dict[tuple[int, int], int]:
    """Sums by (cluster, component), and counts as component -1."""
    k = len(tournament.centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), object), np.zeros(k, np.int64)
        for batch in batches:
            x = _vectors(batch, size)
            if len(x):
                order = np.argsort(champion := tournament.winners(x), kind="stable")
                met, starts, n = np.unique(champion[order], return_index=True, return_counts=True)
                sums[met] += np.add.reduceat(x[order], starts, axis=0).astype(object)
                counts[met] += n
        rows = [(c, d, *limb) for c in np.flatnonzero(counts).tolist() for d in range(size) for limb in limbs(int(sums[c, d]))]
        rows += [(c, -1, 0, int(counts[c])) for c in np.flatnonzero(counts).tolist()]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["c", "d", "limb", "part"])

    parts = kept.mapInArrow(add, "c int, d int, limb int, part long")
    total = parts.groupBy("c", "d", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    out: dict[tuple[int, int], int] = {}
    for r in total.collect():  # k * (size + 1) rows, times the limbs
        out[r.c, r.d] = out.get((r.c, r.d), 0) + (int(r.part) << (LIMB * r.limb))
    return out


def starting(kept: DataFrame, clusters: int, seed: int, scale: int = SCALE) -> list[list[int]]:
    """The vectors with the smallest sha256 of `seed:id`, in its order; rows that share an id follow by
    their components. A null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("h"), F.transform("vector", lambda x: x.cast("double")).alias("v")).orderBy("h", "v").limit(clusters).collect()
    return [whole(np.array([r.v]), scale)[0].tolist() for r in rows]


ASSIGNED = "vec_id long, cluster int, distance long"


def clustered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """`vec_id`, `cluster`, `distance` (squared, of whole numbers) of every usable vector, written out, and
    the final centroids.

    Vectors that are null, of another size, or hold null or non-finite components take no part. Fewer
    vectors than clusters are as many clusters; none at all gives no rows and no centroids. Repeated rows
    count as often as they occur. A distance that a long can't hold is null; its cluster is right.
    A worker holds clusters**2 * size numbers.
    """
    spark = vectors.sparkSession
    ready_for_python(spark)
    kept = cut(vectors.filter(usable(vector, size)).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector")))
    centroids = starting(kept, clusters, seed)
    if not centroids:
        return spark.createDataFrame([], ASSIGNED), []
    for _ in range(rounds):
        sums = _sums(kept, Tournament(centroids), size)
        centroids = [[sums[c, d] // sums[c, -1] for d in range(size)] if (c, -1) in sums else old for c, old in enumerate(centroids)]
    tournament = Tournament(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, size)
            champion = tournament.winners(x)
            far = [int(d) if d < 2**63 else None for d in tournament.distances(x, champion).tolist()] if len(x) else []
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(champion, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    return cut(kept.mapInArrow(assign, ASSIGNED)), centroids


def op13_bisectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every embedding, with inertias and the digest of its centroid. An inertia that a long
    can't hold, or of a distance that it can't, is null."""
    found, centroids = clustered(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("inertia")
    by_cluster = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(total).collect()}  # one row a cluster
    fits = lambda x: None if x is None or x >= 2**63 else int(x)
    everything = None if None in by_cluster.values() else sum(by_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        listed = F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>")
        return F.get(listed, F.col("cluster"))

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([fits(by_cluster.get(c)) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(fits(everything)).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"),
    )


def _op13_sql() -> str:
    """The same clustering as SQL: vectors and centroids as rows of components, distances by joins."""
    steps = [
        f"""raw AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
kept AS MATERIALIZED (SELECT vec_id, list_transform(v, lambda x: floor({SCALE} * x)::HUGEINT) AS v FROM raw
  WHERE len(v) = {SIZE} AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = {SIZE}),
x AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept),
c0 AS MATERIALIZED (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS d
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM kept) WHERE k < {CLUSTERS})"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, k, far FROM (SELECT vec_id, k, sum((x.x - c.x) * (x.x - c.x)) AS far
  FROM x JOIN c{r} AS c USING (d) GROUP BY vec_id, k) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, k) = 1)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""m{r} AS (SELECT k, d, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM x JOIN a{r} USING (vec_id) GROUP BY k, d),
c{r + 1} AS MATERIALIZED (SELECT k, d, CASE WHEN n IS NULL THEN x ELSE s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END END AS x
  FROM c{r} LEFT JOIN m{r} USING (k, d))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
named AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, far::BIGINT AS distance, (sum(far) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(far) OVER ())::BIGINT AS inertia, centroid_sha256 FROM a{ROUNDS} JOIN named USING (k)"""
    )


OP13_SQL = _op13_sql()
