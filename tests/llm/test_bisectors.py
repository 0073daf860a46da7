"""Centroid clustering against plain Python and against SQL."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest

from perkmill.llm import bisectors
from perkmill.llm.bisectors import OP13_SQL, Tournament, clustered, limbs, op13_bisectors, whole


def nearest(x: list[int], centroids: list[list[int]]) -> tuple[int, int]:
    far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
    return min(range(len(far)), key=lambda k: (far[k], k)), min(far)


def plain(rows: list[tuple[int | None, list[float] | None]], clusters: int, rounds: int, size: int, seed: int):
    """Lloyd's rounds one vector at a time."""
    ok = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(256 * x) if abs(x) < 2**50 else int(x) * 256 for x in v]) for i, v in ok]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(ints, key=lambda r: (name(r[0]), r[1]))][:clusters]
    for _ in range(rounds):
        own: dict[int, list] = {}
        for _, v in ints:
            own.setdefault(nearest(v, centroids)[0], []).append(v)
        centroids = [[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else old for k, old in enumerate(centroids)]
    return sorted((repr(i), *nearest(v, centroids)) for i, v in ints), centroids


@pytest.mark.parametrize("scale", [1, 3, 2**40, 2**100])
def test_tournament_is_exact(scale):
    rng = np.random.default_rng(scale % 97)
    points = rng.integers(-3, 4, (300, 4)).tolist()  # many ties
    centroids = rng.integers(-3, 4, (17, 4)).tolist()
    times = lambda rows: [[x * scale for x in r] for r in rows]
    t = Tournament(times(centroids))
    x = np.array(times(points), dtype=object if scale > 3 else np.int64)
    won = t.winners(x)
    expected = [nearest(p, centroids) for p in points]
    assert won.tolist() == [k for k, _ in expected]
    assert [int(d) for d in t.distances(x, won)] == [d * scale**2 for _, d in expected]


def test_whole_numbers():
    assert whole(np.array([[0.0, -0.001, 0.0039, -1.0]])).tolist() == [[0, -1, 0, -256]]
    assert whole(np.array([[3e38, -0.001]])).tolist() == [[int(3e38) * 256, -1]]
    assert whole(np.zeros((0, 4))).tolist() == []


@pytest.mark.parametrize("total", [0, 1, -1, 2**40, -(2**40), 2**63, -(2**200) - 5, 10**60])
def test_limbs(total):
    parts = list(limbs(total))
    assert sum(p << (bisectors.LIMB * k) for k, p in parts) == total
    assert all(-(2**63) <= p < 2**63 for _, p in parts)


def run(spark, rows, clusters, rounds, size=3, seed=2):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string")
    got, centroids = clustered(df, clusters=clusters, rounds=rounds, size=size, seed=seed)
    return sorted((repr(r.vec_id), r.cluster, r.distance) for r in got.collect()), centroids


def test_against_plain_rounds(spark):
    """Ties, repeated rows, null ids, unusable vectors, columns of clashing names."""
    rng = np.random.default_rng(4)
    rows = [(int(i), (rng.integers(-4, 5, 3) / 2).tolist()) for i in range(200)]
    rows += rows[:20] + [(7, [0.25, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, math.nan, 2.0]), (905, [1.0, math.inf, 2.0])]
    assert run(spark, rows, 9, 4) == plain(rows, 9, 4, 3, 2)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0])]
    got, centroids = run(spark, rows, 40, 5)
    assert len(centroids) == 2 and [d for *_, d in got] == [0, 0]
    assert run(spark, [(1, None)], 40, 5) == ([], [])


def test_numbers_beyond_a_long(spark):
    """Clusters stay exact; a distance that a long can't hold is null."""
    rows = [(i, [(-1.0) ** i * 1e30 * (i + 1), 1e-3, 5.0]) for i in range(12)] + [(50, [2.0, 1.0, 0.0])]
    got, centroids = run(spark, rows, 3, 3)
    expected, exact = plain(rows, 3, 3, 3, 2)
    assert centroids == exact
    assert got == [(i, k, d if d < 2**63 else None) for i, k, d in expected]


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    df = op13_bisectors(spark, sf_dir)
    expected = con.execute(f"select {', '.join(df.columns)} from ({OP13_SQL})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected)


def test_query_on_an_empty_table(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/embeddings.parquet").limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_bisectors(spark, str(tmp_path)).collect() == []
