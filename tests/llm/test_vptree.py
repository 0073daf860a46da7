import numpy as np
from pyspark.sql import functions as F

from perkmill.llm import vptree


def brute(ids, x, asked, k):
    """The k nearest ids to each asked one."""
    out = {}
    for i in asked:
        own = x[list(ids).index(i)]
        c = x @ own / np.sqrt((x * x).sum(1)) / np.sqrt(own @ own)
        order = sorted((-s, j) for s, j in zip(c, ids, strict=True) if j != i)
        out[i] = [(j, -s) for s, j in order[:k]]
    return out


def clustered(n, dim=8, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (20, dim))
    return centres[rng.integers(0, 20, n)] + rng.normal(0, 0.15, (n, dim))


def test_factor_one_is_exact_and_prunes():
    x = vptree.unit_rows(clustered(3000))
    tree, names = vptree.Tree(x), np.arange(3000)
    best, _ = tree.search(x[:50], names[:50], names, 5, 1.0)
    sims = x[:50] @ x.T
    sims[np.arange(50), np.arange(50)] = -9
    assert (np.sort(np.take_along_axis(sims, best, 1)) == np.sort(np.sort(sims, axis=1)[:, -5:])).all()


def test_smaller_factor_gives_up_recall_not_order():
    x = vptree.unit_rows(clustered(3000))
    names = np.arange(3000)
    exact, _ = vptree.Tree(x).search(x[:100], names[:100], names, 5, 1.0)
    recall = []
    for factor in (vptree.FACTOR, 0.1):
        best, far = vptree.Tree(x).search(x[:100], names[:100], names, 5, factor)
        assert (np.diff(far, axis=1) >= 0).all()
        recall.append(np.mean([len({*a} & {*b}) / 5 for a, b in zip(best, exact, strict=True)]))
    assert recall[0] >= 0.95 and recall[1] < 1


def test_query_recall(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 64)
    rows = [r for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r.embedding is not None]
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, x, [i for i in ids if i % 50 == 0], 5)
    got = {}
    for r in vptree.op6_vptree(spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys()
    hits = 0
    for i, near in got.items():
        assert sorted(near) == list(range(1, len(near) + 1)) and len(near) == min(5, len(ids) - 1)
        assert [near[r][1] for r in sorted(near)] == sorted((s for _, s in near.values()), reverse=True)
        hits += len({j for j, _ in near.values()} & {j for j, _ in want[i]})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [2.0, 0.0]), (50, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0])]
    rows += [(8, [float("inf"), 1.0]), (7, [0.0, 1e-200]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [1e300, 0.0]), (10, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, shard string")
    got = sorted(tuple(r) for r in vptree.nearest(spark, df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 9, 1.0), (0, 2, 50, 1.0), (0, 3, 7, 0.0), (50, 1, 0, 1.0), (50, 2, 9, 1.0), (50, 3, 7, 0.0)]
    assert vptree.nearest(spark, df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_nothing_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 16)
    x = clustered(2000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = vptree.nearest(spark, df, F.col("vec_id") % 50 == 0)
    assert len(found.collect()) == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan


def test_cells_blocks_and_dimensions_are_all_met(spark, monkeypatch):
    """Single and double precision, two dimensions, many cells and shards, and blocks that end between batches."""
    monkeypatch.setattr(vptree, "SHARD_ROWS", 64)
    monkeypatch.setattr(vptree, "BLOCK_ROWS", 30)
    rows = [(i, v) for dim in (4, 8) for i, v in enumerate(clustered(1500, dim).astype(np.float32).tolist(), 10000 * dim)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = {}
        for r in vptree.nearest(spark, df, F.col("vec_id") % 10 == 0, factor=1.0).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert len(got) == 300
        for dim in (4, 8):
            own = [r for r in rows if len(r[1]) == dim]
            want = brute([i for i, _ in own], np.array([v for _, v in own]), [i for i, _ in own if i % 10 == 0], 5)
            for i, near in want.items():
                assert [(n, j) for n, j, _ in sorted(got[i])] == [(n, j) for n, (j, _) in enumerate(near, 1)]
                assert np.allclose([s for _, _, s in sorted(got[i])], [s for _, s in near], rtol=1e-12)


def test_equal_points_come_by_id(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 700)
    df = spark.createDataFrame([(i, [1.0, 0.0, 0.0] if i % 4 else [0.0, 1.0, 0.5]) for i in range(2000)], "vec_id long, embedding array<float>")
    got = vptree.nearest(spark, df, F.col("vec_id").isin(1, 1000)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(1, j) for j in (2, 3, 5, 6, 7)] + [(1000, j) for j in (0, 4, 8, 12, 16)]
