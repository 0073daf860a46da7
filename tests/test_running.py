from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from perkmill.functions.running import hot_keys, running_totals


def rows(seed: int):
    """One key owns most rows; ids are sparse and unique; leads repeat."""
    rng = random.Random(seed)
    out = []
    for key in [1] * 400 + [2] * 30 + list(range(3, 40)):
        out.append((key, rng.randrange(4), 0, rng.randrange(-5, 50)))
    ids = rng.sample(range(100_000), len(out))
    return [(k, lead, i, d) for (k, lead, _, d), i in zip(out, ids)]


def expected(data, descending: bool, with_lead: bool):
    totals, result = {}, {}
    order = lambda r: ((-r[1] if descending else r[1]) if with_lead else 0, r[2])
    for key, lead, i, delta in sorted(data, key=order):
        total, n = totals.get(key, (0, 0))
        totals[key] = result[i] = (total + delta, n + 1)
        totals[key] = result[i]
    return result


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("order", [["id"], ["lead", "id"], ["-lead", "id"]])
@pytest.mark.parametrize("min_rows", [10, 100, 10_000])
def test_running_totals(spark, seed, order, min_rows):
    data = rows(seed)
    df = spark.createDataFrame(data, "key long, lead int, id long, delta long")
    hot = hot_keys(df, ["key"], min_rows)
    assert (hot is None) == (min_rows == 10_000)
    got = running_totals(
        df, ["key"], order, {"total": F.col("delta"), "nth": F.lit(1)}, hot, ranges=9
    )
    assert set(got.columns) == {"key", "lead", "id", "delta", "total", "nth"}
    assert {r["id"]: (r["total"], r["nth"]) for r in got.collect()} == expected(
        data, order[0] == "-lead", len(order) == 2
    )


def test_hot_listed_by_part_of_the_keys(spark):
    data = rows(3)
    df = spark.createDataFrame(data, "key long, lead int, id long, delta long")
    totals = {"total": F.col("delta")}
    plain = running_totals(df, ["key", "lead"], ["id"], totals)
    split = running_totals(df, ["key", "lead"], ["id"], totals, hot_keys(df, ["key"], 50), ranges=5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(plain.columns).collect()))


@pytest.mark.parametrize("apart", [1, 2_000, 5_000_000])
def test_hot_key_is_spread_over_tasks(spark, apart):
    """Rows per range are even however far the ids lie apart, and ranges are few."""
    df = spark.range(20_000).select(F.lit(1).cast("long").alias("key"), (F.col("id") * apart).alias("id"), F.lit(1).alias("d"))
    hot = hot_keys(df, ["key"], 1_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_totals(df, ["key"], ["id"], {"n": F.col("d")}, hot, ranges=40)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20_000
    assert max(sizes) < 12_000
    assert got.filter(f"n <> id / {apart} + 1").isEmpty()
    cuts = df.agg(F.percentile_approx("id", [i / 40 for i in range(1, 40)], 800)).first()[0]
    rows = [r["count"] for r in df.groupBy(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("id")))).count().collect()]
    assert len(rows) <= 40 and max(rows) <= 600
