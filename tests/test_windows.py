"""Elementary intervals against a row-at-a-time test of every window."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from perkmill.functions.localtime import in_any_window, match_windows, place_in, windows_of

AT = datetime(2024, 1, 1)


def frames(spark, windows, times):
    rules = spark.createDataFrame([(i, *w) for i, w in enumerate(windows)], "rule int, from_date timestamp_ntz, to_date timestamp_ntz")
    return windows_of(rules), spark.createDataFrame([(i, t) for i, t in enumerate(times)], "row int, local_at timestamp_ntz")


@pytest.mark.parametrize("seed", range(3))
def test_every_row_meets_every_rule_that_holds_it(spark, seed):
    """Nested, equal, touching, one-instant, empty and open windows; rows at, just before and after ends."""
    rng = random.Random(seed)
    moment = lambda: AT + timedelta(hours=rng.randint(0, 40))
    windows = [(moment(), moment()) for _ in range(25)]
    windows += [(AT, AT), windows[0], (None, AT), (AT, None), (datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59))]
    ends = [t for w in windows for t in w if t and t.year in range(2, 9999)]
    times = [t + timedelta(microseconds=d) for t in ends for d in (-1, 0, 1)] + [None, datetime(1970, 1, 1), datetime(2100, 1, 1)]
    made, rows = frames(spark, windows, times)
    holds = lambda t, w: t is not None and None not in w and w[0] <= t <= w[1]
    expected = {(i, k) for i, t in enumerate(times) for k, w in enumerate(windows) if holds(t, w)}
    got = [(r["row"], r["rule"]) for r in match_windows(rows, made).select("row", "rule").collect()]
    assert sorted(got) == sorted(expected)
    some = [r["row"] for r in in_any_window(rows, made).collect()]
    assert sorted(some) == sorted({i for i, _ in expected})
    real = [w for w in windows if None not in w and w[0] <= w[1]]
    assert made.once().count() == len(real)
    assert made.rows.count() <= len(real) * 2 * len(real)
    assert made.rows.groupBy("interval").count().agg(F.max("count")).first()[0] <= len(real)


def test_a_part_of_the_rules_keeps_the_intervals(spark):
    made, rows = frames(spark, [(AT, AT + timedelta(days=9)), (AT + timedelta(days=3), AT + timedelta(days=5))], [AT + timedelta(days=d) for d in range(11)])
    only = match_windows(rows, made.where(F.col("rule") == 0))
    assert sorted(r["row"] for r in only.collect()) == list(range(10))


def test_no_rules(spark):
    made, rows = frames(spark, [], [AT])
    assert match_windows(rows, made).isEmpty() and in_any_window(rows, made).isEmpty()


def test_no_range_test_is_left_over(spark):
    """Rows meet rules by an equality alone."""
    made, rows = frames(spark, [(AT, AT)], [AT])
    text = match_windows(rows, made)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in text.splitlines() if "Join" in line)
    assert "<=" not in join and ">=" not in join and "interval" in join


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100])
def test_place_by_halving(spark, n):
    cuts = [AT + timedelta(hours=2 * i) for i in range(n)]
    times = [AT + timedelta(hours=h) for h in range(-1, 2 * n + 1)]
    df = spark.createDataFrame([(t, cuts) for t in times], "at timestamp_ntz, cuts array<timestamp_ntz>")
    got = [r["p"] for r in df.select("at", place_in(F.col("cuts"), F.col("at")).alias("p")).collect()]
    assert got == [sum(c <= t for c in cuts) if cuts else None for t in times]
