"""Independent steps side by side."""

from __future__ import annotations

import threading

import pytest

from perkmill.functions.together import together


def test_results_in_the_order_of_the_steps(spark):
    slow = threading.Event()

    def first():
        assert slow.wait(30)  # ends only once the second has run
        return spark.range(3).count()

    assert together(spark, first, lambda: slow.set() or spark.range(5).count()) == [3, 5]
    assert together(spark) == []


def test_an_error_is_raised_once_all_have_ended(spark):
    ended = []

    def fails():
        raise ValueError("first")

    def other():
        ended.append(spark.range(2).count())

    with pytest.raises(ValueError, match="first"):
        together(spark, fails, other, other)
    assert ended == [2, 2]


def test_job_groups_carry_over(spark):
    spark.sparkContext.setJobGroup("side by side", "")
    try:
        together(spark, lambda: spark.range(4).count(), lambda: spark.range(5).count())
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("side by side")) >= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_more_steps_than_threads(spark):
    assert together(spark, *[lambda k=k: spark.range(k).count() for k in range(20)]) == list(range(20))
