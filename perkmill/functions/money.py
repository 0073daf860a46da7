"""Number rules shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(28,4)"


def percent_points(amount: Column, percent: Column) -> Column:
    """Whole points: double arithmetic, then floor."""
    return F.floor(amount.cast("double") * percent.cast("double") / F.lit(100.0)).cast("bigint")


def percent_exact(amount: Column, percent: Column) -> Column:
    """Percent of an amount in decimal, kept to four places."""
    share = amount.cast("decimal(20,6)") * percent.cast("decimal(10,0)")
    return F.round(share * F.lit("0.01").cast("decimal(3,2)"), 4).cast(AMOUNT)


def amount(value: Column) -> Column:
    return value.cast(AMOUNT)


def whole(value: Column) -> Column:
    """Drops the fraction, towards zero."""
    return value.cast("bigint")
