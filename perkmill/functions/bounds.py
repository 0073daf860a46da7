"""Bounds that one side of a join puts on the other side's scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGES = "_id_ranges"


def _range_of(wanted: DataFrame, column: str) -> tuple[int | None, int | None]:
    """Lowest and highest id of a column. Those of all id columns are found in one go and kept with the
    frame."""
    known = wanted.__dict__.get(_RANGES)
    if known is None:
        ids = [c for c, kind in wanted.dtypes if c.endswith("_id") and kind == "bigint"]
        ends = wanted.agg(*[f(c).alias(f"{f.__name__} {c}") for c in ids for f in (F.min, F.max)]).first()
        known = wanted.__dict__[_RANGES] = {c: (ends[f"min {c}"], ends[f"max {c}"]) for c in ids}
    return known[column]


def between_ids(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows between the lowest and the highest wanted id: a bound that the scan can skip by. Hand over
    `wanted` written out, since it's read for its bounds at once."""
    low, high = _range_of(wanted, column)
    return rows.filter(F.lit(False) if low is None else F.col(column).between(low, high))
