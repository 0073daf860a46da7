"""Running totals per key that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

# A key with more rows than this is split over several tasks.
HOT_ROWS = 500_000
# Ranges that a hot key's rows are cut into, about equal in rows.
RANGES = 256


def hot_keys(rows: DataFrame, keys: list[str], min_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys owning more than `min_rows` rows, or None if there are none.

    The count is pre-aggregated on the map side. `rows` may be any superset of the rows that are
    later totalled: the answer only picks the plan, never the result.
    """
    hot = rows.groupBy(*keys).count().filter(F.col("count") > min_rows).select(*keys)
    return None if hot.isEmpty() else cut(hot)


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    hot: DataFrame | None = None,
    ranges: int = RANGES,
) -> DataFrame:
    """Adds each of `totals` summed over its key up to and including the row.

    `order` must be total within a key and end in an ascending long id; a leading "-" on another
    column means descending. Without hot keys this is one window. With them, a hot key's rows are
    cut at quantiles of their ids, each range is totalled by itself, and the sum of the ranges
    before it is added: a window sees about one in `ranges` of a key's rows however its ids lie,
    and the rows of one key that meet in a window are one per range. `hot` may list keys by a part of
    `keys`. With hot keys `df` is read thrice, so hand over one that is cheap to read again
    (`lineage.cut`).
    """
    ordering = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]
    until_here = (Window.unboundedPreceding, Window.currentRow)
    if hot is None:
        window = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(*until_here)
        return df.withColumns({n: F.sum(c).over(window) for n, c in totals.items()})

    *lead, last = order
    lead_of = {f"_lead{i}": c for i, c in enumerate(lead)}
    parts = [*keys, *lead_of, "_chunk"]
    rows = df.join(hot.withColumn("_hot", F.lit(True)), hot.columns, "left")
    # Rows of ordinary keys keep null parts, hence stay together and take no offset.
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = df.join(hot, hot.columns, "left_semi").groupBy(*hot.columns).agg(
        F.percentile_approx(F.col(last).cast("long"), cuts, 20 * ranges).alias("_bounds")
    )
    below = F.size(F.filter("_bounds", lambda bound: bound < F.col(last)))
    rows = rows.join(bounds, hot.columns, "left").withColumns(
        {name: F.when(F.col("_hot"), F.col(c.removeprefix("-"))) for name, c in lead_of.items()}
        | {"_chunk": F.when(F.col("_hot"), below)}
    ).drop("_bounds")
    range_order = [
        F.col(name).desc() if c.startswith("-") else F.col(name).asc() for name, c in lead_of.items()
    ]
    ranges_before = (
        Window.partitionBy(*keys)
        .orderBy(*range_order, F.col("_chunk"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.filter(F.col("_hot"))
        .groupBy(*parts)
        .agg(*[F.sum(c).alias(n) for n, c in totals.items()])
        .select(*parts, *[F.sum(n).over(ranges_before).alias(f"_before_{n}") for n in totals])
    )
    within = Window.partitionBy(*parts).orderBy(*ordering).rowsBetween(*until_here)
    return (
        rows.join(offsets, parts, "left")
        .repartition(*parts)
        .withColumns(
            {
                n: F.sum(c).over(within) + F.coalesce(F.col(f"_before_{n}"), F.lit(0))
                for n, c in totals.items()
            }
        )
        .drop("_hot", "_chunk", *lead_of, *[f"_before_{n}" for n in totals])
    )
