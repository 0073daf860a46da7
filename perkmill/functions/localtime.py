"""UTC to shop-local time, look-back bounds and rule windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Params
from .lineage import cut


def ntz(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def local_time(utc: str, hours: int) -> Column:
    return F.col(utc).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def day_of(utc: str) -> str:
    """Name of the partition column that holds the UTC day of a timestamp, in tables laid out by day."""
    return f"{utc}_day"


def within(df: DataFrame, utc: str, low: Column, high: Column | None = None) -> Column:
    """`utc` from `low` on, up to `high` if given. In a table laid out by day its partitions are bounded,
    too, so that files of other days aren't opened."""
    day = day_of(utc) if day_of(utc) in df.columns else None
    bound = F.col(utc) >= low
    if day:
        bound = bound & (F.col(day) >= F.to_date(low))
    if high is not None:
        bound = bound & (F.col(utc) <= high)
        if day:
            bound = bound & (F.col(day) <= F.to_date(high))
    return bound


def local_since(df: DataFrame, utc: str, moment: datetime, p: Params) -> Column:
    """Local time at or after `moment`, as a bound on the stored column that reaches the scan."""
    return within(df, utc, ntz(moment - timedelta(hours=p.tz_offset_hours)))


def with_local_time(df: DataFrame, utc: str, p: Params) -> DataFrame:
    return df.withColumn("local_at", local_time(utc, p.tz_offset_hours))


EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Windows:
    """Rules by elementary interval. All starts and ends of windows cut time into intervals that each
    window holds whole or not at all; `rows` has a row per rule and interval of its window (`interval`
    is its number, `part_no` 0 is a rule's first), `cuts` are the starts and ends in order, as times since
    `EPOCH`.

    The rows of an interval are at most the rules, and a rule's rows at most twice the rules, however
    long its window is.
    """

    rows: DataFrame
    cuts: tuple[timedelta, ...]

    def where(self, condition: Column) -> Windows:
        return Windows(self.rows.filter(condition), self.cuts)

    def select(self, *columns: str) -> Windows:
        return Windows(self.rows.select(*columns, "interval", "part_no", "from_at", "until_at"), self.cuts)

    def once(self) -> DataFrame:
        """Each rule once, without its window."""
        return self.rows.filter(F.col("part_no") == 0).drop("interval", "part_no", "from_at", "until_at")

    def place(self, at: str) -> Column:
        """Number of the interval that a time lies in."""
        return place_in(F.array(*map(F.lit, self.cuts)), F.col(at) - ntz(EPOCH)) if self.cuts else F.lit(None).cast("int")


def place_in(cuts: Column, at: Column) -> Column:
    """How many of the sorted `cuts` lie at or before `at`, by halving; null without cuts or time."""
    halvings = F.sequence(F.lit(1), F.length(F.bin(F.size(cuts))).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        below = (span["low"] < span["high"]) & (F.get(cuts, middle) <= at)
        low = F.when(below, middle + 1).otherwise(span["low"])
        high = F.when(below | (span["low"] >= span["high"]), span["high"]).otherwise(middle)
        return F.struct(low.alias("low"), high.alias("high"))

    return F.when(at.isNotNull() & (F.size(cuts) > 0), F.aggregate(halvings, start, halve, lambda span: span["low"]))


def windows_of(rules: DataFrame) -> Windows:
    """Windows from `from_date` to `to_date`, both ends within; a rule whose window is empty or open at
    an end is in none.

    Rules are a shop's settings, so the driver may know their starts and ends, two for each at most. The
    rows are written out: Spark then knows their true size, and broadcasts them while it is small instead
    of shuffling what meets them.
    """
    just_after = F.col("to_date").cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(0.000001))
    ruled = cut(
        rules.filter(F.col("from_date") <= F.col("to_date"))
        .withColumn("from_at", F.col("from_date").cast("timestamp_ntz"))
        .withColumn("until_at", just_after)
        .drop("from_date", "to_date")
    )
    ends = ruled.select((F.col("from_at") - ntz(EPOCH)).alias("a"), (F.col("until_at") - ntz(EPOCH)).alias("b"))
    windows = Windows(ruled, tuple(sorted({t for r in ends.collect() for t in (r.a, r.b)})))
    inside = F.sequence(windows.place("from_at"), windows.place("until_at") - 1)
    return Windows(cut(ruled.select("*", F.posexplode(inside).alias("part_no", "interval"))), windows.cuts)


def match_windows(rows: DataFrame, windows: Windows) -> DataFrame:
    """Every row with every rule whose window holds it. Rows have their `local_at`, or their `interval`
    from `in_any_window`, so that what joins to them on the way isn't placed again."""
    placed = rows if "interval" in rows.columns else rows.withColumn("interval", windows.place("local_at"))
    return placed.join(windows.rows, "interval").drop("interval", "part_no", "from_at", "until_at")


def within_span(rows: DataFrame, utc: str, windows: Windows, p: Params) -> DataFrame:
    """Rows between the first start and the last end of all windows: a coarse bound on the stored
    column, which lets the scan skip what no rule can reach."""
    if not windows.cuts:
        return rows.filter(F.lit(False))
    return rows.filter(within(rows, utc, *(ntz(utc_of(t, p)) for t in (windows.cuts[0], windows.cuts[-1]))))


def utc_of(local: timedelta, p: Params) -> datetime:
    """The UTC time of a local time since `EPOCH`; the first or last there is where it lies beyond."""
    shifted = local - timedelta(hours=p.tz_offset_hours)
    return EPOCH + max(datetime.min - EPOCH, min(datetime.max - EPOCH, shifted))


def in_any_window(rows: DataFrame, windows: Windows) -> DataFrame:
    """Rows that at least one rule window holds, with their `interval`."""
    placed = rows.withColumn("interval", windows.place("local_at"))
    return placed.join(windows.rows.select("interval").distinct(), "interval", "left_semi")
