"""Places of pattern matches in a text, with Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkmill.functions.localtime import place_in

from .common import let

SPAN = "struct<start:bigint,end:bigint,match:string>"
_LONGS = "array<bigint>"


def scan(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The values of an array of longs folded up to each place: `step` is a sum or a maximum, say.

    Appending to an array copies it. So the array is cut into about as many parts as a part has values;
    the parts' own folds are folded first, and each part goes on from there.
    """

    def appended(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("so_far"), F.array().cast(_LONGS).alias("out"))

        def add(acc: Column, x: Column) -> Column:
            now = F.when(acc["so_far"].isNull(), x).otherwise(step(acc["so_far"], x))
            return F.struct(now.alias("so_far"), F.concat(acc["out"], F.array(now)).alias("out"))

        return F.aggregate(part, zero, add, lambda acc: acc["out"])

    none = F.lit(None).cast("bigint")
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values))).cast("int"))

    def in_parts(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(v["v"])), v["size"])
        return F.transform(starts, lambda at: F.slice(v["v"], at, v["size"]))

    def go_on(parts: Column) -> Column:
        fold = lambda part: F.aggregate(part, none, lambda a, x: F.when(a.isNull(), x).otherwise(step(a, x)))
        before = let(appended(F.transform(parts, fold), none), lambda t: F.concat(F.array(none), F.slice(t, 1, F.size(t) - 1)))
        return let(before, lambda b: F.flatten(F.zip_with(parts, b, appended)))

    return let(F.struct(values.alias("v"), size.alias("size")), lambda v: let(in_parts(v), go_on))


def matches(text: Column, pattern: str) -> Column:
    """Array of `start`, `end` (code points, end exclusive) and `match` of the leftmost
    non-overlapping matches of a Java pattern, which mustn't match the empty string.

    What lies between matches comes from splitting at the pattern, so places are running sums of
    lengths. Texts without a match cost one search.
    """

    def placed(pair: Column) -> Column:
        gaps = F.slice(pair["gaps"], 1, F.size(pair["found"]))
        lengths = F.zip_with(gaps, pair["found"], lambda gap, m: (F.length(gap) + F.length(m)).cast("bigint"))
        span = lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))
        return F.zip_with(pair["found"], scan(lengths, lambda a, x: a + x), span)

    pair = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return F.when(text.rlike(pattern), let(pair, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def overlapped(spans: Column, others: Column, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """`body` is handed a test whether a span (`start`, `end`) overlaps one of `others`, sorted by start: of
    those that start before its end, found by halving, the furthest end is looked up."""
    known = F.struct(
        F.transform(others, lambda o: o["start"].cast("bigint")).alias("starts"),
        scan(F.transform(others, lambda o: o["end"].cast("bigint")), lambda a, x: F.greatest(a, x)).alias("ends"),
    )

    def test(k: Column) -> Callable[[Column], Column]:
        last = lambda s: place_in(k["starts"], s["end"] - 1)
        return lambda s: F.coalesce(F.get(k["ends"], last(s) - 1) > s["start"], F.lit(False))

    return let(known, lambda k: body(test(k)))
