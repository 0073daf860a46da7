"""Email lists exported from a spreadsheet as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut

# Fixed layout: the address is in the fourth column.
COLUMNS = "a string, b string, c string, email_raw string"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `line_no` (from 1 in each file) and `value` of every line, blank ones too, the same however
    the files are split for reading.

    A split begins at a byte of its file. The lines of each are counted, the counts added up along the
    file, and a line's number is its place in its split and the lines of those before it. The lines are
    written out with their place, so that both steps see the same.
    """
    read = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
    )
    lines = cut(read)
    splits = lines.groupBy("file", "split").agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    line_no = F.col("before") + F.col("place") - F.col("first") + 1
    return lines.join(starts, ["file", "split"]).select("file", line_no.alias("line_no"), "value")


def read_email_list(spark: SparkSession, path: str) -> DataFrame:
    """`line_no` and `email_raw` of every line, title rows included; a field with a line break in it isn't
    known."""
    fields = F.from_csv("value", COLUMNS)
    return numbered_lines(spark, path).select("line_no", fields["email_raw"].alias("email_raw"))
