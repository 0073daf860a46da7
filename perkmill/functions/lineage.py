"""Cutting lineage with a table in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it's unset, a folder in the warehouse. On a cluster that must be on
    a file system of all machines: a folder of each machine's own is an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if urlsplit(warehouse).scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_shared"


def new_folder(spark: SparkSession) -> str:
    """A name in the shared folder that nothing has yet, deleted with what else was cut."""
    path = f"{shared_folder(spark)}/perkmill/{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def cut(df: DataFrame, row_group_bytes: int | None = None) -> DataFrame:
    """Writes `df` once, for a result that several later steps read, and reads it back.

    A columnar table, so each reader scans only the columns it needs, and a lost executor costs
    a re-read, not a re-run of what came before. A writer holds a row group, and a reader the columns
    of one: `row_group_bytes` keeps it small where rows are long texts.
    """
    path = new_folder(df.sparkSession)
    writer = df.write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was cut inside; nothing that reads it may be left to run."""
    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN.remove(made)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, made):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
