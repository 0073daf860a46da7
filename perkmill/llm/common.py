"""What the operators share: reading tables, free column names, Arrow batch size, inline names."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch at most. Texts are long, and a Python worker holds a batch and its result.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20
#: Rows that a parquet reader decodes at a time: it holds them all, and texts are long.
READ_ROWS = 512


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: list = [None]


def ready_for_python(spark: SparkSession) -> None:
    """Gives executors this package, by Spark's own file server, and lowers the session's Arrow batch
    to `BATCH_ROWS` rows and `BATCH_BYTES` bytes, and its parquet readers' to `READ_ROWS` rows (smaller
    settings stay). One row is a batch whatever its bytes."""
    if _SHIPPED[0] is not spark.sparkContext:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="perkmill-")) / "perkmill.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for path in sorted(package.rglob("*.py")):
                z.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED[0] = spark.sparkContext
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)):
        now = int(spark.conf.get(key))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names made from `names` that `df` doesn't have in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often `body` names it.

    Spark inlines expressions into higher-order functions, where they'd be computed per element.
    """
    return F.transform(F.array(value), body)[0]


def row_key(df: DataFrame, text: str) -> Column:
    """Names a row by its content: the same in every reading of a table, so what's found of a row is
    joined back to it without writing its text again. Rows that are alike in everything share a name."""
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    rest = F.hex(F.xxhash64(*others)) if others else F.lit("")
    return F.concat(F.sha2(exact_text(text), 256), F.when(F.col(text).isNull(), "-").otherwise("+"), rest)


def exact_text(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
