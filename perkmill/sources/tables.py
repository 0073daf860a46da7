"""Reading the shop's tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.localtime import day_of
from ..schemas import INPUTS, schema_of


#: Tables that grow by the day, and the time by whose UTC day they may be laid out.
DAYS = {"orders": "created_at", "suborder": "delivery_timestamp", "review": "created_at", "review_action": "created_at"}
_IDS = {"orders": "order_id", "suborder": "suborder_id", "review": "review_id", "review_action": "review_id"}


def write_by_day(df: DataFrame, root: str, name: str, files_a_day: int = 1) -> None:
    """Lays a table out by day: look-backs and rule spans then open the folders of their days only. A
    day's rows are dealt over `files_a_day` tasks by their id."""
    day = day_of(DAYS[name])
    dated = df.withColumn(day, F.to_date(DAYS[name]))
    dealt = dated.repartition(day, F.pmod(F.xxhash64(_IDS[name]), F.lit(files_a_day)))
    dealt.write.partitionBy(day).parquet(f"{root}/{name}")


def parquet_table(spark: SparkSession, root: str, name: str, by_day: bool = False) -> DataFrame:
    """One table of the contract, with its declared schema, and its day where it's laid out by day."""
    schema = schema_of(name)
    if by_day:
        schema = T.StructType([*schema.fields, T.StructField(day_of(DAYS[name]), T.DateType())])
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def parquet_tables(
    spark: SparkSession, root: str, names: list[str] | None = None, by_day: Collection[str] = ()
) -> dict[str, DataFrame]:
    """`by_day` names those that `write_by_day` laid out."""
    return {name: parquet_table(spark, root, name, name in by_day) for name in names or INPUTS}


def jdbc_table(
    spark: SparkSession,
    name: str,
    url: str,
    split_on: str,
    lowest: int,
    highest: int,
    readers: int,
    **options: str,
) -> DataFrame:
    """One table of the contract from a live database, read by `readers` ranges of `split_on`."""
    loaded = (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=name,
            partitionColumn=split_on,
            lowerBound=str(lowest),
            upperBound=str(highest),
            numPartitions=str(readers),
            **options,
        )
        .load()
    )
    return as_contract(loaded, name)


def as_contract(df: DataFrame, name: str) -> DataFrame:
    """The contract's columns in its types. A timestamp with a zone keeps its instant, as UTC."""
    kinds = dict(df.dtypes)
    utc = lambda c: F.to_utc_timestamp(c, F.current_timezone()) if kinds[c] == "timestamp" else F.col(c)
    return df.select(*[utc(f.name).cast(f.dataType).alias(f.name) for f in schema_of(name)])
