"""The given parquet tables as engine tables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.params import Params
from perkmill.schemas import LEDGER

from .bindings import BINDINGS

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
       "embeddings", "pages", "benchmark", "labels", "conversations"]

# Bindings the listed ones leave to the engine: registered companies, and the editor tables that
# fx_review holds joined.
EXTRA: dict[str, str] = {
    "fx_company": "select * from (values ('C1'), ('C2')) as t(company_id)",
    "fx_review_editor_log": """
select review_id, detail as review, author, author_id,
       cast(case when editor_type = 'staff' then 1 else 2 end as bigint) as editor_id
from fx_review""",
    "fx_review_editor": """
select distinct cast(case when editor_type = 'staff' then 1 else 2 end as bigint) as editor_id, editor_type
from fx_review""",
}
ALL = BINDINGS | EXTRA

# Spark has no hash aggregation for a maximum over strings, so Spark asks the same of fx_suborder
# with booleans: the maximum is 'F' when an 'F' is there and nothing above it.
SPARK_FORMS = ALL | {
    "fx_suborder": BINDINGS["fx_suborder"].replace(
        "max(l_linestatus) = 'F'", "bool_or(l_linestatus = 'F') and not bool_or(l_linestatus > 'F')"
    )
}

# Engine table to binding, where the name is not simply fx_<name>.
NAMES = {"orders": "fx_order", "ledger": "fx_prior_ledger"}

PARAMS = Params(
    as_of=datetime(2001, 8, 2),
    accrual_days=365,
    order_count_days=3650,
    referral_days=3650,
    excluded_products=(3, 5),
    excluded_skus=("7", "8"),
    excluded_mid_categories=("49", "50"),
)


def needed(sql: str, blocks: Mapping[str, str]) -> list[str]:
    """Names of `blocks` that `sql` uses, directly or through other blocks, in block order."""
    used: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in (words & blocks.keys()) - used:
            used.add(name)
            queue.append(blocks[name])
    return [name for name in blocks if name in used]


def with_blocks(sql: str, blocks: Mapping[str, str]) -> str:
    names = needed(sql, blocks)
    if not names:
        return sql
    return "with " + ",\n".join(f"{n} as ({blocks[n].strip()})" for n in names) + "\n" + sql


class Shop(Mapping):
    """Engine tables by name, over the parquet files of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            binding = NAMES.get(name, f"fx_{name}")
            if binding not in ALL:
                raise KeyError(name)
            self._frames[name] = self._load(binding)
        return self._frames[name]

    def __iter__(self):
        return iter(n.removeprefix("fx_") for n in ALL)

    def __len__(self):
        return len(ALL)

    def _load(self, binding: str) -> DataFrame:
        sql = f"select * from {binding}"
        text = with_blocks(sql, SPARK_FORMS)
        raw = {n: f"select * from testbed_{n}" for n in RAW if re.search(rf"\b{n}\b", text)}
        for name in raw:
            self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").createOrReplaceTempView(f"testbed_{name}")
        df = self.spark.sql(with_blocks(sql, raw | SPARK_FORMS))
        if binding == "fx_prior_ledger":
            have = set(df.columns)
            df = df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER])
        if binding == "fx_account":
            df = df.withColumn("created_at", df.created_on.cast("timestamp_ntz"))
        return df
