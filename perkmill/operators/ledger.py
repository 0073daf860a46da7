"""Ledger rows, account changes and rejects: what every job hands back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bounds import between_ids
from ..functions.money import amount
from ..params import FPOINT, FREESHIP, Params
from ..schemas import CHANGES, LEDGER, REJECTS


def _fit(df: DataFrame, schema) -> DataFrame:
    """Columns of `schema` in order; those `df` lacks are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def ledger_rows(df: DataFrame, job: str, key: list[str], p: Params) -> DataFrame:
    """Fits `df` to the ledger; `key` names the columns that tell the job's rows apart."""
    return _fit(
        df.withColumns(
            {
                "job": F.lit(job),
                "job_key": F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]),
                "updated_by": F.lit(p.updated_by),
                "last_updated": F.lit(p.as_of.isoformat(sep=" ")),
            }
        ),
        LEDGER,
    )


def append_new(stored: DataFrame, rows: DataFrame, jobs: list[str] | None = None) -> DataFrame:
    """Rows whose job key the stored ledger does not hold yet. Naming the `jobs` of `rows` lets a
    ledger partitioned by job skip the others' files."""
    stored = stored if jobs is None else stored.filter(F.col("job").isin(*jobs))
    held = stored.filter(F.col("job_key").isNotNull()).select("job", "job_key").distinct()
    return rows.join(held, ["job", "job_key"], "left_anti")


def rows_of(stored: DataFrame, *jobs: str) -> DataFrame:
    """Ledger rows of these jobs, and those taken over from before the engine, which name none. In a
    ledger split by job the others' files aren't read."""
    return stored.filter(F.col("job").isin(*jobs) | F.col("job").isNull())


def not_in_ledger(df: DataFrame, stored: DataFrame, held: Column, on: list[str], jobs: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """Drops rows already paid: those matching a ledger row of `jobs` with `held` true on `on`.

    `wanted`, if given, is `df` written out: the range of its ids (the first of `on`) bounds the ledger's
    scan. Ledger keys are made distinct first, so a key the ledger repeats is shuffled once per map task.
    """
    paid = rows_of(stored, *jobs).filter(held)
    if wanted is not None:
        paid = between_ids(paid, on[0], wanted)
    return df.join(paid.select(*on).distinct(), on, "left_anti")


def added(rows: DataFrame, value: str = "value", kind: str | Column = "type") -> DataFrame:
    """Account changes of a job that only adds, from its ledger rows or, cheaper, from the rewards
    before their running balances."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    total = lambda name: F.sum(F.when(kind == name, amount(F.col(value))))
    return changes(
        rows.groupBy("customer_id").agg(
            total(FPOINT).alias("add_fpoint"), total(FREESHIP).cast("long").alias("add_freeship")
        )
    )


def changes(df: DataFrame) -> DataFrame:
    return _fit(df, CHANGES)


def apply_changes(account: DataFrame, change: DataFrame) -> DataFrame:
    """New account snapshot: set values win, additions are added, the rest stays.

    `change` has at most one row per customer (`CHANGES`).
    """
    after = {
        "fpoint": F.coalesce("set_fpoint", F.col("fpoint") + F.coalesce("add_fpoint", F.lit(0))),
        "num_freeship": F.coalesce("set_freeship", F.col("num_freeship") + F.coalesce("add_freeship", F.lit(0))),
        "fpoint_accrue_year": F.coalesce("set_accrue_year", "fpoint_accrue_year"),
        "num_rewarded_freeship": F.coalesce("set_rewarded_freeship", "num_rewarded_freeship"),
        "vip_level": F.coalesce("set_vip_level", "vip_level"),
        "finish_warm_up_period": F.coalesce("set_finish_warm_up", "finish_warm_up_period"),
    }
    joined = account.join(change, "customer_id", "left")
    return joined.select(
        *[after.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in account.schema]
    )


def fold_changes(changes: DataFrame) -> DataFrame:
    """Changes of several runs (`run_id`) as one per customer: the last set value and what was added
    after it, or where nothing was set, all that was added.

    Windows hold one customer's runs since the last snapshot.
    """
    pairs = {"set_fpoint": "add_fpoint", "set_freeship": "add_freeship"}
    sets = [f.name for f in CHANGES if f.name.startswith("set_")]
    set_at = {c: F.max(F.when(F.col(c).isNotNull(), F.col("run_id"))).over(Window.partitionBy("customer_id")).alias(f"_{c}") for c in sets}
    dated = changes.select(*CHANGES.names, "run_id", *set_at.values())
    last = {c: F.max(F.when(F.col("run_id") == F.col(f"_{c}"), F.col(c))) for c in sets}
    after = {add: F.sum(F.when(F.col(f"_{c}").isNull() | (F.col("run_id") > F.col(f"_{c}")), F.col(add))) for c, add in pairs.items()}
    one = dated.groupBy("customer_id").agg(*[v.alias(k) for k, v in {**last, **after}.items()])
    total = {c: F.col(c) + F.coalesce(add, F.lit(0)) for c, add in pairs.items()}
    return _fit(one.withColumns(total), CHANGES)


def rejects(df: DataFrame, job: str, ref: str, reason: Column) -> DataFrame:
    """Rows a job could not pay, with the business id and the reason (null reason: no reject)."""
    return _fit(
        df.withColumns({"job": F.lit(job), "ref_id": F.col(ref), "reason": reason}), REJECTS
    ).filter(F.col("reason").isNotNull())
