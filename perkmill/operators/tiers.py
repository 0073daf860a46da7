"""Tier upgrades and the free-shipping backfill. Both touch each account once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import ACTION_FREESHIP, ACTION_UPGRADE, FREESHIP, VIP_LEVEL, Params
from . import ledger
from .accounts import duplicate_account, with_account_rows

UPGRADE_JOB = "tier upgrade"
BACKFILL_JOB = "freeship backfill"


def tier_classify(account: DataFrame, tier_rule: DataFrame, p: Params) -> DataFrame:
    """Accounts past the year-point floor with the level they belong to: 1 below the begin of
    level 2, else 2. Without a rule for level 2 everyone counts as level 2."""
    second_from = tier_rule.filter(F.col("level_id") == 2).agg(F.max("num_point_begin_level")).scalar()
    return account.filter(F.col("fpoint_accrue_year") >= p.upgrade_floor).withColumn(
        "new_level", F.when(F.col("fpoint_accrue_year") < second_from, 1).otherwise(2)
    )


def tier_upgrade(classified: DataFrame, tier_rule: DataFrame, account: DataFrame) -> DataFrame:
    """Upward moves only, with the free-shipping award of the new level (null: no rule for it) and the
    reason one can't be made. A level listed twice awards the most."""
    award = tier_rule.groupBy(F.col("level_id").alias("new_level")).agg(F.max("num_freeship_award").alias("award"))
    moves = classified.filter(F.col("new_level") > F.col("vip_level")).join(award, "new_level", "left")
    reason = duplicate_account().when(F.col("award").isNull(), "no tier rule").when(F.col("email").isNull(), "no email")
    return (
        with_account_rows(moves, account)
        .withColumn("new_freeship", (F.col("num_freeship") + F.col("award")).cast("long"))
        .withColumn("reason", reason)
    )


def _payable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull())


def _day(p: Params) -> Column:
    """The run's date: a move made again on another day is another event."""
    return F.lit(f"{p.as_of:%Y-%m-%d}")


def tier_upgrade_ledger(upgrades: DataFrame, p: Params) -> DataFrame:
    """A level row and a free-shipping row per upgrade."""
    points = F.concat(F.lit(", year points "), F.col("fpoint_accrue_year").cast("string"))
    level_row = F.struct(
        F.lit(ACTION_UPGRADE).alias("action"),
        F.lit(VIP_LEVEL).alias("type"),
        (F.col("new_level") - F.col("vip_level")).cast("double").alias("value"),
        F.col("vip_level").cast("double").alias("amount_before"),
        F.col("new_level").cast("double").alias("amount_after"),
        F.concat(F.lit("level upgrade"), points).alias("description"),
    )
    ship_row = F.struct(
        F.lit(ACTION_FREESHIP).alias("action"),
        F.lit(FREESHIP).alias("type"),
        F.col("award").cast("double").alias("value"),
        F.col("num_freeship").cast("double").alias("amount_before"),
        F.col("new_freeship").cast("double").alias("amount_after"),
        F.concat(F.lit("free shipping for level upgrade"), points).alias("description"),
    )
    rows = (
        _payable(upgrades)
        .withColumn("row", F.explode(F.array(level_row, ship_row)))
        .select("customer_id", F.col("email").alias("account"), "new_level", "row.*", _day(p).alias("day"))
    )
    return ledger.ledger_rows(rows, UPGRADE_JOB, ["customer_id", "type", "new_level", "day"], p)


def upgrade_changes(upgrades: DataFrame) -> DataFrame:
    return ledger.changes(
        _payable(upgrades).select(
            "customer_id", F.col("new_level").alias("set_vip_level"), F.col("new_freeship").alias("set_freeship")
        )
    )


def upgrade_rejects(upgrades: DataFrame) -> DataFrame:
    return ledger.rejects(upgrades, UPGRADE_JOB, "customer_id", F.col("reason")).distinct()


def freeship_backfill(account: DataFrame, p: Params) -> DataFrame:
    """Free-shipping credits owed for the year points collected so far, and the reason some can't be
    given."""
    reached = F.floor(F.col("fpoint_accrue_year") / F.lit(p.freeship_step)).cast("long")
    owed = (
        account.filter(F.col("fpoint_accrue_year") > 0)
        .withColumn("reached", reached)
        .withColumn("owed", F.col("reached") - F.col("num_rewarded_freeship"))
        .filter((F.col("reached") > 0) & (F.col("owed") > 0))
        .withColumn("freeship_after", F.col("num_freeship") + F.col("owed"))
    )
    reason = duplicate_account().when(F.col("email").isNull(), "no email")
    return with_account_rows(owed, account).withColumn("reason", reason)


def backfill_ledger(owed: DataFrame, p: Params) -> DataFrame:
    rows = _payable(owed).select(
        "customer_id",
        F.col("email").alias("account"),
        F.lit(ACTION_FREESHIP).alias("action"),
        F.lit(FREESHIP).alias("type"),
        F.col("owed").alias("value"),
        F.col("num_freeship").alias("amount_before"),
        F.col("freeship_after").alias("amount_after"),
        "reached",
        F.concat(F.lit("free shipping owed, year points "), F.col("fpoint_accrue_year").cast("string")).alias("description"),
        _day(p).alias("day"),
    )
    return ledger.ledger_rows(rows, BACKFILL_JOB, ["customer_id", "reached", "day"], p)


def backfill_changes(owed: DataFrame) -> DataFrame:
    return ledger.changes(
        _payable(owed).select(
            "customer_id",
            F.col("freeship_after").alias("set_freeship"),
            F.col("reached").alias("set_rewarded_freeship"),
        )
    )


def backfill_rejects(owed: DataFrame) -> DataFrame:
    return ledger.rejects(owed, BACKFILL_JOB, "customer_id", F.col("reason")).distinct()
