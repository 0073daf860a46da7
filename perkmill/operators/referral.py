"""Points for the owner of the refer code used on an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.localtime import ntz, within
from ..functions.money import amount, percent_exact
from ..functions.running import running_totals
from ..params import ACTION_REFER, FPOINT, Params
from . import ledger
from .accounts import duplicate_account, states_of

JOB = "referral"


def referrers(used: DataFrame, account: DataFrame, refer_rule: DataFrame) -> DataFrame:
    """One owner with terms per used refer code: the lowest customer id with an active code and rule.

    Chosen before orders are joined, so a code shared by many accounts multiplies nothing. A rule
    listed twice counts once.
    """
    terms = (
        refer_rule.filter(F.col("status") == 1)
        .groupBy(F.col("refer_rule_id").alias("refer_rule"))
        .agg(F.min(F.struct(F.col("action").alias("refer_action"), F.col("value").alias("refer_value"))).alias("terms"))
        .select("refer_rule", "terms.*")
    )
    codes = used.select("refer_code").distinct()
    active = account.filter((F.col("refer_status") == 1) & F.col("refer_code").isNotNull()).select(
        "customer_id", "refer_code", "refer_rule"
    )
    running = active.join(codes, "refer_code", "left_semi").join(terms, "refer_rule")
    owners = running.groupBy("refer_code").agg(F.min("customer_id").alias("customer_id"))
    rules = running.groupBy("refer_code", "customer_id").agg(F.min("refer_rule").alias("refer_rule"))
    return owners.join(rules, ["refer_code", "customer_id"]).join(terms, "refer_rule")


def used_codes(orders: DataFrame, p: Params) -> DataFrame:
    """Complete orders of the look-back that used a code."""
    return orders.filter(
        F.col("coupon_code").isNotNull()
        & F.col("customer_id").isNotNull()
        & (F.col("status") == "complete")
        & within(orders, "created_at", ntz(p.since_midnight(p.referral_days)))
    ).select("order_id", "grand_total", F.col("coupon_code").alias("refer_code"))


def referral_orders(orders: DataFrame, account: DataFrame, refer_rule: DataFrame, p: Params) -> DataFrame:
    """Complete recent orders with a referrer's code; `customer_id` is the referrer, with the number
    of account rows it has."""
    used = used_codes(orders, p)
    owners = referrers(used, account, refer_rule)
    states = states_of(account, owners, ["email", "fpoint"])
    return used.join(cut(owners.join(states, "customer_id")), "refer_code")


def already_referred(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Hand over `candidates` written out."""
    return ledger.not_in_ledger(candidates, stored, F.col("action") == ACTION_REFER, ["order_id"], [JOB], candidates)


def referral_reward(unpaid: DataFrame) -> DataFrame:
    """`add` pays the value, anything else that percent of the grand total, not floored."""
    reward = F.when(F.col("refer_action") == "add", amount(F.col("refer_value"))).otherwise(
        percent_exact(F.col("grand_total"), F.col("refer_value"))
    )
    return unpaid.withColumn("reward", reward)


def payable(rewards: DataFrame) -> DataFrame:
    return rewards.filter(reason().isNull())


def reason() -> Column:
    return duplicate_account().when(F.col("email").isNull(), "no email")


def referral_ledger(rewards: DataFrame, p: Params, hot: DataFrame | None = None) -> DataFrame:
    start = amount(F.col("fpoint"))
    paid = running_totals(payable(rewards), ["customer_id"], ["order_id"], {"paid": F.col("reward")}, hot)
    rows = paid.select(
        "customer_id",
        F.col("email").alias("account"),
        F.lit(ACTION_REFER).alias("action"),
        F.lit(FPOINT).alias("type"),
        F.col("reward").cast("double").alias("value"),
        (start + F.col("paid") - F.col("reward")).cast("double").alias("amount_before"),
        (start + F.col("paid")).cast("double").alias("amount_after"),
        "order_id",
        F.col("refer_rule").alias("refer_rule_id"),
        "refer_code",
        F.concat(
            F.lit("order "), F.col("order_id").cast("string"), F.lit(" used refer code "), F.col("refer_code")
        ).alias("description"),
    )
    return ledger.ledger_rows(rows, JOB, ["order_id"], p)


def reject_rows(rewards: DataFrame) -> DataFrame:
    return ledger.rejects(rewards, JOB, "order_id", reason())
