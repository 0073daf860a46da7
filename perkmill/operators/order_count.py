"""Bonus for the first orders of a new customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bounds import between_ids
from ..functions.lineage import cut
from ..functions.localtime import local_since
from ..functions.money import amount
from ..functions.running import running_totals
from ..params import ACTION_ORDER_COUNT, FPOINT, FREESHIP, Params
from . import ledger
from .accounts import duplicate_account, states_of

JOB = "order count"


def recent_orders(orders: DataFrame, p: Params) -> DataFrame:
    """Complete orders of the look-back."""
    return orders.filter(
        (F.col("status") == "complete")
        & (F.col("grand_total") > 0)
        & local_since(orders, "created_at", p.since_instant(p.order_count_days), p)
    ).select("order_id", "customer_id", "customer_email")


def new_customer_orders(orders: DataFrame, suborder: DataFrame, account: DataFrame, p: Params) -> DataFrame:
    """Complete recent orders, with a complete suborder, of new customers still warming up."""
    new = account.filter(
        local_since(account, "created_at", p.new_customer_from, p)
        & (F.col("finish_warm_up_period") == 0)
    ).select("customer_id")
    recent = cut(recent_orders(orders, p).join(new, "customer_id", "left_semi"))
    delivered = between_ids(suborder.filter(F.col("status") == "complete"), "order_id", recent).select("order_id")
    return recent.join(delivered, "order_id", "left_semi")


def order_ordinal(candidates: DataFrame, stored: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Numbers a customer's unpaid orders by id, on from the highest index the ledger holds. Hand over
    `candidates` written out."""
    unpaid = ledger.not_in_ledger(
        candidates, stored, F.col("number_order_rule") > 0, ["order_id", "customer_id"], [JOB], candidates
    )
    reached = (
        between_ids(ledger.rows_of(stored, JOB), "customer_id", candidates)
        .filter(F.col("index_order").isNotNull())
        .join(candidates.select("customer_id").distinct(), "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.max("index_order").cast("long").alias("start_index"))
    )
    numbered = running_totals(unpaid, ["customer_id"], ["order_id"], {"nth": F.lit(1)}, hot)
    return (
        numbered.join(cut(reached), "customer_id", "left")
        .withColumn("start_index", F.coalesce("start_index", F.lit(0).cast("long")))
        .withColumn("ordinal", F.col("start_index") + F.col("nth"))
        .drop("nth")
    )


def reachable(rules: DataFrame, p: Params) -> DataFrame:
    """Per rewarded ordinal, the lowest start index from which every ordinal up to it has a rule.

    A missing ordinal stalls the customer, so an ordinal counts only from behind the last gap.
    """
    running = rules.filter((F.col("end_status") == 0) & F.col("type").isin(FPOINT, FREESHIP))
    ordinals = running.select(F.col("number_order").alias("ordinal")).filter(
        F.col("ordinal").between(1, p.warm_up_orders)
    ).distinct()
    joined, unbroken, lowest = ordinals, F.lit(True), F.col("ordinal") - 1
    for back in range(1, p.warm_up_orders):
        earlier = ordinals.select((F.col("ordinal") + back).alias("ordinal"), F.lit(True).alias(f"has_{back}"))
        joined = joined.join(earlier, "ordinal", "left")
        unbroken = unbroken & F.coalesce(F.col(f"has_{back}"), F.lit(False))
        lowest = F.when(unbroken, F.col("ordinal") - 1 - back).otherwise(lowest)
    return joined.select("ordinal", lowest.alias("lowest_start"))


def payable_rules(rules: DataFrame, p: Params) -> DataFrame:
    """Running rules of the rewarded ordinals, with the start index they are reachable from. Cut
    the few rows before joining orders to them, so that Spark knows how few."""
    terms = rules.filter((F.col("end_status") == 0) & F.col("type").isin(FPOINT, FREESHIP)).select(
        "rule_id", "type", F.col("number_order").alias("ordinal"), "value"
    )
    return terms.join(reachable(rules, p), "ordinal")


def order_count_rewards(ordinals: DataFrame, payable: DataFrame, p: Params) -> DataFrame:
    """Orders whose ordinal is reachable, with each running rule for it."""
    return (
        ordinals.filter(F.col("ordinal") <= p.warm_up_orders)
        .join(payable, "ordinal")
        .filter(F.col("start_index") >= F.col("lowest_start"))
        .drop("lowest_start")
    )


def judge(rewards: DataFrame, account: DataFrame) -> DataFrame:
    """Adds account state and the reason a reward cannot be paid."""
    state = states_of(account, rewards, ["fpoint", "num_freeship"])
    reason = duplicate_account().when(F.col("customer_email").isNull(), "no email")
    return rewards.join(state, "customer_id").withColumn("reason", reason)


def order_count_ledger(judged: DataFrame, p: Params) -> DataFrame:
    """Ledger rows with the running balance per customer and type. A customer has at most
    `warm_up_orders` paid ordinals, each once per rule, so the window stays small."""
    start = F.when(F.col("type") == FREESHIP, amount(F.col("num_freeship"))).otherwise(amount(F.col("fpoint")))
    paid = running_totals(
        judged.filter(F.col("reason").isNull()),
        ["customer_id", "type"],
        ["ordinal", "rule_id"],
        {"paid": amount(F.col("value"))},
    )
    rows = paid.select(
        "customer_id",
        F.col("customer_email").alias("account"),
        F.lit(ACTION_ORDER_COUNT).alias("action"),
        "type",
        "value",
        (start + F.col("paid") - F.col("value")).cast("double").alias("amount_before"),
        (start + F.col("paid")).cast("double").alias("amount_after"),
        "order_id",
        F.col("rule_id").alias("number_order_rule"),
        F.col("ordinal").alias("index_order"),
        F.concat(
            F.lit("order number "), F.col("ordinal").cast("string"), F.lit(" of a new customer, order "),
            F.col("order_id").cast("string"),
        ).alias("description"),
    )
    return ledger.ledger_rows(rows, JOB, ["order_id", "number_order_rule"], p)


def finish_warm_up(ordinals: DataFrame, rules: DataFrame, p: Params) -> DataFrame:
    """Customers past the last rewarded ordinal: their index gets there and an order is left over."""
    last = p.warm_up_orders
    full_run = reachable(rules, p).filter(F.col("ordinal") == last).agg(F.max("lowest_start")).scalar()
    return (
        ordinals.filter((F.col("ordinal") > last) & (F.col("start_index") >= F.coalesce(full_run, F.lit(last))))
        .select("customer_id")
        .distinct()
    )


def account_changes(rows: DataFrame, finished: DataFrame) -> DataFrame:
    flags = finished.withColumn("set_finish_warm_up", F.lit(1))
    return ledger.changes(ledger.added(rows).drop("set_finish_warm_up").join(flags, "customer_id", "full"))


def reject_rows(judged: DataFrame) -> DataFrame:
    return ledger.rejects(judged, JOB, "order_id", F.col("reason"))
