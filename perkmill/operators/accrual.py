"""Base accrual: points per delivered suborder and free-shipping milestones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bounds import between_ids
from ..functions.lineage import cut
from ..functions.localtime import ntz, within
from ..functions.money import amount, percent_points, whole
from ..functions.running import running_totals
from ..params import ACTION_ACCRUE, ACTION_FREESHIP, ATTR_COMPANY, ATTR_NOT_CONFIRMED, FPOINT, FREESHIP, Params
from . import ledger
from .accounts import company_of, company_tier_percent, states_of
from .pricing import SUBORDER_KEY

JOB = "accrual"
FEES = ["cod_fee", "shipping_fee", "discount_amount", "giftwrap_fee", "tryout_discount"]
STATE = ["email", "fpoint", "vip_level", "num_freeship", "fpoint_accrue_year", "num_rewarded_freeship"]


def recent_suborders(suborder: DataFrame, p: Params) -> DataFrame:
    """Root suborders, complete, delivered within the look-back, that the shop hasn't stamped."""
    return suborder.filter(
        F.col("parent_id").isNull()
        & (F.col("status") == "complete")
        & within(suborder, "delivery_timestamp", ntz(p.since_midnight(p.accrual_days)))
        & (F.col("f_point_amount") == 0)
    ).select(*SUBORDER_KEY, *FEES)


def unpaid_suborders(
    suborder: DataFrame, orders: DataFrame, attr: DataFrame, stored: DataFrame, stamps: DataFrame | None, p: Params
) -> DataFrame:
    """Recent suborders of confirmed customers that aren't paid yet: neither stamped by an earlier run
    (`stamps`) nor in the ledger.

    The recent ones are written out first: their ids bound what is read of ledger, stamps and
    orders. The amount's inner join on items drops a suborder without countable ones.
    """
    recent = cut(recent_suborders(suborder, p))
    paid = F.col("action").isin(ACTION_ACCRUE, ACTION_FREESHIP) & F.col("suborder_id").isNotNull()
    unpaid = ledger.not_in_ledger(recent, stored, paid, ["suborder_id"], [JOB], recent)
    if stamps is not None:
        stamped = between_ids(stamps, "suborder_id", recent).select(*SUBORDER_KEY).distinct()
        unpaid = unpaid.join(stamped, SUBORDER_KEY, "left_anti")
    buyers = between_ids(orders, "order_id", recent).filter(F.col("customer_id").isNotNull()).select("order_id", "customer_id")
    unconfirmed = attr.filter(
        (F.col("attribute_id") == ATTR_NOT_CONFIRMED) & F.col("value").isNotNull()
    ).select("customer_id")
    return unpaid.join(buyers, "order_id").join(unconfirmed, "customer_id", "left_anti")


def account_unique_guard(amounts: DataFrame, unpaid: DataFrame, account: DataFrame, attr: DataFrame) -> DataFrame:
    """Adds account state and `guard_rows`, the number of (account, company attribute) rows of
    the customer. Only suborders with exactly one may be paid. `unpaid` holds all customers of
    `amounts`, at less cost."""
    own = attr.join(unpaid.select("customer_id").distinct(), "customer_id", "left_semi")
    state = states_of(account, unpaid, STATE, company_of(own, ATTR_COMPANY))
    return (
        amounts.join(state, "customer_id", "left")
        .withColumn(
            "guard_rows", F.coalesce(F.col("account_rows") * F.coalesce("attr_rows", F.lit(0)), F.lit(0))
        )
        .drop("attr_rows")
    )


def judge(guarded: DataFrame, company: DataFrame, company_rule: DataFrame, tier_rule: DataFrame) -> DataFrame:
    """Adds the percent and the reason a suborder cannot be paid, null when it can."""
    reason = (
        F.when(F.coalesce("account_rows", F.lit(0)) == 0, "no account")
        .when(F.col("account_rows") > 1, "duplicate account")
        .when(F.col("guard_rows") == 0, "no company attribute")
        .when(F.col("guard_rows") > 1, "duplicate company attribute")
        .when(F.col("email").isNull(), "no email")
        .when(F.col("amount").isNull(), "no amount")
        .when((F.col("amount") > 0) & F.col("percent").isNull(), "no tier rule")
    )
    return company_tier_percent(guarded, company, company_rule, tier_rule).withColumn("reason", reason)


def suborder_points(judged: DataFrame) -> DataFrame:
    """Payable suborders with their points."""
    return (
        judged.filter(F.col("reason").isNull() & (F.col("amount") > 0))
        .withColumn("points", percent_points(F.col("amount"), F.col("percent")))
        .drop("reason", "account_rows", "guard_rows", "percent")
    )


def running_point_balance(points: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Point balance and year total around each suborder, in suborder id order.

    The stored balance is truncated to whole points first.
    """
    start, year = whole(F.col("fpoint")), F.col("fpoint_accrue_year").cast("long")
    totals = {"earned": F.col("points"), "seq": F.lit(1)}
    return running_totals(points, ["customer_id"], ["suborder_id"], totals, hot).withColumns(
        {
            "balance_before": start + F.col("earned") - F.col("points"),
            "balance_after": start + F.col("earned"),
            "accrue_before": year + F.col("earned") - F.col("points"),
            "accrue_after": year + F.col("earned"),
        }
    )


def freeship_milestone(balances: DataFrame, p: Params, hot: DataFrame | None = None) -> DataFrame:
    """One free-shipping credit per `freeship_step` points of the year, net of those rewarded.

    Once a customer has reached a milestone the rewarded count equals the milestone count of the
    previous suborder, also when it was higher before.
    """
    if hot is not None:
        balances = cut(balances)
    step = F.lit(p.freeship_step)
    reached = F.floor(F.col("accrue_after") / step)
    reached_before = F.floor(F.col("accrue_before") / step)
    rewarded_before = F.when((F.col("seq") > 1) & (F.col("reached_before") > 0), F.col("reached_before")).otherwise(
        F.col("num_rewarded_freeship")
    )
    granted = (
        balances.withColumns({"reached": reached, "reached_before": reached_before})
        .withColumn("rewarded_before", rewarded_before.cast("long"))
        .withColumns(
            {
                "freeship_grant": F.when(
                    F.col("reached") > 0, F.greatest(F.lit(0), F.col("reached") - F.col("rewarded_before"))
                )
                .otherwise(0)
                .cast("long"),
                "rewarded_after": F.when(F.col("reached") > 0, F.col("reached"))
                .otherwise(F.col("rewarded_before"))
                .cast("long"),
            }
        )
        .drop("reached", "reached_before")
    )
    return running_totals(
        granted, ["customer_id"], ["suborder_id"], {"granted": F.col("freeship_grant")}, hot
    ).withColumn("freeship_after", F.col("num_freeship").cast("long") + F.col("granted"))


def accrual_ledger(accrued: DataFrame, p: Params) -> DataFrame:
    """One point row per suborder that earned points, one free-shipping row per grant."""
    number = lambda c: F.col(c).cast("long").cast("string")
    company = F.when(F.col("company_code") != "", F.concat(F.lit(", company "), F.col("company_code"))).otherwise("")
    point_row = F.struct(
        F.lit(ACTION_ACCRUE).alias("action"),
        F.lit(FPOINT).alias("type"),
        F.col("points").cast("double").alias("value"),
        F.col("balance_before").cast("double").alias("amount_before"),
        F.col("balance_after").cast("double").alias("amount_after"),
        F.concat(
            F.lit("points for delivered suborder, amount "), number("amount"), F.lit(", level "),
            number("vip_level"), company,
        ).alias("description"),
    )
    ship_row = F.struct(
        F.lit(ACTION_FREESHIP).alias("action"),
        F.lit(FREESHIP).alias("type"),
        F.col("freeship_grant").cast("double").alias("value"),
        (F.col("freeship_after") - F.col("freeship_grant")).cast("double").alias("amount_before"),
        F.col("freeship_after").cast("double").alias("amount_after"),
        F.concat(
            F.lit("free shipping per milestone, year points "), number("accrue_after"),
            F.lit(", rewarded before "), number("rewarded_before"),
        ).alias("description"),
    )
    rows = (
        accrued.withColumn("row", F.explode(F.array(point_row, ship_row)))
        .filter(F.col("row.value") > 0)
        .select("customer_id", F.col("email").alias("account"), "order_id", "suborder_id", "company_code", "row.*")
    )
    return ledger.ledger_rows(rows, JOB, ["type", "suborder_id"], p)


def suborder_stamps(points: DataFrame) -> DataFrame:
    """The points paid on each suborder, for later runs not to pay them again."""
    return points.select(*SUBORDER_KEY, F.col("points").cast("int").alias("f_point_amount"))


def stamped(suborder: DataFrame, stamps: DataFrame) -> DataFrame:
    """The suborder table with the points paid on each suborder."""
    paid = stamps.groupBy(*SUBORDER_KEY).agg(F.max("f_point_amount").alias("paid"))
    return suborder.join(paid, SUBORDER_KEY, "left").withColumn(
        "f_point_amount", F.coalesce("paid", "f_point_amount").cast("int")
    ).select(*suborder.columns)


def account_changes(accrued: DataFrame) -> DataFrame:
    """State after each customer's last suborder. The rewarded count is not a sum, so it is set."""
    per_customer = accrued.groupBy("customer_id").agg(
        amount(F.max(whole(F.col("fpoint"))) + F.sum("points")).alias("set_fpoint"),
        (F.max("fpoint_accrue_year") + F.sum("points")).alias("set_accrue_year"),
        (F.max("num_freeship") + F.sum("freeship_grant")).alias("set_freeship"),
        F.max_by("rewarded_after", "suborder_id").alias("set_rewarded_freeship"),
    )
    return ledger.changes(per_customer)


def reject_rows(judged: DataFrame) -> DataFrame:
    return ledger.rejects(judged, JOB, "suborder_id", F.col("reason"))
