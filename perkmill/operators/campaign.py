"""Rule-driven order campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bounds import between_ids
from ..functions.lineage import cut
from ..functions.localtime import Windows, in_any_window, match_windows, with_local_time, within_span
from ..functions.money import amount, percent_exact, percent_points
from ..functions.running import running_totals
from ..functions.text import id_list
from ..params import (
    CHEAPEST,
    FILTER_GRAND_TOTAL,
    FILTER_NUM_ITEM,
    FPOINT,
    FREESHIP,
    HIGHEST,
    ITEM_FILTERS,
    PROMO_FPOINT,
    PROMO_FREESHIP,
    Params,
)
from . import ledger
from .accounts import duplicate_account, states_of, tier_percent
from .pricing import SUBORDER_KEY, bundles_of, items_of, order_products

JOB = "campaign"


def join_rules(campaign: DataFrame, action: DataFrame, rule: DataFrame) -> DataFrame:
    """The rule table with its campaign's window and its action's terms."""
    return rule.join(campaign, "campaign_id").join(action, "action_id")


def active_campaign_rules(rules: DataFrame, filters: DataFrame, p: Params) -> DataFrame:
    """One row per running rule and filter; a rule without a cap gets the default one."""
    terms = filters.select(
        "rule_id",
        F.col("type").alias("filter_type"),
        F.col("action").alias("filter_action"),
        F.col("min_value").alias("filter_min"),
        F.col("max_value").alias("filter_max"),
        F.col("value").alias("filter_value"),
    )
    return (
        rules.filter(F.col("end_status") == 0)
        .withColumn("max_value", F.coalesce("max_value", F.lit(p.campaign_max)))
        .select("rule_id", "campaign_id", "action_name", "action", "value", "max_value", "from_date", "to_date")
        .join(terms, "rule_id")
    )


def combine_filters(active: DataFrame, p: Params) -> DataFrame:
    """One row per rule: all its filters hold together, so they fold into one test each.

    Bounds narrow; of lists only their number is kept here (`<attribute>_in`, `<attribute>_out`), their
    values are rows of `rule_lists`. A filter of unknown type, or an item filter without a list or an
    action, makes the rule match nothing.
    """
    kind, listed = F.col("filter_type"), F.col("filter_value").isNotNull()
    is_item = kind.isin(*ITEM_FILTERS) & listed & F.col("filter_action").isNotNull()
    bounds = {"total": kind == FILTER_GRAND_TOTAL, "count": kind == FILTER_NUM_ITEM}
    rule_columns = [c for c in active.columns if not c.startswith("filter_")]
    folds = []
    for name in ITEM_FILTERS:
        of_name = is_item & (kind == name)
        included = F.col("filter_action") == "include"
        folds += [F.count_if(of_name & included).alias(f"{name}_in"), F.count_if(of_name & ~included).alias(f"{name}_out")]
    for name, of_name in bounds.items():
        low = F.when(of_name, F.coalesce("filter_min", F.lit(0)))
        high = F.when(of_name, F.coalesce("filter_max", F.lit(p.campaign_max)))
        folds += [F.max(low).alias(f"{name}_min"), F.min(high).alias(f"{name}_max")]
    known = is_item | bounds["total"] | bounds["count"]
    folds.append(F.bool_and(F.coalesce(known, F.lit(False))).alias("usable"))
    return active.groupBy(*rule_columns).agg(*folds)


def rule_lists(active: DataFrame) -> DataFrame:
    """The values of the rules' item lists: per rule, attribute and value, how many include lists and
    how many exclude lists hold it. An include passes where all of them do."""
    kind, action = F.col("filter_type"), F.col("filter_action")
    listed = active.filter(kind.isin(*ITEM_FILTERS) & F.col("filter_value").isNotNull() & action.isNotNull())
    values = listed.select("rule_id", kind.alias("attribute"), action.alias("side"), F.explode(F.array_distinct(id_list("filter_value"))).alias("value"))
    return values.groupBy("rule_id", "attribute", "value").agg(
        F.count_if(F.col("side") == "include").alias("in_lists"), F.count_if(F.col("side") != "include").alias("out_lists")
    )


def complete_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("status") == "complete") & F.col("customer_id").isNotNull() & (F.col("grand_total") > 0)
    ).select("order_id", "customer_id", "customer_email", "grand_total", "created_at")


def complete_roots(suborder: DataFrame) -> DataFrame:
    return suborder.filter((F.col("status") == "complete") & F.col("parent_id").isNull()).select(
        "order_id", "suborder_id"
    )


def priced(item: DataFrame) -> DataFrame:
    return item.filter(F.col("price") > 0)


def root_orders(suborder: DataFrame, orders: DataFrame, p: Params) -> DataFrame:
    """Complete root suborders of complete orders, with the order's columns."""
    joined = complete_roots(suborder).join(complete_orders(orders), "order_id")
    return with_local_time(joined, "created_at", p).drop("created_at")


def orders_in_windows(orders: DataFrame, windows: Windows, p: Params) -> DataFrame:
    """Complete orders that some rule's window holds, with the `interval` of their local creation time in
    its place."""
    reachable = complete_orders(within_span(orders, "created_at", windows, p))
    return in_any_window(with_local_time(reachable, "created_at", p).drop("created_at"), windows).drop("local_at")


def wanted_suborders(
    suborder: DataFrame, orders: DataFrame, windows: Windows, p: Params, stored: DataFrame | None = None
) -> DataFrame:
    """Complete root suborders of orders that some rule's window holds and, where the ledger is given, no
    campaign has paid. The orders are written out first: their ids bound the scans of ledger and suborders."""
    inside = cut(orders_in_windows(orders, windows, p))
    unpaid = inside if stored is None else already_campaign_rewarded(inside, stored, inside)
    return between_ids(complete_roots(suborder), "order_id", inside).join(unpaid, "order_id")


def campaign_items(item: DataFrame, wanted: DataFrame, windows: Windows) -> DataFrame:
    """Priced items with every rule whose window holds the order's local creation time."""
    return match_windows(items_of(priced(item), wanted).join(wanted, SUBORDER_KEY), windows)


def global_item_exclusions(items: DataFrame, product: DataFrame, p: Params) -> DataFrame:
    """Drops the excluded SKUs and mid categories; an unknown SKU or category drops too."""
    kept = product.filter(
        ~F.col("sku").isin(*p.excluded_skus) & ~F.col("category_mid_id").isin(*p.excluded_mid_categories)
    )
    return items.join(kept.select("product_id", *ITEM_FILTERS), "product_id")


def rule_item_filter(items: DataFrame, lists: DataFrame) -> DataFrame:
    """Keeps (item, rule) rows whose item passes all item filters of the rule: its value is in every
    include list on the attribute and in no exclude list. A null value passes neither.

    Values are looked up by an equality, so a rule's list may be of any length.
    """
    for name in ITEM_FILTERS:
        own = lists.filter(F.col("attribute") == name).select(
            "rule_id", F.col("value").alias(name), F.col("in_lists").alias("_in"), F.col("out_lists").alias("_out")
        )
        zero = F.lit(0).cast("long")
        included = F.coalesce("_in", zero) == F.col(f"{name}_in")
        excluded = (F.col(f"{name}_out") > 0) & (F.col(name).isNull() | (F.coalesce("_out", zero) > 0))
        items = items.join(own, ["rule_id", name], "left").filter(included & ~excluded).drop("_in", "_out")
    return items


def campaign_order_agg(
    item: DataFrame,
    bundle: DataFrame,
    suborder: DataFrame,
    orders: DataFrame,
    product: DataFrame,
    windows: Windows,
    lists: DataFrame,
    p: Params,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Quantity and price extremes per rule and order over the items the rule accepts.

    Orders inside some window, and not yet paid where the ledger is given, are found and written out
    first; only their items are read on, and fold to one row per suborder and product. The rows a rule
    multiplies are folded again before they leave the task.
    """
    item_tests = [f"{n}_{side}" for n in ITEM_FILTERS for side in ("in", "out")]
    wanted = cut(wanted_suborders(suborder, orders, windows, p, stored))
    lines = order_products(items_of(priced(item), wanted), bundles_of(bundle, wanted)).join(wanted, SUBORDER_KEY)
    per_rule = match_windows(global_item_exclusions(lines, product, p), windows.select("rule_id", *item_tests))
    terms = windows.once().drop(*item_tests)
    return (
        rule_item_filter(per_rule, lists)
        .groupBy("rule_id", "order_id", "customer_id", "customer_email", "grand_total")
        .agg(
            F.sum("qty").cast("long").alias("qty"),
            F.min("min_price").alias("min_price"),
            F.max("max_price").alias("max_price"),
        )
        .join(terms, "rule_id")
    )


def rule_order_match(per_rule: DataFrame) -> DataFrame:
    """Keeps orders inside the rule's bounds on grand total and item count, ends included."""
    within = lambda c, b: F.col(f"{b}_min").isNull() | F.col(c).between(F.col(f"{b}_min"), F.col(f"{b}_max"))
    return per_rule.filter(within("grand_total", "total") & within("qty", "count")).drop(
        "total_min", "total_max", "count_min", "count_max"
    )


def already_campaign_rewarded(matched: DataFrame, stored: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Drops orders any campaign has paid."""
    return ledger.not_in_ledger(matched, stored, F.col("campaign_id") > 0, ["order_id"], [JOB], wanted)


def one_campaign_per_order(unpaid: DataFrame) -> DataFrame:
    """The highest rule per order among those whose action is known.

    An order has at most one row per running rule, so the window stays small.
    """
    known = F.col("action_name").isin(CHEAPEST, HIGHEST, PROMO_FPOINT) | (
        (F.col("action_name") == PROMO_FREESHIP) & (F.col("action") == "add")
    )
    by_rule = Window.partitionBy("order_id").orderBy(F.col("rule_id").desc())
    return (
        unpaid.filter(known).withColumn("rank", F.row_number().over(by_rule)).filter("rank = 1").drop("rank")
    )


def reward_cheapest_pct() -> Column:
    return F.least(percent_exact(F.col("min_price"), F.col("value")), amount(F.col("max_value")))


def reward_highest_pct() -> Column:
    return F.least(percent_exact(F.col("max_price"), F.col("value")), amount(F.col("max_value")))


def reward_promo_points() -> Column:
    """`add` pays the value; anything else pays the base points value - 1 times over."""
    base = percent_points(F.col("grand_total"), F.col("percent"))
    return amount(F.when(F.col("action") == "add", F.col("value")).otherwise(base * (F.col("value") - 1)))


def reward_promo_freeship() -> Column:
    return amount(F.col("value"))


def judge(winners: DataFrame, account: DataFrame, tier_rule: DataFrame) -> DataFrame:
    """Adds account state, the reward and its type, and the reason an order cannot be paid. Hand over
    `winners` written out."""
    state = states_of(account, winners, ["fpoint", "vip_level", "num_freeship"])
    name = F.col("action_name")
    reward = (
        F.when(name == CHEAPEST, reward_cheapest_pct())
        .when(name == HIGHEST, reward_highest_pct())
        .when(name == PROMO_FPOINT, reward_promo_points())
        .when(name == PROMO_FREESHIP, reward_promo_freeship())
    )
    reason = (
        F.when(F.coalesce("account_rows", F.lit(0)) == 0, "no account")
        .when(duplicate_account().isNotNull(), duplicate_account())
        .when(F.col("percent").isNull(), "no tier rule")
        .when(F.col("customer_email").isNull(), "no email")
        .when(F.col("reward").isNull(), "no price")
    )
    return (
        tier_percent(winners.join(state, "customer_id", "left"), tier_rule)
        .withColumn("reward", reward)
        .withColumn("reward_type", F.when(name == PROMO_FREESHIP, FREESHIP).otherwise(FPOINT))
        .withColumn("reason", reason)
    )


def payable(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull())


def campaign_ledger(judged: DataFrame, p: Params, hot: DataFrame | None = None) -> DataFrame:
    """Ledger rows with the running balance per customer and reward type, rules descending,
    then order id."""
    start = F.when(F.col("reward_type") == FREESHIP, amount(F.col("num_freeship"))).otherwise(amount(F.col("fpoint")))
    paid = running_totals(
        payable(judged),
        ["customer_id", "reward_type"],
        ["-rule_id", "order_id"],
        {"paid": F.col("reward")},
        hot,
    )
    rows = paid.select(
        "customer_id",
        F.col("customer_email").alias("account"),
        F.col("action_name").alias("action"),
        F.col("reward_type").alias("type"),
        F.col("reward").cast("double").alias("value"),
        (start + F.col("paid") - F.col("reward")).cast("double").alias("amount_before"),
        (start + F.col("paid")).cast("double").alias("amount_after"),
        "order_id",
        "campaign_id",
        F.col("rule_id").alias("campaign_rule_id"),
        F.concat(
            F.lit("campaign "), F.col("campaign_id").cast("string"), F.lit(" rule "),
            F.col("rule_id").cast("string"), F.lit(", items "), F.col("qty").cast("string"),
        ).alias("description"),
    )
    return ledger.ledger_rows(rows, JOB, ["order_id"], p)


def reject_rows(judged: DataFrame) -> DataFrame:
    return ledger.rejects(judged, JOB, "order_id", F.col("reason"))
