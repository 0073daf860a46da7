"""One query per operator, over the bindings of `tables`."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut
from perkmill.functions.localtime import Windows, match_windows, ntz, windows_of, with_local_time
from perkmill.functions.together import together
from perkmill.operators import accounts, accrual, campaign, email_grant, ledger, order_count, pricing, referral, reviews, tiers
from perkmill.params import ATTR_COMPANY, CHEAPEST, HIGHEST, PROMO_FPOINT, PROMO_FREESHIP, Params
from perkmill.plans import jobs

from .tables import PARAMS, Shop

# The reviews are from 2024: a run after them, so that a rule's window spans months of its own.
REVIEW_PARAMS = replace(PARAMS, as_of=datetime(2024, 2, 2))

Query = Callable[[Shop, Params], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def out(df: DataFrame, spec: str) -> DataFrame:
    """Selects columns by name; ":l", ":d", ":s" cast to long, double, string."""
    types = {"l": "bigint", "d": "double", "s": "string"}
    columns = []
    for part in spec.split():
        name, _, kind = part.partition(":")
        columns.append(F.col(name).cast(types[kind or "l"]).alias(name))
    return df.select(*columns)


LEDGER = "customer_id account:s action:s type:s value:d amount_before:d amount_after:d "


# --- base accrual


@query
def eligible_suborders(t: Shop, p: Params) -> DataFrame:
    """Unpaid suborders with a countable item: those that get an amount."""
    return out(_amounts(t, p), "suborder_id order_id customer_id")


@query
def bundle_price(t: Shop, p: Params) -> DataFrame:
    df = pricing.bundle_price(t["suborder_item"], t["suborder_bundle"])
    return out(df, "suborder_id order_id product_id bundle_id eff_price:d eff_qty")


def _amounts(t: Shop, p: Params) -> DataFrame:
    return jobs.accrual_amounts(t, jobs.unpaid_suborders(t, p), p)


@query
def suborder_amount(t: Shop, p: Params) -> DataFrame:
    return out(_amounts(t, p), "suborder_id order_id customer_id amount:d")


@query
def account_unique_guard(t: Shop, p: Params) -> DataFrame:
    df = jobs.accrual_guarded(t, p)
    verdict = F.when(F.col("guard_rows") == 1, "ok").otherwise("reject")
    return out(df.withColumn("verdict", verdict), "suborder_id customer_id amount:d guard_rows verdict:s")


@query
def tier_percent(t: Shop, p: Params) -> DataFrame:
    return out(accounts.tier_percent(t["account"], t["tier_rule"]), "customer_id vip_level percent:d")


@query
def company_tier_percent(t: Shop, p: Params) -> DataFrame:
    guarded = accounts.company_of(t["account_attr"], ATTR_COMPANY).filter("attr_rows = 1")
    df = accounts.company_tier_percent(
        t["account"].join(guarded, "customer_id"), t["company"], t["company_tier_rule"], t["tier_rule"]
    )
    return out(df, "customer_id vip_level company_id:s percent:d company_code:s")


@query
def suborder_points(t: Shop, p: Params) -> DataFrame:
    df = accrual.suborder_points(jobs.accrual_judged(t, p))
    return out(df, "suborder_id customer_id amount:d company_code:s points")


def _accrued(t: Shop, p: Params) -> DataFrame:
    return jobs.accrual_state(t, p)[1]


@query
def running_point_balance(t: Shop, p: Params) -> DataFrame:
    return out(_accrued(t, p), "suborder_id customer_id points balance_before balance_after accrue_after")


@query
def freeship_milestone(t: Shop, p: Params) -> DataFrame:
    return out(_accrued(t, p), "suborder_id customer_id accrue_after freeship_grant freeship_after rewarded_after")


@query
def accrual_ledger(t: Shop, p: Params) -> DataFrame:
    df = accrual.accrual_ledger(_accrued(t, p), p)
    return out(df, LEDGER + "order_id suborder_id company_code:s description:s")


@query
def suborder_stamp(t: Shop, p: Params) -> DataFrame:
    """The suborder table as a second run sees it."""
    stamps = accrual.suborder_stamps(accrual.suborder_points(jobs.accrual_judged(t, p)))
    return out(accrual.stamped(t["suborder"], stamps), "suborder_id order_id status:s f_point_amount")


def _twice(t: Shop, p: Params) -> tuple[DataFrame, DataFrame]:
    """Ledger rows and accounts of two accrual runs over the same untouched tables, the second with
    what the first paid."""
    first = jobs.run_accrual(t, p)
    paid = cut(first.ledger)
    account = ledger.apply_changes(t["account"], first.changes)
    again = {name: t[name] for name in ACCRUAL_INPUTS} | {
        "account": cut(account),
        "ledger": t["ledger"].unionByName(paid),
    }
    second = jobs.run_accrual(again, p)
    return paid.unionByName(second.ledger), ledger.apply_changes(again["account"], second.changes)


ACCRUAL_INPUTS = [
    "suborder", "orders", "account_attr", "suborder_item", "suborder_bundle", "company", "company_tier_rule", "tier_rule",
]


@query
def accrual_paid_once(t: Shop, p: Params) -> DataFrame:
    return out(_twice(t, p)[0], LEDGER + "order_id suborder_id company_code:s description:s")


@query
def apply_ledger_twice(t: Shop, p: Params) -> DataFrame:
    return _snapshot(_twice(t, p)[1], None)


# --- campaigns


def _active(t: Shop, p: Params) -> DataFrame:
    return campaign.active_campaign_rules(t["campaign_rule"], t["campaign_rule_filter"], p)


def _windows(t: Shop, p: Params) -> Windows:
    return jobs.campaign_windows(_active(t, p), p)


@query
def active_campaign_rules(t: Shop, p: Params) -> DataFrame:
    """Running rules and filters, with the orders created in each rule's window."""
    active = _active(t, p)
    windows = windows_of(active.select("rule_id", "from_date", "to_date").distinct())
    orders = with_local_time(t["orders"].select("order_id", "created_at"), "created_at", p)
    counts = match_windows(orders, windows).groupBy("rule_id").agg(F.count("*").alias("orders_in_window"))
    df = active.join(counts, "rule_id", "left").withColumn("orders_in_window", F.coalesce("orders_in_window", F.lit(0)))
    return out(
        df,
        "rule_id campaign_id action_name:s action:s value max_value filter_type:s filter_action:s "
        "filter_min filter_max filter_value:s orders_in_window",
    )


@query
def campaign_items(t: Shop, p: Params) -> DataFrame:
    return out(_campaign_items(t, p), "rule_id order_id suborder_id product_id price:d qty customer_id grand_total:d")


def _campaign_items(t: Shop, p: Params) -> DataFrame:
    windows = _windows(t, p)
    wanted = cut(campaign.wanted_suborders(t["suborder"], t["orders"], windows, p))
    return campaign.campaign_items(t["suborder_item"], wanted, windows)


@query
def global_item_exclusions(t: Shop, p: Params) -> DataFrame:
    sold = campaign.root_orders(t["suborder"], t["orders"], p)
    items = campaign.priced(t["suborder_item"]).join(sold, pricing.SUBORDER_KEY)
    df = campaign.global_item_exclusions(items, t["product"], p)
    return out(df, "order_id suborder_id product_id sku:s category_main_id:s category_mid_id:s")


@query
def rule_item_filter(t: Shop, p: Params) -> DataFrame:
    items = _campaign_items(t, p)
    lists = jobs.campaign_lists(_active(t, p))
    df = campaign.rule_item_filter(campaign.global_item_exclusions(items, t["product"], p), lists)
    return out(df, "rule_id order_id suborder_id product_id")


def _order_agg(t: Shop, p: Params, stored: DataFrame | None = None) -> DataFrame:
    return campaign.campaign_order_agg(
        t["suborder_item"], t["suborder_bundle"], t["suborder"], t["orders"], t["product"],
        _windows(t, p), jobs.campaign_lists(_active(t, p)), p, stored,
    )


@query
def campaign_order_agg(t: Shop, p: Params) -> DataFrame:
    return out(_order_agg(t, p), "rule_id order_id qty min_price:d max_price:d")


@query
def rule_order_match(t: Shop, p: Params) -> DataFrame:
    return out(campaign.rule_order_match(_order_agg(t, p)), "rule_id order_id qty grand_total:d")


@query
def already_campaign_rewarded(t: Shop, p: Params) -> DataFrame:
    return out(campaign.rule_order_match(_order_agg(t, p, t["ledger"])), "rule_id order_id qty grand_total:d")


@query
def one_campaign_per_order(t: Shop, p: Params) -> DataFrame:
    return out(jobs.campaign_winners(t, _active(t, p), p), "order_id rule_id customer_id action_name:s")


def _campaign_judged(t: Shop, p: Params) -> DataFrame:
    return jobs.campaign_state(t, _active(t, p), p)[0]


def _reward_query(name: str, action: str) -> None:
    def run(t: Shop, p: Params) -> DataFrame:
        df = _campaign_judged(t, p).filter((F.col("action_name") == action) & F.col("reason").isNull())
        return out(df, "order_id customer_id rule_id reward_type:s reward:d")

    QUERIES[name] = run


_reward_query("reward_cheapest_pct", CHEAPEST)
_reward_query("reward_highest_pct", HIGHEST)
_reward_query("reward_promo_points", PROMO_FPOINT)
_reward_query("reward_promo_freeship", PROMO_FREESHIP)


def _campaign_rows(t: Shop, p: Params) -> DataFrame:
    return jobs.campaign_state(t, _active(t, p), p)[1]


@query
def campaign_ledger(t: Shop, p: Params) -> DataFrame:
    return out(_campaign_rows(t, p), LEDGER + "order_id campaign_id campaign_rule_id description:s")


# --- reviews


@query
def active_review_rules(t: Shop, p: Params) -> DataFrame:
    """Running rules, with the approved reviews written in each rule's window."""
    rules = reviews.active_review_rules(t["review_rule"], p)
    written = t["review"].filter("status_id = 1").select("created_at")
    inside = reviews.in_rule_windows(written, jobs.review_windows(t, p), p)
    counts = inside.groupBy("review_campaign_id").agg(F.count("*").alias("reviews_in_window"))
    df = rules.join(counts, "review_campaign_id", "left").withColumn(
        "reviews_in_window", F.coalesce("reviews_in_window", F.lit(0))
    )
    return out(df, "review_campaign_id action_name:s review_type:s value min_value max_value reviews_in_window")


@query
def review_char_count(t: Shop, p: Params) -> DataFrame:
    df = t["review"].withColumn("chars", reviews.review_chars("detail", p.review_char_buffer))
    return out(df, "review_id chars")


def _inside(t: Shop, p: Params) -> DataFrame:
    return reviews.of_holders(jobs.reviews_inside(t, jobs.review_windows(t, p), p), t["account"])


@query
def review_like_count(t: Shop, p: Params) -> DataFrame:
    inside = cut(_inside(t, p))
    likes = reviews.review_like_count(t["review_action"], jobs.review_windows(t, p), p, inside)
    return out(reviews.with_likes(inside, likes), "review_campaign_id review_id num_like")


@query
def reviews_in_window(t: Shop, p: Params) -> DataFrame:
    return out(_inside(t, p), "review_campaign_id review_id customer_id product_id chars")


@query
def review_rule_match(t: Shop, p: Params) -> DataFrame:
    return out(jobs.review_matches(t, p), "review_campaign_id review_id customer_id product_id")


@query
def review_dedup(t: Shop, p: Params) -> DataFrame:
    df = reviews.review_dedup(jobs.review_matches(t, p), t["ledger"])
    return out(df, "review_campaign_id review_id customer_id product_id")


@query
def review_ledger(t: Shop, p: Params) -> DataFrame:
    return out(jobs.run_reviews(t, p).ledger, LEDGER + "review_id product_id review_campaign_id description:s")


@query
def editor_reviews(t: Shop, p: Params) -> DataFrame:
    df = reviews.editor_reviews(t["review_editor_log"], t["review"], t["review_editor"], t["account"], p)
    return out(df, "review_id product_id author:s author_id customer_id editor_type:s chars")


@query
def editor_review_rewards(t: Shop, p: Params) -> DataFrame:
    _, balances = jobs.editor_state(jobs.editor_matches(t, p), t)
    log = reviews.editor_review_rewards(balances).select("author_id", "review_id", "status", "editor_type").distinct()
    df = reviews.review_ledger(balances, p, reviews.EDITOR_JOB).join(log, "review_id")
    return out(df, LEDGER + "review_id product_id review_campaign_id author_id status:s editor_type:s")


@query
def guest_review_outbox(t: Shop, p: Params) -> DataFrame:
    df = reviews.guest_review_outbox(jobs.editor_matches(t, p), t["review_reward_log"])
    return out(df, "email:s author_id review_id status:s editor_type:s")


# --- first orders


@query
def new_customer_orders(t: Shop, p: Params) -> DataFrame:
    return out(order_count.new_customer_orders(t["orders"], t["suborder"], t["account"], p), "order_id customer_id")


@query
def order_ordinal(t: Shop, p: Params) -> DataFrame:
    return out(jobs.order_ordinals(t, p), "order_id customer_id start_index ordinal")


def _count_rewards(t: Shop, p: Params, rules: DataFrame) -> DataFrame:
    payable = cut(order_count.payable_rules(rules, p))
    df = order_count.order_count_rewards(jobs.order_ordinals(t, p), payable, p)
    return out(df, "order_id customer_id start_index ordinal rule_id type:s value")


@query
def order_count_rewards(t: Shop, p: Params) -> DataFrame:
    return _count_rewards(t, p, t["order_count_rule"])


@query
def order_count_rewards_stalled(t: Shop, p: Params) -> DataFrame:
    """No rule for the second order: customers stall at index 1."""
    return _count_rewards(t, p, t["order_count_rule"].filter("number_order <> 2"))


def _count_rows(t: Shop, p: Params, ordinals: DataFrame) -> DataFrame:
    payable = cut(order_count.payable_rules(t["order_count_rule"], p))
    rewards = order_count.order_count_rewards(ordinals, payable, p)
    return order_count.order_count_ledger(order_count.judge(rewards, t["account"]), p)


@query
def order_count_ledger(t: Shop, p: Params) -> DataFrame:
    df = _count_rows(t, p, jobs.order_ordinals(t, p))
    return out(df, LEDGER + "order_id number_order_rule index_order description:s")


@query
def finish_warm_up(t: Shop, p: Params) -> DataFrame:
    return out(order_count.finish_warm_up(jobs.order_ordinals(t, p), t["order_count_rule"], p), "customer_id")


# --- referrals


def _referral_orders(t: Shop, p: Params) -> DataFrame:
    return referral.referral_orders(t["orders"], t["account"], t["refer_rule"], p)


@query
def referral_orders(t: Shop, p: Params) -> DataFrame:
    return out(_referral_orders(t, p), "order_id customer_id refer_code:s refer_rule refer_action:s refer_value grand_total:d")


@query
def already_referred(t: Shop, p: Params) -> DataFrame:
    return out(referral.already_referred(cut(_referral_orders(t, p)), t["ledger"]), "order_id customer_id refer_code:s")


@query
def referral_reward(t: Shop, p: Params) -> DataFrame:
    return out(jobs.referral_rewards(t, p), "order_id customer_id refer_rule reward:d")


def _referral_rows(t: Shop, p: Params) -> DataFrame:
    return jobs.referral_state(t, p)[1]


@query
def referral_ledger(t: Shop, p: Params) -> DataFrame:
    return out(_referral_rows(t, p), LEDGER + "order_id refer_rule_id refer_code:s description:s")


# --- tiers, backfill, email list


@query
def tier_classify(t: Shop, p: Params) -> DataFrame:
    return out(tiers.tier_classify(t["account"], t["tier_rule"], p), "customer_id fpoint_accrue_year vip_level new_level")


def _upgrades(t: Shop, p: Params) -> DataFrame:
    return tiers.tier_upgrade(tiers.tier_classify(t["account"], t["tier_rule"], p), t["tier_rule"], t["account"])


@query
def tier_upgrade(t: Shop, p: Params) -> DataFrame:
    return out(_upgrades(t, p), "customer_id vip_level new_level award new_freeship")


@query
def tier_upgrade_ledger(t: Shop, p: Params) -> DataFrame:
    return out(tiers.tier_upgrade_ledger(_upgrades(t, p), p), LEDGER + "description:s")


@query
def freeship_backfill(t: Shop, p: Params) -> DataFrame:
    owed = tiers.freeship_backfill(t["account"], p)
    df = tiers.backfill_ledger(owed, p).join(owed.select("customer_id", "reached"), "customer_id")
    return out(df, LEDGER + "reached description:s")


@query
def email_list_ingest(t: Shop, p: Params) -> DataFrame:
    return out(email_grant.email_list_ingest(t["email_list"]), "row_no email:s")


def _grants(t: Shop, p: Params) -> DataFrame:
    entries = email_grant.email_list_ingest(t["email_list"])
    return email_grant.email_list_grant(email_grant.known_entries(entries, t["account"]))


@query
def email_list_grant(t: Shop, p: Params) -> DataFrame:
    return out(_grants(t, p), "email:s nth customer_id freeship_before freeship_after")


# --- across jobs


def _snapshot(account: DataFrame, change: DataFrame | None) -> DataFrame:
    return out(
        ledger.apply_changes(account, change) if change is not None else account,
        "customer_id email:s fpoint:d num_freeship fpoint_accrue_year num_rewarded_freeship vip_level finish_warm_up_period",
    )


@query
def apply_ledger(t: Shop, p: Params) -> DataFrame:
    """Accounts after base accrual: last running values."""
    return _snapshot(t["account"], accrual.account_changes(_accrued(t, p)))


@query
def apply_ledger_campaign(t: Shop, p: Params) -> DataFrame:
    """Accounts after campaigns: sums per reward type."""
    return _snapshot(t["account"], ledger.added(_campaign_rows(t, p)))


@query
def apply_ledger_order_count(t: Shop, p: Params) -> DataFrame:
    """Accounts after first-order rewards, with the warm-up flag."""
    ordinals = jobs.order_ordinals(t, p)
    finished = order_count.finish_warm_up(ordinals, t["order_count_rule"], p)
    return _snapshot(t["account"], order_count.account_changes(_count_rows(t, p, ordinals), finished))


@query
def apply_ledger_referral(t: Shop, p: Params) -> DataFrame:
    return _snapshot(t["account"], ledger.added(_referral_rows(t, p)))


@query
def apply_ledger_review(t: Shop, p: Params) -> DataFrame:
    return _snapshot(t["account"], jobs.run_reviews(t, p).changes)


@query
def apply_ledger_tier_upgrade(t: Shop, p: Params) -> DataFrame:
    return _snapshot(t["account"], tiers.upgrade_changes(_upgrades(t, p)))


@query
def apply_ledger_backfill(t: Shop, p: Params) -> DataFrame:
    return _snapshot(t["account"], tiers.backfill_changes(tiers.freeship_backfill(t["account"], p)))


@query
def apply_ledger_email_list(t: Shop, p: Params) -> DataFrame:
    rows = email_grant.email_list_ledger(_grants(t, p), "spring", p)
    return _snapshot(t["account"], ledger.added(rows))


@query
def ledger_append(t: Shop, p: Params) -> DataFrame:
    """Campaign and referral rows against a ledger that holds the campaign rows already:
    only the referral rows are new."""
    stored = _campaign_rows(t, p)
    rows = stored.unionByName(_referral_rows(t, p))
    return out(ledger.append_new(stored, rows), LEDGER + "order_id job:s job_key:s")


@query
def local_window(t: Shop, p: Params) -> DataFrame:
    """Local creation time of every order, both look-backs of a mid-day run, and the number of
    campaign rules open at that time."""
    p = replace(p, as_of=datetime(2001, 8, 2, 15, 30))
    windows = windows_of(t["campaign_rule"].select("rule_id", "from_date", "to_date"))
    orders = with_local_time(t["orders"].select("order_id", "created_at"), "created_at", p)
    opened = match_windows(orders, windows).groupBy("order_id").agg(F.count("*").alias("rules_open"))
    df = orders.join(opened, "order_id", "left").select(
        "order_id",
        F.col("local_at"),
        (F.col("created_at") >= ntz(p.since_midnight(p.accrual_days))).alias("since_midnight"),
        (F.col("local_at") >= ntz(p.since_instant(p.accrual_days))).alias("since_instant"),
        F.coalesce("rules_open", F.lit(0)).alias("rules_open"),
    )
    return out(df, "order_id local_at:s since_midnight since_instant rules_open")


@query
def reject_report(t: Shop, p: Params) -> DataFrame:
    """Rejects of all jobs, found side by side."""
    listed = lambda: email_grant.known_entries(email_grant.email_list_ingest(t["email_list"]), t["account"])

    def counted() -> DataFrame:
        ordinals = lambda: jobs.order_ordinals(t, p)
        payable = lambda: cut(order_count.payable_rules(t["order_count_rule"], p))
        rewards = order_count.order_count_rewards(*together(t.spark, ordinals, payable), p)
        return order_count.judge(rewards, t["account"])

    parts = together(
        t.spark,
        lambda: campaign.reject_rows(_campaign_judged(t, p)),
        lambda: accrual.reject_rows(jobs.accrual_judged(t, p)),
        lambda: order_count.reject_rows(counted()),
        lambda: referral.reject_rows(jobs.referral_rewards(t, p)),
        lambda: jobs.run_reviews(t, REVIEW_PARAMS).rejects,
        lambda: tiers.upgrade_rejects(_upgrades(t, p)),
        lambda: tiers.backfill_rejects(tiers.freeship_backfill(t["account"], p)),
        lambda: email_grant.reject_rows(listed()),
    )
    return out(reduce(DataFrame.unionByName, parts), "job:s customer_id ref_id reason:s")


@lru_cache(maxsize=8)
def shop(spark: SparkSession, sf_dir: str) -> Shop:
    """Tables are resolved once per session, not once per query."""
    return Shop(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        params = REVIEW_PARAMS if "review" in fn.__name__ else PARAMS
        return lambda spark, sf_dir: fn(shop(spark, sf_dir), params)

    return {name: bind(fn) for name, fn in QUERIES.items()}
