"""The nine reward jobs, each from tables to ledger rows, account changes and rejects.

`t` maps table names (`schemas.INPUTS`, plus "ledger" and, with a store, "suborder_stamp") to
DataFrames. A job writes out its candidates, those not paid yet, and the accounts of their customers,
since several of its results read them; ledger rows, account changes and stamps all come from these.
What it returns is lazy.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bounds import between_ids
from ..functions.lineage import cut
from ..functions.localtime import Windows, windows_of
from ..functions.running import hot_keys
from ..functions.together import together
from ..operators import accrual, campaign, email_grant, ledger, order_count, referral, reviews, tiers
from ..operators.pricing import countable_items, suborder_amount
from ..params import FPOINT, Params

Tables = Mapping[str, DataFrame]
CUSTOMER = ["customer_id"]


@dataclass
class JobResult:
    ledger: DataFrame
    changes: DataFrame
    rejects: DataFrame
    # Further tables the job rewrites or appends to, by name.
    tables: dict[str, DataFrame] = field(default_factory=dict)


# --- base accrual


def unpaid_suborders(t: Tables, p: Params) -> DataFrame:
    return cut(
        accrual.unpaid_suborders(
            t["suborder"], t["orders"], t["account_attr"], t["ledger"], t.get("suborder_stamp"), p
        )
    )


def accrual_amounts(t: Tables, unpaid: DataFrame, p: Params) -> DataFrame:
    items = countable_items(t["suborder_item"], p.excluded_products)
    return suborder_amount(unpaid, items, t["suborder_bundle"])


def accrual_guarded(t: Tables, p: Params) -> DataFrame:
    unpaid = unpaid_suborders(t, p)
    return accrual.account_unique_guard(accrual_amounts(t, unpaid, p), unpaid, t["account"], t["account_attr"])


def accrual_judged(t: Tables, p: Params) -> DataFrame:
    guarded = accrual_guarded(t, p)
    return accrual.judge(guarded, t["company"], t["company_tier_rule"], t["tier_rule"])


def accrual_state(t: Tables, p: Params) -> tuple[DataFrame, DataFrame]:
    """Judged suborders, written once for their several readers, and the accrued ones."""
    judged = cut(accrual_judged(t, p))
    hot = hot_keys(judged, CUSTOMER)
    balances = accrual.running_point_balance(accrual.suborder_points(judged), hot)
    return judged, accrual.freeship_milestone(balances, p, hot)


def run_accrual(t: Tables, p: Params) -> JobResult:
    judged, accrued = accrual_state(t, p)
    return JobResult(
        accrual.accrual_ledger(accrued, p),
        accrual.account_changes(accrued),
        accrual.reject_rows(judged),
        {"suborder_stamp": accrual.suborder_stamps(accrual.suborder_points(judged))},
    )


# --- campaigns


def campaign_rules(t: Tables, p: Params) -> DataFrame:
    rules = campaign.join_rules(t["campaign"], t["campaign_action"], t["campaign_rule"])
    return campaign.active_campaign_rules(rules, t["campaign_rule_filter"], p)


def campaign_lists(active: DataFrame) -> DataFrame:
    return cut(campaign.rule_lists(active))


def campaign_windows(active: DataFrame, p: Params) -> Windows:
    return windows_of(campaign.combine_filters(active, p).filter("usable").drop("usable"))


def campaign_winners(t: Tables, active: DataFrame, p: Params) -> DataFrame:
    """Orders no campaign has paid, which is known before their items are read, with their rule."""
    windows, lists = together(active.sparkSession, lambda: campaign_windows(active, p), lambda: campaign_lists(active))
    per_rule = campaign.campaign_order_agg(
        t["suborder_item"], t["suborder_bundle"], t["suborder"], t["orders"], t["product"], windows, lists, p, t["ledger"]
    )
    return campaign.one_campaign_per_order(campaign.rule_order_match(per_rule))


def campaign_state(t: Tables, active: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Judged orders and their ledger rows."""
    winners = cut(campaign_winners(t, active, p))
    judged, hot = together(
        winners.sparkSession, lambda: campaign.judge(winners, t["account"], t["tier_rule"]), lambda: hot_keys(winners, CUSTOMER)
    )
    return judged, campaign.campaign_ledger(judged, p, hot)


def run_campaign(t: Tables, p: Params) -> JobResult:
    judged, rows = campaign_state(t, campaign_rules(t, p), p)
    added = ledger.added(campaign.payable(judged), "reward", "reward_type")
    return JobResult(rows, added, campaign.reject_rows(judged))


# --- reviews


def review_windows(t: Tables, p: Params) -> Windows:
    return windows_of(reviews.active_review_rules(t["review_rule"], p))


def reviews_inside(t: Tables, windows: Windows, p: Params) -> DataFrame:
    # Reviews without an account are told apart by `judge`, on the few that match.
    return reviews.in_rule_windows(reviews.approved_reviews(t["review"], p), windows, p)


def review_likes(t: Tables, windows: Windows, p: Params, wanted: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Likes per rule and review, and what a run stores of them: with a store, from its counts and the
    actions since; without, all likes of the `wanted` reviews."""
    counting = reviews.like_windows(windows)
    if "review_like" not in t:
        return reviews.review_like_count(t["review_action"], counting, p, wanted), {}
    total, increments, marks = reviews.likes_since(t["review_action"], counting, t["review_like"], t["review_like_mark"], p)
    return total, {"review_like": increments, "review_like_mark": marks}


def review_matches(t: Tables, p: Params) -> DataFrame:
    windows = review_windows(t, p)
    inside = cut(reviews_inside(t, windows, p))
    return reviews.matched_reviews(inside, review_likes(t, windows, p, inside)[0])


def review_state(fresh: DataFrame, t: Tables) -> tuple[DataFrame, DataFrame]:
    """Judged reviews and the paid ones with running balances."""
    fresh = cut(fresh)
    judged, hot = together(fresh.sparkSession, lambda: reviews.judge(fresh, t["account"]), lambda: hot_keys(fresh, CUSTOMER))
    return judged, reviews.review_balance(judged, hot)


def _review_result(judged: DataFrame, balances: DataFrame, job: str, p: Params) -> JobResult:
    rows = reviews.review_ledger(balances, p, job)
    rejects = ledger.rejects(judged, job, "review_id", F.col("reason"))
    return JobResult(rows, ledger.added(reviews.payable(judged), kind=F.lit(FPOINT)), rejects)


def run_reviews(t: Tables, p: Params) -> JobResult:
    """Reviews not rewarded yet, which is known before their likes are counted."""
    windows = review_windows(t, p)
    unpaid = cut(reviews.not_rewarded(reviews_inside(t, windows, p), t["ledger"]))
    likes, counted = review_likes(t, windows, p, unpaid)
    result = _review_result(*review_state(reviews.first_reviews(reviews.matched_reviews(unpaid, likes)), t), reviews.JOB, p)
    result.tables.update(counted)
    return result


def editor_matches(t: Tables, p: Params) -> DataFrame:
    """Imported reviews that match. Only the log of approved reviews in some rule's window is read on."""
    windows = review_windows(t, p)
    inside = cut(reviews.in_some_window(t["review"], windows, p))
    log = between_ids(t["review_editor_log"], "review_id", inside)
    imported = cut(reviews.in_rule_windows(reviews.editor_reviews(log, inside, t["review_editor"], t["account"], p), windows, p))
    return reviews.matched_reviews(imported, review_likes(t, windows, p, imported)[0])


def editor_state(matched: DataFrame, t: Tables) -> tuple[DataFrame, DataFrame]:
    return review_state(reviews.review_dedup(matched.filter(F.col("customer_id").isNotNull()), t["ledger"]), t)


def run_editor_reviews(t: Tables, p: Params) -> JobResult:
    matched = cut(editor_matches(t, p))
    judged, balances = editor_state(matched, t)
    result = _review_result(judged, balances, reviews.EDITOR_JOB, p)
    result.tables["review_reward_log"] = reviews.editor_review_rewards(balances).unionByName(
        reviews.guest_review_outbox(matched, t["review_reward_log"])
    )
    return result


# --- first orders


def order_ordinals(t: Tables, p: Params) -> DataFrame:
    candidates = cut(order_count.new_customer_orders(t["orders"], t["suborder"], t["account"], p))
    return order_count.order_ordinal(candidates, t["ledger"], hot_keys(candidates, CUSTOMER))


def run_order_count(t: Tables, p: Params) -> JobResult:
    ordinals = cut(order_ordinals(t, p))
    payable = cut(order_count.payable_rules(t["order_count_rule"], p))
    rewards = order_count.order_count_rewards(ordinals, payable, p)
    judged = order_count.judge(rewards, t["account"])
    rows = order_count.order_count_ledger(judged, p)
    finished = order_count.finish_warm_up(ordinals, t["order_count_rule"], p)
    return JobResult(rows, order_count.account_changes(rows, finished), order_count.reject_rows(judged))


# --- referrals


def referral_rewards(t: Tables, p: Params) -> DataFrame:
    used = cut(referral.referral_orders(t["orders"], t["account"], t["refer_rule"], p))
    return referral.referral_reward(referral.already_referred(used, t["ledger"]))


def referral_state(t: Tables, p: Params) -> tuple[DataFrame, DataFrame]:
    """Rewards, written once, and their ledger rows."""
    rewards = cut(referral_rewards(t, p))
    return rewards, referral.referral_ledger(rewards, p, hot_keys(rewards, CUSTOMER))


def run_referral(t: Tables, p: Params) -> JobResult:
    rewards, rows = referral_state(t, p)
    added = ledger.added(referral.payable(rewards), "reward", F.lit(FPOINT))
    return JobResult(rows, added, referral.reject_rows(rewards))


# --- tiers, backfill, email list


def run_tier_upgrade(t: Tables, p: Params) -> JobResult:
    classified = tiers.tier_classify(t["account"], t["tier_rule"], p)
    upgrades = tiers.tier_upgrade(classified, t["tier_rule"], t["account"])
    return JobResult(
        tiers.tier_upgrade_ledger(upgrades, p), tiers.upgrade_changes(upgrades), tiers.upgrade_rejects(upgrades)
    )


def run_freeship_backfill(t: Tables, p: Params) -> JobResult:
    owed = tiers.freeship_backfill(t["account"], p)
    return JobResult(tiers.backfill_ledger(owed, p), tiers.backfill_changes(owed), tiers.backfill_rejects(owed))


def run_email_list(t: Tables, p: Params, raw: DataFrame, list_id: str) -> JobResult:
    """`raw` comes from `sources.email_list`. An entry the ledger holds under the same list is
    not granted again."""
    known = cut(email_grant.known_entries(email_grant.email_list_ingest(raw), t["account"]))
    fresh = email_grant.not_granted(email_grant.email_list_grant(known), t["ledger"], list_id)
    rows = email_grant.email_list_ledger(fresh, list_id, p)
    return JobResult(rows, ledger.added(rows), email_grant.reject_rows(known))


JOBS = {
    "accrual": run_accrual,
    "campaign": run_campaign,
    "order count": run_order_count,
    "referral": run_referral,
    "review": run_reviews,
    "editor review": run_editor_reviews,
    "tier upgrade": run_tier_upgrade,
    "freeship backfill": run_freeship_backfill,
}
