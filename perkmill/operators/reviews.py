"""Review rewards for members, and for reviews that editors import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.localtime import (
    EPOCH,
    Windows,
    day_of,
    in_any_window,
    match_windows,
    ntz,
    utc_of,
    with_local_time,
    within,
    within_span,
)
from ..functions.money import amount
from ..functions.running import running_totals
from ..functions.text import review_chars
from ..params import FPOINT, REVIEW_CHARACTER, REVIEW_LIKE, Params
from ..schemas import REWARD_LOG
from . import ledger
from .accounts import by_email, duplicate_account, states_of

JOB = "review"
EDITOR_JOB = "editor review"
ONCE_PER = ["customer_id", "product_id", "review_campaign_id"]


def active_review_rules(rules: DataFrame, p: Params) -> DataFrame:
    return (
        rules.filter(F.col("end_status") == 0)
        .withColumns(
            {
                "min_value": F.coalesce("min_value", F.lit(0)),
                "max_value": F.coalesce("max_value", F.lit(p.review_max)),
            }
        )
        .drop("end_status")
    )


def _dated(review: DataFrame) -> list[str]:
    """The creation time, and in a table laid out by day its partition."""
    return ["created_at", *[c for c in [day_of("created_at")] if c in review.columns]]


def approved_reviews(review: DataFrame, p: Params) -> DataFrame:
    """Approved reviews of customers with their character count in place of the text."""
    return review.filter((F.col("status_id") == 1) & F.col("customer_id").isNotNull()).select(
        "review_id",
        "product_id",
        "customer_id",
        *_dated(review),
        review_chars("detail", p.review_char_buffer).alias("chars"),
    )


def in_rule_windows(reviews: DataFrame, windows: Windows, p: Params) -> DataFrame:
    reachable = with_local_time(within_span(reviews, "created_at", windows, p), "created_at", p).drop(*_dated(reviews))
    return match_windows(reachable, windows).drop("local_at")


def in_some_window(review: DataFrame, windows: Windows, p: Params) -> DataFrame:
    """Approved reviews, members' or not, that some rule's window holds, without their texts."""
    approved = review.filter(F.col("status_id") == 1).select("review_id", "product_id", "status_id", *_dated(review))
    reachable = with_local_time(within_span(approved, "created_at", windows, p), "created_at", p)
    return in_any_window(reachable, windows).drop("local_at", "interval")


def of_holders(reviews: DataFrame, account: DataFrame) -> DataFrame:
    """Reviews whose customer has an account."""
    return reviews.join(account.select("customer_id").distinct(), "customer_id", "left_semi")


def like_windows(windows: Windows) -> Windows:
    """Windows of the rules that count likes."""
    return windows.where(F.col("review_type") == REVIEW_LIKE)


def _likes(action: DataFrame, bound: Column) -> DataFrame:
    return action.filter((F.col("type") == REVIEW_LIKE) & bound).select("review_id", "created_at")


def review_like_count(action: DataFrame, windows: Windows, p: Params, wanted: DataFrame | None = None) -> DataFrame:
    """Likes per rule and review, counted inside the rule's window; reviews without any are absent.
    `wanted`, if given, holds the reviews that are asked for: others' likes aren't carried on."""
    likes = _likes(within_span(action, "created_at", windows, p), F.lit(True))
    if wanted is not None:
        likes = likes.join(wanted.select("review_id").distinct(), "review_id", "left_semi")
    return (
        match_windows(with_local_time(likes, "created_at", p).drop("created_at"), windows.select("review_campaign_id"))
        .groupBy("review_campaign_id", "review_id")
        .agg(F.count("*").alias("num_like"))
    )


def likes_since(
    action: DataFrame, windows: Windows, stored: DataFrame, marks: DataFrame, p: Params
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Likes per rule and review from stored counts and the actions since; what a run adds to the stored
    counts, and to its marks.

    A mark says up to which local time a rule's likes are in the stored counts. Only later actions are
    read: those up to `like_lag_hours` before the run are settled and stored, the rest are counted anew
    next time, so an action may arrive that late. A rule that's new, or whose window was changed, has no
    mark and is counted from its window's start.
    """
    key = ["review_campaign_id", "from_at", "until_at"]
    rules = windows.rows.filter(F.col("part_no") == 0).select(*key)
    reached = marks.groupBy(*key).agg(F.max("upto").alias("upto"))
    state = cut(rules.join(reached, key, "left").select(*key, F.coalesce("upto", "from_at").alias("counted")))
    settled = ntz(p.since_hours(p.like_lag_hours))
    ends = state.agg(F.min(F.col("counted") - ntz(EPOCH)).alias("a"), F.max(F.col("until_at") - ntz(EPOCH)).alias("b")).first()
    reach = F.lit(False) if ends.a is None else within(action, "created_at", ntz(utc_of(ends.a, p)), ntz(utc_of(ends.b, p)))
    likes = with_local_time(_likes(action, reach), "created_at", p).drop("created_at")
    met = match_windows(likes, windows.select("review_campaign_id")).join(state, "review_campaign_id")
    new = met.filter(F.col("local_at") >= F.col("counted")).groupBy(*key, "review_id")
    new = cut(new.agg(F.count_if(F.col("local_at") < settled).alias("settled"), F.count("*").alias("num_like")))
    held = stored.join(rules, key, "left_semi").select("review_campaign_id", "review_id", "num_like")
    both = held.unionByName(new.select("review_campaign_id", "review_id", "num_like"))
    total = both.groupBy("review_campaign_id", "review_id").agg(F.sum("num_like").alias("num_like"))
    increments = new.filter("settled > 0").select(*key, "review_id", F.col("settled").alias("num_like"))
    return total, increments, state.select(*key, F.greatest("counted", settled).alias("upto"))


def with_likes(reviews: DataFrame, likes: DataFrame) -> DataFrame:
    return reviews.join(likes, ["review_campaign_id", "review_id"], "left").withColumn(
        "num_like", F.coalesce("num_like", F.lit(0).cast("long"))
    )


def review_rule_match(reviews: DataFrame) -> DataFrame:
    """Keeps reviews inside the rule's bounds on characters or likes; other rule types match none."""
    measure = F.when(F.col("review_type") == REVIEW_CHARACTER, F.col("chars")).when(
        F.col("review_type") == REVIEW_LIKE, F.col("num_like")
    )
    return reviews.filter(measure.between(F.col("min_value"), F.col("max_value")))


def matched_reviews(reviews: DataFrame, likes: DataFrame) -> DataFrame:
    """Reviews (with rule columns) that match, by their counts of likes."""
    return review_rule_match(with_likes(reviews, likes))


def not_rewarded(reviews: DataFrame, stored: DataFrame) -> DataFrame:
    """Drops reviews whose customer has a reward for the product by the rule."""
    held = F.col("review_campaign_id").isNotNull()
    return ledger.not_in_ledger(reviews, stored, held, ONCE_PER, [JOB, EDITOR_JOB])


def first_reviews(matched: DataFrame) -> DataFrame:
    """The lowest review id per customer, product and rule. An aggregate, so a product with very many
    reviews folds on the map side."""
    carried = [c for c in matched.columns if c not in ONCE_PER and c != "review_id"]
    first = F.min(F.struct("review_id", *carried)).alias("first")
    return matched.groupBy(*ONCE_PER).agg(first).select(*ONCE_PER, "first.*")


def review_dedup(matched: DataFrame, stored: DataFrame) -> DataFrame:
    """At most one reward per customer, product and rule: none if the ledger has one, else the
    lowest review id."""
    return not_rewarded(first_reviews(matched), stored)


def judge(deduped: DataFrame, account: DataFrame) -> DataFrame:
    """Adds account state and the reason a review cannot be paid. Hand over `deduped` written out."""
    state = states_of(account, deduped, ["email", "fpoint"])
    reason = (
        F.when(F.coalesce("account_rows", F.lit(0)) == 0, "no account")
        .when(duplicate_account().isNotNull(), duplicate_account())
        .when(F.col("email").isNull(), "no email")
    )
    return deduped.join(state, "customer_id", "left").withColumn("reason", reason)


def payable(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull())


def review_balance(judged: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Running balance per customer over rule id, then review id."""
    start, value = amount(F.col("fpoint")), amount(F.col("value"))
    return running_totals(
        payable(judged),
        ["customer_id"],
        ["review_campaign_id", "review_id"],
        {"paid": value},
        hot,
    ).withColumns(
        {
            "amount_before": (start + F.col("paid") - value).cast("double"),
            "amount_after": (start + F.col("paid")).cast("double"),
        }
    )


def review_ledger(balances: DataFrame, p: Params, job: str = JOB) -> DataFrame:
    rows = balances.select(
        "customer_id",
        F.col("email").alias("account"),
        F.col("action_name").alias("action"),
        F.lit(FPOINT).alias("type"),
        "value",
        "amount_before",
        "amount_after",
        "review_id",
        "product_id",
        "review_campaign_id",
        F.concat(
            F.lit("review rule "), F.col("review_campaign_id").cast("string"), F.lit(", review "),
            F.col("review_id").cast("string"),
            F.when(F.col("review_type") == REVIEW_LIKE, F.concat(F.lit(", likes "), F.col("num_like").cast("string")))
            .otherwise(F.concat(F.lit(", characters "), F.col("chars").cast("string"))),
        ).alias("description"),
    )
    return ledger.ledger_rows(rows, job, ONCE_PER, p)


def editor_reviews(
    log: DataFrame, review: DataFrame, editor: DataFrame, account: DataFrame, p: Params
) -> DataFrame:
    """Approved reviews imported by editors; `customer_id` is the account whose email is the
    author, null for a guest. One row per review: the log row with the lowest author id. Of the log only
    the approved ones of `review` are folded."""
    approved = review.filter(F.col("status_id") == 1).select("review_id", "product_id", *_dated(review))
    imported = log.join(approved.select("review_id"), "review_id", "left_semi").select(
        "review_id",
        "author",
        "author_id",
        "editor_id",
        review_chars("review", p.review_char_buffer).alias("chars"),
    ).join(editor.select("editor_id", "editor_type"), "editor_id")
    one_log = (
        imported.groupBy("review_id")
        .agg(F.min(F.struct("author_id", "author", "editor_type", "chars")).alias("log"))
        .select("review_id", "log.*")
    )
    members = by_email(account, one_log.select(F.col("author").alias("email"))).withColumnRenamed("email", "author")
    return one_log.join(approved, "review_id").join(members, "author", "left")


def editor_review_rewards(balances: DataFrame) -> DataFrame:
    """Reward-log rows of paid member reviews."""
    return _reward_log(balances, F.col("email"), "rewarded")


def guest_review_outbox(matched: DataFrame, reward_log: DataFrame) -> DataFrame:
    """Guests to send a redeem code: one row per (author, review) the reward log does not hold."""
    key = ["author_id", "review_id"]
    guests = (
        matched.filter(F.col("customer_id").isNull())
        .join(reward_log.select(*key).distinct(), key, "left_anti")
        .dropDuplicates(key)
    )
    return _reward_log(guests, F.coalesce(F.col("author"), F.lit("")), "not rewarded")


def _reward_log(df: DataFrame, email, status: str) -> DataFrame:
    filled = df.withColumns({"email": email, "status": F.lit(status)})
    return filled.select(
        *[
            (F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in REWARD_LOG
        ]
    )
