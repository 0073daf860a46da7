"""Account lookups shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import cut


def states_of(account: DataFrame, rows: DataFrame, columns: list[str], more: DataFrame | None = None) -> DataFrame:
    """One row per customer of `rows` that has an account, with the number of its account rows and,
    where that is 1, its `columns`; and what `more` holds of the customer, if given.

    Only accounts of these customers are counted and carried on; the counts are hash aggregates,
    and the columns are joined back to them. The result is written out: it's small, and adaptive
    execution splits a hot customer of `rows` only where both sides of the join to it come straight
    from a shuffle, not out of an aggregate.
    """
    wanted = rows.select("customer_id").distinct()
    own = account.select("customer_id", *columns).join(wanted, "customer_id", "left_semi")
    counts = own.groupBy("customer_id").agg(F.count("*").alias("account_rows"))
    single = own.withColumn("account_rows", F.lit(1).cast("long"))
    states = counts.join(single, ["customer_id", "account_rows"], "left")
    return cut(states.join(more, "customer_id", "left") if more is not None else states)


def duplicate_account() -> Column:
    return F.when(F.col("account_rows") > 1, "duplicate account")


def with_account_rows(rows: DataFrame, account: DataFrame) -> DataFrame:
    """Adds the number of account rows of each row's customer."""
    return rows.join(states_of(account, rows, []), "customer_id", "left")


def by_email(account: DataFrame, emails: DataFrame, lower: bool = False) -> DataFrame:
    """Lowest customer id per email of `emails`."""
    email = F.lower("email") if lower else F.col("email")
    own = account.select(email.alias("email"), "customer_id").join(emails.select("email").distinct(), "email", "left_semi")
    return own.groupBy("email").agg(F.min("customer_id").alias("customer_id"))


def company_of(attr: DataFrame, attribute_id: int) -> DataFrame:
    """Company id attribute per customer, with the number of rows it has."""
    return (
        attr.filter(F.col("attribute_id") == attribute_id)
        .groupBy("customer_id")
        .agg(F.count("*").alias("attr_rows"), F.max("value").alias("company_id"))
    )


def tier_percent(account: DataFrame, tier_rule: DataFrame) -> DataFrame:
    """Adds the percent of the customer's level; null when the level has no rule. A level listed
    twice pays by its highest percent."""
    tiers = tier_rule.groupBy(F.col("level_id").alias("vip_level")).agg(F.max("percent_point_collect").alias("percent"))
    return account.join(tiers, "vip_level", "left")


def company_tier_percent(
    account: DataFrame, company: DataFrame, company_rule: DataFrame, tier_rule: DataFrame
) -> DataFrame:
    """Adds `percent` and `company_code`.

    A registered company pays by its own rule for the level. Where there is not exactly one such
    rule, or it has no percent, the tier percent applies and the code is blank.
    """
    own = (
        company_rule.groupBy("company_id", F.col("level_id").alias("vip_level"))
        .agg(F.count("*").alias("rules"), F.max("percent_point_collect").alias("company_percent"))
        .filter((F.col("rules") == 1) & F.col("company_percent").isNotNull())
        .drop("rules")
        .join(company.select("company_id"), "company_id", "left_semi")
    )
    return (
        tier_percent(account, tier_rule)
        .join(own, ["company_id", "vip_level"], "left")
        .withColumn("percent", F.coalesce("company_percent", "percent"))
        .withColumn(
            "company_code",
            F.when(F.col("company_percent").isNotNull(), F.col("company_id")).otherwise(F.lit("")),
        )
        .drop("company_percent")
    )
