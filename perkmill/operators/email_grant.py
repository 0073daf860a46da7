"""One free-shipping credit per entry of an email list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_email
from ..params import ACTION_FREESHIP, FREESHIP, Params
from . import ledger
from .accounts import by_email, duplicate_account, states_of

JOB = "email list"
# Fixed layout: so many rows stand above the first entry.
TITLE_ROWS = 2


def email_list_ingest(raw: DataFrame) -> DataFrame:
    """Cleaned entries: the rows below the title rows that hold an address. Rows without a number
    (`line_no`, from 1) are taken as entries."""
    if "line_no" in raw.columns:
        raw = raw.filter(F.col("line_no") > TITLE_ROWS)
    return raw.withColumn("email", clean_email("email_raw")).filter(F.col("email").contains("@")).drop("email_raw")


def _entry_key(list_id: str) -> Column:
    """The list, the email, and the how-manieth entry of that email: the same however the file was
    split for reading."""
    return F.concat_ws("|", F.lit(list_id), F.col("email"), F.col("nth").cast("string"))


def known_entries(entries: DataFrame, account: DataFrame) -> DataFrame:
    """How often the list has each email that has an account, and the reason it can't be granted; an
    email that several customers share goes to the lowest id.

    Entries fold on the map side: an email with a large part of a list is one row from then on.
    """
    listed = entries.groupBy("email").agg(F.count("*").alias("entries"))
    owned = listed.join(by_email(account, listed, lower=True), "email")
    return owned.join(states_of(account, owned, ["num_freeship"]), "customer_id").withColumn("reason", duplicate_account())


def email_list_grant(known: DataFrame) -> DataFrame:
    """Credits before and after each entry (`nth` of its email)."""
    one = known.filter(F.col("reason").isNull()).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("entries"))))
    return one.withColumns(
        {
            "freeship_before": F.col("num_freeship").cast("long") + F.col("nth") - 1,
            "freeship_after": F.col("num_freeship").cast("long") + F.col("nth"),
        }
    )


def not_granted(grants: DataFrame, stored: DataFrame, list_id: str) -> DataFrame:
    """Drops entries an earlier run of the same list has granted. The account holds those already, so
    the credits of the others move down by their number."""
    held = stored.filter((F.col("job") == JOB) & F.col("job_key").startswith(f"{list_id}|")).select("job_key").distinct()
    keyed = grants.withColumn("job_key", _entry_key(list_id))
    done = keyed.join(held, "job_key", "left_semi").groupBy("customer_id").agg(F.count("*").alias("done"))
    fresh = keyed.join(held, "job_key", "left_anti").drop("job_key").join(done, "customer_id", "left")
    down = F.coalesce("done", F.lit(0).cast("long"))
    return fresh.withColumns(
        {c: F.col(c) - down for c in ("freeship_before", "freeship_after")}
    ).drop("done")


def email_list_ledger(grants: DataFrame, list_id: str, p: Params) -> DataFrame:
    rows = grants.select(
        "customer_id",
        F.col("email").alias("account"),
        F.lit(ACTION_FREESHIP).alias("action"),
        F.lit(FREESHIP).alias("type"),
        F.lit(1).alias("value"),
        F.col("freeship_before").alias("amount_before"),
        F.col("freeship_after").alias("amount_after"),
        F.lit(list_id).alias("list_id"),
        "email",
        "nth",
        F.concat(F.lit("free shipping for list "), F.lit(list_id)).alias("description"),
    )
    return ledger.ledger_rows(rows, JOB, ["list_id", "email", "nth"], p)


def reject_rows(known: DataFrame) -> DataFrame:
    return ledger.rejects(known, JOB, "customer_id", F.col("reason"))
