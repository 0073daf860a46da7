from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def review_chars(text: str, buffer: int) -> Column:
    """Characters other than space, line feed and carriage return, plus the buffer."""
    kept = F.col(text)
    for blank in (" ", "\n", "\r"):
        kept = F.replace(kept, F.lit(blank), F.lit(""))
    return (F.length(kept) + F.lit(buffer)).cast("bigint")


def clean_email(raw: str) -> Column:
    return F.lower(F.replace(F.col(raw), F.lit(" "), F.lit("")))


def id_list(value: str) -> Column:
    """Comma list as written inside an SQL `in (...)`: blanks and quotes around items drop out."""
    return F.transform(F.split(F.col(value), ","), lambda item: F.btrim(item, F.lit(" '\"")))
