"""The operators over the given tables, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bisectors import OP13_SQL, op13_bisectors
from .bpe import op9_bpe
from .divergence import OP11_SQL, op11_divergence
from .langid import op1_langid
from .maintext import op7_maintext
from .mixing import op4_mixing
from .pii import op5_pii
from .quality import op3_quality
from .ranking import op12_ranking
from .secrets import op2_secrets
from .simhash import op8_simhash
from .vptree import op6_vptree
from .warc import OP10_SQL, op10_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_langid": op1_langid,
        "op2_secrets": op2_secrets,
        "op3_quality": op3_quality,
        "op4_mixing": op4_mixing,
        "op5_pii": op5_pii,
        "op6_vptree": op6_vptree,
        "op7_maintext": op7_maintext,
        "op8_simhash": op8_simhash,
        "op9_bpe": op9_bpe,
        "op10_warc": op10_warc,
        "op11_divergence": op11_divergence,
        "op12_ranking": op12_ranking,
        "op13_bisectors": op13_bisectors,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_warc": OP10_SQL, "op11_divergence": OP11_SQL, "op13_bisectors": OP13_SQL}
