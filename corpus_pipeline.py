"""The corpus pipeline: each stage calls one operator of `perkmill.llm` on what the stage before it kept.

All stages but the last return the columns they were given. Null texts count as empty, repeated rows as
rows, and columns of any other name pass through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut
from perkmill.llm import bpe, langid, mixing, pii, simhash
from perkmill.llm.common import free, read

#: A language is taken from this score on; the score of a wild guess is one over the languages.
LEAST_SCORE = 0.3
#: The pipeline's mix holds every source whole at least once, and none more often than this.
MOST_PASSES = 2.0
#: Row groups of the tables between the stages: two tasks of an executor write one each while Python workers run.
ROW_GROUP_BYTES = 16 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: texts without letters, and texts that fit no language, go."""
    (found,) = free(docs, "found")
    seen = docs.withColumn(found, langid.predicted(spark, langid.train(docs), F.col("text")))
    known = (F.col(f"{found}.lang_pred") != langid.UNKNOWN) & (F.col(f"{found}.score") >= LEAST_SCORE)
    return seen.filter(known).drop(found)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    return simhash.one_of_each(spark, docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows."""
    return pii.masked(docs, length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated, by whole and partial permutations, towards weights of the target entropy;
    each document stays at least once."""
    return mixing.mixed(docs, most_passes=MOST_PASSES, cover=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian unsigned 32-bit) and decoded text of every document of the mix."""
    return docs.select("doc_id", bpe.tokens(spark, docs["text"], bpe.default_vocabulary()).alias("t")).select("doc_id", "t.*")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# No stage but the mix can be expressed in SQL; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, ROW_GROUP_BYTES)
    return docs
