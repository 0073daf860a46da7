"""Null, empty and very long texts, repeated rows, empty tables and clashing columns, operator by operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from perkmill.llm import bpe, langid, maintext, mixing, quality, simhash
from perkmill.llm.queries import queries

LONG = "some words of a very long text, line by line\n" * 60_000
ROWS = [(1, None), (2, ""), (3, "plain text of a few words"), (3, "plain text of a few words"), (4, LONG), (5, "é𝔘 漢字"), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that clash with names the operators use."""
    rows = [(i, t, "en", "s", len(t or ""), "a", 1, 2.0, [3], "x") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, found string, row int, score double, spans array<int>, fp string")


def test_language(spark, docs):
    net = langid.train(docs)
    assert net.langs == ["en"]
    got = docs.withColumn("lang_pred", langid.predicted(spark, net, docs.text))
    assert sorted((r.doc_id or 0, r.lang_pred.lang_pred) for r in got.collect()) == [(0, "en"), (1, "und"), (2, "und"), (3, "en"), (3, "en"), (4, "en"), (5, "en")]
    assert docs.limit(0).select(langid.predicted(spark, net, docs.text)).count() == 0


def test_quality(spark, docs):
    stats = quality.with_statistics(docs, "text", ["doc_id", "score"])
    got = sorted((r.doc_id or 0, r.n_words) for r in stats.collect())
    assert got == [(0, 2), (1, 0), (2, 0), (3, 6), (3, 6), (4, 600_000), (5, 2)]
    assert quality.with_statistics(docs.limit(0), "text", ["doc_id"]).count() == 0
    assert quality.learned(stats, spark.createDataFrame([], "doc_id long, quality int")) == []


def test_main_text(spark):
    long = "<article>" + "<p>words of a paragraph, and more of it.</p>" * 3000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<p>one</p>"), (3, "<p>one</p>"), (4, long), (None, "<p>no id</p>")]
    pages = spark.createDataFrame([(i, "u", h, "t", 1) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")
    model = maintext.train(pages)
    got = [(r.page_id, r.m) for r in pages.select("page_id", maintext.main_text(spark, model, pages.html).alias("m")).collect()]
    by = dict(got)
    assert len(got) == 6 and by[1] == by[2] == "" and by[4].count("words of a paragraph") == 3000
    assert pages.limit(0).select(maintext.main_text(spark, model, pages.html)).count() == 0
    assert maintext.train(pages.limit(0)) is not None


def test_tokens(spark, docs):
    path = bpe.default_vocabulary()
    got = docs.withColumn("n_tokens", bpe.tokens(spark, docs.text, path)).select("doc_id", "score", F.col("n_tokens.n_tokens").alias("n")).collect()
    by = {r.doc_id: r.n for r in got}
    assert len(got) == len(ROWS) and by[1] == by[2] == 0 and by[4] > 600_000
    assert docs.limit(0).select(bpe.tokens(spark, docs.text, path)).count() == 0


def test_stages_on_all_of_them(spark, docs):
    """Each stage by itself, on whole texts; all but the last keep the columns."""
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, "")
            if name == "bpe":
                assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"]
            else:
                assert out.dtypes == df.dtypes
            rows = out.collect()
            assert bool(rows) == (df is docs)
            if name in ("near_duplicates", "personal_data", "mixing") and rows:
                assert LONG in {r.text for r in rows}


EMPTY = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
}


@pytest.mark.parametrize("name", [*queries(), "pipeline"])
def test_queries_on_empty_tables(spark, tmp_path, name):
    for table, schema in EMPTY.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    run = corpus_pipeline.run if name == "pipeline" else queries()[name]
    assert run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_are_one_of_each_or_all(spark, docs):
    assert simhash.near_duplicates(spark, docs).count() == len(ROWS)
    assert mixing.mixed(docs).filter("doc_id = 3").count() in (2, 4)
