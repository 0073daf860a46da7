import importlib

import corpus_pipeline
from perkmill.llm import langid, pii
from tests.llm.test_simhash import brute_groups, brute_print

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def rows():
    base = "the cat and the dog went over the hill and sat by the river for a long day "
    out = [(i, f"{base * 3} number {i * 7919} of them, and word{i} word{i * 3}", "en", "big" if i % 3 else f"s{i % 4}", 0, 1) for i in range(60)]
    out += [(100 + i, f"der hund und die katze {i} gingen über den berg und sie saßen am fluss {i * 31}", "de", "d", 0, 1) for i in range(20)]
    out += [(200, None, None, None, None, None), (201, "", "en", "big", 0, 1), (202, "123 456", "en", "big", 7, 1)]
    out += [(300 + i, out[5][1], "en", "copy", 0, 1) for i in range(30)]
    out += [(400, f"{base} write to me.you@mail.example.com soon", "en", "big", 0, 1)] * 2
    return out


def test_stages(spark, sf_dir):
    docs = spark.createDataFrame(rows(), COLUMNS)
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language"](spark, docs, sf_dir)
    assert known.columns == docs.columns
    kept = known.collect()
    assert {r.doc_id for r in kept} == {r[0] for r in rows()} - {200, 201, 202}
    single = stage["near_duplicates"](spark, known, sf_dir)
    assert single.columns == docs.columns
    prints = {r.doc_id: brute_print(r.text) for r in kept}
    groups = brute_groups(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(least.get(groups[p], i), i)
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())
    masked = stage["personal_data"](spark, single, sf_dir)
    assert masked.columns == docs.columns
    for r in masked.collect():
        assert pii.base_spans(r.text) == []
        assert "[EMAIL]" in r.text if r.doc_id == 400 else True
    mixed = stage["mixing"](spark, masked, sf_dir)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in masked.collect()}
    tokens = stage["bpe"](spark, mixed, sf_dir).collect()
    assert len(tokens) == mixed.count() and all(len(r.ids) == 4 * r.n_tokens for r in tokens)


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_run_keeps_clean_documents(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    groups = brute_groups({brute_print(d.text) for d in docs})
    distinct = len({groups[brute_print(d.text)] for d in docs})
    assert out.select("doc_id").distinct().count() >= 0.97 * distinct


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and langid.UNKNOWN == "und"
