import random
import re
from collections import Counter

from perkmill.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def counts(df):
    return [tuple(r) for r in df.select(*quality.BASE).collect()]


def test_statistics(spark):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "a b c a b c", "a a a a", "x\n\nx\n \nx y", "é𝔘 ## a", "w " * 30_000]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "#", "\x0b", "é"]) for _ in range(rng.randrange(120))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, n_words int").repartition(1).sortWithinPartitions("doc_id")
    got = quality.with_statistics(df, "text", ["doc_id"]).orderBy("doc_id")
    assert counts(got) == [brute(t) for t in texts]


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in quality.op3_quality(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r, want = rows[d.doc_id], brute(d.text)
        assert tuple(r[k] for k in quality.BASE) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    open_ = [r for r in rows.values() if not r.base_failed and r.doc_id in labels]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in open_) >= 0.9 * len(open_)
    assert sum(r.kept for r in open_ if labels[r.doc_id]) >= 0.98 * sum(labels[r.doc_id] for r in open_)


def learned(spark, rows):
    """Rules from (symbol_share, repeat_share, bad) triples."""
    stats = spark.createDataFrame(
        [(i, 100, 500, int(500 * s), 0, int(100 * r), 10) for i, (s, r, _) in enumerate(rows)],
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long",
    )
    labels = spark.createDataFrame([(i, None if b is None else 1 - b) for i, (_, _, b) in enumerate(rows)], "doc_id long, quality int")
    return stats, quality.learned(stats, labels)


def test_conjunction_is_found(spark):
    rng = random.Random(2)
    rows = [(s, r, int(s > 0.5 and r > 0.5)) for s, r in ((rng.random(), rng.random()) for _ in range(1500))]
    stats, rules = learned(spark, rows)
    verdict = {r.doc_id: r.reason is not None for r in stats.select("doc_id", quality.reason(rules).alias("reason")).collect()}
    assert sum(verdict[i] == bool(b) for i, (_, _, b) in enumerate(rows)) >= 0.93 * len(rows)
    assert any(len(r) > 1 for r in rules)


def test_no_rule_without_two_classes_or_for_noise(spark):
    assert learned(spark, [(0.1, 0.1, 0)] * 30)[1] == []
    assert learned(spark, [(0.1, 0.1, None)] * 30)[1] == []
    assert learned(spark, [(0.3, 0.3, i % 2) for i in range(60)])[1] == []
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learned(quality.with_statistics(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "text", ["doc_id"]), empty) == []
    assert spark.range(1).select(quality.reason([]).alias("r")).first().r is None


def test_ordered_conditions():
    rule = (quality.Condition("symbol_share", True, 0.25), quality.Condition("word_length", False, 3.0))
    assert " and ".join(map(str, rule)) == "symbol_share > 0.25 and word_length <= 3"
    cells = [quality.Cell((1, 0), True, True, 5), quality.Cell((0, 1), True, False, 7)]
    learner = quality.Learner(cells, {"symbol_share": [0.25], "word_length": [3.0]})
    assert learner.counts(rule, cells) == (5, 0)
