"""Pairwise ranking: features, the convex fit, the threshold, and accuracy on documents not learned from."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perkmill.llm import ranking
from perkmill.llm.ranking import KINDS, LEAST_GOOD, RIDGE, STATISTICS, features, fit, loss, op12_ranking, preferences, quantile, scored, train


def plain_statistics(text: str) -> list[float]:
    """`STATISTICS` of one text, word by word."""
    raw = text.encode()
    words, n = raw.split(), len(raw.split())
    if not n:
        return [0.0] * len(STATISTICS)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [tuple(x.split()) for x in raw.split(b"\n") if x.split()]
    some = max(len(lines), 1)
    return [
        np.log1p(n),
        np.log1p(sum(map(len, words)) / max(n, 1)),
        (n - len(set(words))) / max(n, 1),
        len(covered) / max(n, 1),
        np.log1p(n / some),
        (len(lines) - len(set(lines))) / some,
        sum(w[:1].isupper() for w in words) / max(n, 1),
        sum(w[-1:] in b".,;:!?" for w in words) / max(n, 1),
    ]


def made(rng: random.Random, n: int) -> str:
    pool = ["a", "b.", "C", "longer-than-eight-bytes", "longer-than-eight-bytez", "é", "Word,", "x" * 40]
    return "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\t ", " \n\n"]) for _ in range(n))


@pytest.mark.parametrize("piece", [1 << 22, 100, 9])
def test_features_against_plain_python(monkeypatch, piece):
    """Whatever the pieces: of many texts at once, or of one."""
    monkeypatch.setattr(ranking, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["", "  \n ", "one", *[made(rng, rng.choice([1, 2, 3, 10, 80])) for _ in range(40)], "", "word"]
    x = features(pa.array(texts, pa.string()))
    assert x.shape == (len(texts), KINDS + len(STATISTICS))
    for text, row in zip(texts, x, strict=True):
        assert row[KINDS:] == pytest.approx(plain_statistics(text))
        raw = text.encode()
        assert row[:KINDS] ** 2 == pytest.approx([(raw.count(b) if b < 128 else sum(c > 127 for c in raw)) / max(len(raw), 1) for b in range(KINDS)])


def test_sliced_arrays():
    texts = pa.array(["first text", "", "second\ntext here", "third"], pa.string())
    assert np.array_equal(features(texts)[2:], features(texts[2:]))
    assert features(texts[:0]).shape == (0, KINDS + len(STATISTICS))


def test_fit_is_the_minimum():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.4, 1, (60, 5)), rng.normal(0, 1, (40, 5))
    model = fit(good, bad, 0.4)
    scale = 1 / np.concatenate([good, bad]).std(axis=0)
    a, b = preferences(60, 40)
    gaps = (good[a] - bad[b]) * scale
    w = model.weights / scale
    for k in range(5):
        for d in (1e-3, -1e-3):
            assert loss(w + d * np.eye(5)[k], gaps) > loss(w, gaps)
    slope = -(gaps / (1 + np.exp(gaps @ w))[:, None]).mean(axis=0) + RIDGE * w
    assert np.abs(slope).max() < 1e-6


def test_every_document_is_in_a_pair():
    for good, bad in ((5, 3), (2, 100), (1, 1), (100, 2)):
        a, b = preferences(good, bad)
        assert set(a) == set(range(good)) and set(b) == set(range(bad))


def test_threshold_is_the_quantile():
    good, bad = np.arange(10.0, 20), np.arange(0.0, 10)
    assert quantile(good, bad, 0.5) == 9.5
    assert quantile(good, bad, 0.1) == 9.5  # the classes weigh as among the labels
    assert quantile(np.array([1.0]), np.array([1.0]), 0.5) == 1.0


def test_held_out_accuracy(spark):
    """On the larger test table, over documents not learned from."""
    sf = "/root/testdata/sf0.01"
    rows = op12_ranking(spark, sf).collect()
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= LEAST_GOOD) for r in rows)
    kept = [r for r in rows if r.held_out and r.doc_id in marks]
    assert len(kept) > 50 and np.mean([r.predicted == marks[r.doc_id] for r in kept]) >= 0.97
    order = [(r.score, marks[r.doc_id]) for r in kept]
    better = [a > b for a, x in order for b, y in order if x == 1 and y == 0]
    assert np.mean(better) >= 0.97


def test_edge_rows(spark):
    """Null, empty and very long texts, repeated rows, clashing columns, labels that are none or disagree."""
    long = "good words here. " * 400_000
    docs = [(k, f"A text of words, number {k}, that reads well enough.") for k in range(40)] + [(100 + k, f"### {k} $$$ %%% &&& ###") for k in range(40)]
    docs += docs[:5] + [(200, None), (201, ""), (202, long), (202, long), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, 2, 3.0) for i, t in docs], "doc_id long, text string, q int, i int, score double")
    labels = [(k, 1) for k in range(40)] + [(100 + k, 0) for k in range(40)] + [(1, 1), (2, 0), (3, None), (4, 7), (None, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = train(df, marks)
    got = [(r.doc_id, r.s) for r in df.select("doc_id", scored(spark, model, df["text"]).alias("s")).collect()]
    assert len(got) == len(docs)
    by = {}
    for i, s in got:
        assert by.setdefault(i, s) == s
    assert all(by[k] >= LEAST_GOOD for k in range(40)) and all(by[100 + k] < LEAST_GOOD for k in range(40))
    assert by[200] == by[201] and 0 <= by[200] <= 1 and by[202] >= LEAST_GOOD


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)], [(7, 1), (8, 0)]):
        model = train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert model is None
        assert [r.s for r in docs.select(scored(spark, model, docs["text"]).alias("s")).collect()] == [0.5, 0.5]
    assert train(docs.limit(0), spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")) is None


def some_documents(good: int, bad: int, seed: int = 7) -> tuple[list, list]:
    """Texts of both classes that overlap, so that no line parts them; labels of all."""
    rng = random.Random(seed)
    plain, odd = ["some", "plain", "Words,", "read", "well."], ["##", "$$ 12", "x%", "&&", "read"]
    text = lambda often: "".join((rng.choice(plain) if rng.random() < often else rng.choice(odd)) + rng.choice("  \n") for _ in range(rng.randint(4, 20)))
    docs = [(k, text(0.7)) for k in range(good)] + [(10_000 + k, text(0.4)) for k in range(bad)]
    return docs, [(i, int(i < 10_000)) for i, _ in docs]


def learnable(docs: list) -> list:
    return sorted((i, t) for i, t in docs if zlib.crc32(str(i).encode()) % 5)


def test_every_labelled_document_counts(spark):
    """More than 2,000 of a class: the threshold is the quantile of all, and each has a say in the weights."""
    docs, labels = some_documents(3000, 300)
    df, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = train(df, marks)
    kept = learnable(docs)
    x = features(pa.array([t for _, t in kept], pa.string()))
    is_good = np.array([i < 10_000 for i, _ in kept])
    assert is_good.sum() > 2000
    good, bad = x[is_good], x[~is_good]
    assert model.threshold == pytest.approx(quantile(good @ model.weights, bad @ model.weights, len(bad) / len(kept)), abs=1e-9)
    places = {r.doc_id: r.p for r in df.select("doc_id", F.xxhash64("doc_id").bitwiseAND(2**40 - 1).alias("p")).collect()}
    block = np.array([places[i] % 2 for i, _ in kept])  # 2,600 documents are two blocks
    scale = ranking.scale_of(x.std(axis=0))
    parts = [(x[is_good & (block == b)], x[~is_good & (block == b)]) for b in (0, 1)]
    plain = ranking.newton(lambda w: sum(ranking.pair_sums(g, b, scale, w) for g, b in parts), x.shape[1]) * scale
    assert model.weights == pytest.approx(plain, rel=1e-5, abs=1e-7)
    # The same however the tables are split.
    again = train(df.repartition(7, "text"), marks.repartition(3))
    assert np.array_equal(again.weights, model.weights) and again.threshold == model.threshold


def test_one_block_is_the_plain_fit(spark):
    docs, labels = some_documents(120, 60)
    model = train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    good, bad = (features(pa.array([t for i, t in learnable(docs) if (i < 10_000) == k], pa.string())) for k in (True, False))
    plain = fit(good, bad, len(bad) / (len(good) + len(bad)))
    assert model.weights == pytest.approx(plain.weights, rel=1e-6, abs=1e-9) and model.threshold == pytest.approx(plain.threshold, abs=1e-9)


@pytest.mark.parametrize(("good", "bad"), [(200, 3), (3, 200), (150, 140)])
def test_blocks_hold_everything(spark, monkeypatch, good, bad):
    """Each document counts once and has a partner, also where one class is rare and sums are added in levels."""
    monkeypatch.setattr(ranking, "BLOCK", 16)
    monkeypatch.setattr(ranking, "LEAST", 2)
    monkeypatch.setattr(ranking, "WIDE", 2)
    rows = [(i, q, float(i)) for q, n in ((1, good), (0, bad)) for i in range(1000 * q, 1000 * q + n)]
    df = spark.createDataFrame(rows, "i long, q int, v double").withColumn("place", F.xxhash64("i").bitwiseAND(2**40 - 1))

    @F.arrow_udf("binary")
    def filled(v: pa.Array) -> pa.Array:
        return pa.array([np.full(137, x).tobytes() for x in v.to_pylist()], pa.binary())

    blocks, n, rare, copies = ranking._dealt(df.withColumn("x", filled("v")), good, bad)
    found = {1: [], 0: []}
    for r in blocks.collect():
        sides = {1: ranking._matrix(r.good)[:, 0], 0: ranking._matrix(r.bad)[:, 0]}
        assert sum(map(len, sides.values())) < 16 * 6
        for q in (1, 0):
            if len(sides[1 - q]):
                found[q] += [(v, q != rare or r.number % copies == 0) for v in sides[q]]
    assert blocks.count() <= n and n > 2
    for q in (1, 0):
        assert {v for v, _ in found[q]} == {v for _, k, v in rows if k == q}
    everything = ranking._summed(blocks, n, lambda number, g, b: sum(np.array([len(x), x[:, 0].sum()]) for q, x in ((1, g), (0, b)) if q != rare or number % copies == 0))
    assert everything.tolist() == [len(rows), sum(v for _, _, v in rows)]


def test_threshold_of_any_number(spark):
    """The counted quantile is that of all utilities, with equal ones, zeros of both signs and negative ones."""
    rng = np.random.default_rng(11)
    for good, bad, share in (
        (rng.normal(1, 1, 300), rng.normal(-1, 1, 90), 0.25),
        (np.array([0.0, -0.0, 0.0, 5]), np.array([-1.0, 0.0, -0.0]), 0.5),
        (np.array([2.0, 2.0]), np.array([2.0]), 1 / 3),
        (np.array([-3.0, -1e-300]), np.array([-1e300, -4.0]), 0.5),
        (np.array([1.0]), np.array([0.0]), 0.9),
    ):
        rows = [(int(k), q) for q, u in ((1, good), (0, bad)) for k in ranking.order_key(u)]
        got = ranking.threshold_of(spark.createDataFrame(rows, "key long, q int"), len(good), len(bad), share)
        assert got == quantile(good, bad, share)


def test_of_an_id_with_several_texts_the_least_is_learned(spark):
    docs, labels = some_documents(40, 40)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    alone = train(spark.createDataFrame(docs, "doc_id long, text string"), marks)
    more = docs + [(i, t + "z more") for i, t in docs[::3]] + docs[:9]
    model = train(spark.createDataFrame(more, "doc_id long, text string"), marks)
    assert np.array_equal(model.weights, alone.weights) and model.threshold == alone.threshold
