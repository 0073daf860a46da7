import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from perkmill.llm import mixing


def table(spark, sizes):
    """Sources with so many documents of 10 words each."""
    rows = [(k * 10_000 + i, "w " * 10, s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def plan(spark, sizes, **how):
    sources = spark.createDataFrame([(s, 10 * n, n) for s, n in sizes.items()], "source string, tokens long, docs long")
    return {r.source: r for r in mixing.budgets(sources, **how).collect()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights)


SIZES = {"big": 4000, "mid": 900, "low": 300, "tiny": 40}


def test_target_entropy(spark):
    got = plan(spark, SIZES, target=0.7, most_passes=1e9)
    weights = [r.weight for r in got.values()]
    assert abs(sum(weights) - 1) < 1e-9
    assert abs(entropy(weights) / math.log(4) - 0.7) < 1e-5
    share = {s: n / sum(SIZES.values()) for s, n in SIZES.items()}
    alphas = [math.log(got[s].weight / got["big"].weight) / math.log(share[s] / share["big"]) for s in ("mid", "low", "tiny")]
    assert max(alphas) - min(alphas) < 1e-6


def test_repetition_limit(spark):
    got = plan(spark, SIZES, target=0.95, most_passes=3.0)
    times = {s: r.budget / r.tokens for s, r in got.items()}
    assert 2.9 < times["tiny"] <= 3.01 and max(times.values()) == times["tiny"]


def test_cover_holds_every_source_whole(spark):
    got = plan(spark, SIZES, target=0.95, most_passes=2.0, cover=True)
    times = sorted(r.budget / r.tokens for r in got.values())
    assert abs(times[0] - 1) < 1e-6 and times[-1] <= 2.01


def test_budgets_are_met_by_whole_documents(spark):
    docs = table(spark, SIZES)
    rows = mixing.told_apart(docs, "source", "doc_id", "text")
    chosen = mixing.mix(rows, "tokens", "source", "doc_id", target=0.9, most_passes=4.0)
    times = {r.id: r["count"] for r in chosen.groupBy("id").count().collect()}
    want = plan(spark, SIZES, target=0.9, most_passes=4.0)
    tokens = {r.source: r.t for r in chosen.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    for k, s in enumerate(SIZES):
        assert want[s].budget - 10 < tokens[s] <= want[s].budget
        own = [times.get(k * 10_000 + i, 0) for i in range(SIZES[s])]
        assert max(own) - min(own) <= 1  # permutations: nothing a second time before all once
    # Blocks hold the sources alike.
    blocks = chosen.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("source") == "big").cast("int")).alias("big")).collect()
    share = sum(r.n * r.big for r in blocks) / sum(r.n for r in blocks)
    assert all(abs(r.big - share) < 0.1 for r in blocks)


def test_same_mix_twice(spark):
    rows = mixing.told_apart(table(spark, SIZES), "source", "doc_id", "text")
    first, second = (sorted(mixing.mix(rows, "tokens", "source", "doc_id").collect()) for _ in range(2))
    assert first == second


def test_edge_rows(spark):
    rows = [(1, "a b", "x", 9), (2, None, None, 9), (3, "", "y", 9), (4, "c", None, 9), (4, "c", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    # The source without words has no share in the mix.
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 4, 4]
    assert mixing.mixed(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.filter("doc_id = 1")).count() == 1


def test_query(spark, sf_dir):
    rows = mixing.op4_mixing(spark, sf_dir).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.block, []).append(r.slot)
    assert all(sorted(s) == list(range(1, len(s) + 1)) for s in slots.values())
    docs = {d.doc_id: len((d.text or "").split()) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sum(r.n_tokens for r in rows) <= sum(docs.values())


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_one_mix_however_the_table_is_split(spark, sf_dir, parts):
    """Equal rows too: the very same rows in the very same blocks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.unionByName(docs.filter("doc_id % 5 = 0"))
    split = docs.repartition(parts, F.hash("text", F.lit(parts)))
    rows = mixing.told_apart(split, "source", "doc_id", "text")
    got = sorted(map(str, mixing.mix(rows, "tokens", "source", "doc_id").collect()))
    if not MIXES:
        MIXES.append(got)
    assert got == MIXES[0]


MIXES: list = []


def spark_hash(*values):
    """Spark's xxhash64 of ints (as 4 bytes: `np.int32`), longs and strings."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(4 if isinstance(v, np.int32) else 8, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


def brute_mix(rows, target, most_passes):
    """The mix in plain Python, from (key, copy, id, source, tokens): (id, copy, pass, block)."""
    tokens, docs = Counter(), Counter()
    for _, _, _, s, n in rows:
        tokens[s] += n
        docs[s] += 1
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    def meets(a):
        return entropy(weights(a).values()) >= target * math.log(len(share)) - 1e-9

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if meets(middle) else (low, middle)
    assert all(w / share[s] <= most_passes for s, w in weights(low).items())
    budget = {s: round(w * total) for s, w in weights(low).items()}
    size = sum(docs[s] * budget[s] / tokens[s] for s in share)
    blocks = max(1, math.ceil(size / mixing.BLOCK))
    out = []
    for s in share:
        for k in range(budget[s] // tokens[s] + 1):
            placed = []
            for key, copy, i, source, n in rows:
                if source == s:
                    h = spark_hash(np.int32(mixing.SEED), f"={s}", k, i, key, copy)
                    placed.append(((h & (2**52 - 1)) / 2**52, (key, copy), i, n))
            left = budget[s] - k * tokens[s]
            for place, (_, copy), i, n in sorted(placed):
                left -= n
                if left < 0:
                    break
                block = min(blocks - 1, math.floor((k + place) / (budget[s] / tokens[s]) * blocks))
                out.append((i, copy, k, block))
    return sorted(out)


def test_mix_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice(["a"] * 12 + ["b"] * 4 + ["c"])) for i in range(200)]
    rows += rows[:9] + [(900, "w w", "c"), (900, "w w w", "c"), (901, "", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    table = mixing.told_apart(docs, "source", "doc_id", "text")
    given = [(r.row.key, r.row.copy, r.doc_id, r.source, r.tokens) for r in table.collect()]
    assert len(given) == len(rows)
    got = mixing.mix(table, "tokens", "source", "doc_id", target=0.9, most_passes=50.0)
    assert sorted((r.id, r.row.copy, r["pass"], r.block) for r in got.collect()) == brute_mix(given, 0.9, 50.0)


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    docs = spark.createDataFrame([(1, "a b", "x")] * 50 + [(2, "c", "x")], "doc_id long, text string, source string")
    rows = mixing.told_apart(docs, "source", "doc_id", "text").collect()
    assert sorted((r.doc_id, r.row.copy) for r in rows) == [(1, k) for k in range(50)] + [(2, 0)]
    assert mixing.mixed(docs).count() == 51


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "word " * 1_000_000, "x"), (2, "few words", "y"), (3, "z" * 5_000_000, "y")], "doc_id long, text string, source string")
    got = {r.doc_id: len(r.text) for r in mixing.mixed(docs).collect()}
    assert got == {1: 5_000_000, 2: 9, 3: 5_000_000}
