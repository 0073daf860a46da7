"""Term counts and divergences against plain Python and against SQL."""

from __future__ import annotations

import random
import re
from collections import Counter as Tally
from itertools import pairwise

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from perkmill.llm import divergence
from perkmill.llm.divergence import OP11_SQL, Counter, divergences, op11_divergence, probabilities, probability, radix_order

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def terms(text: str) -> list[str]:
    return [t.translate(LOWER) for t in TERM.findall(text)]


def plain(rows: list[tuple], least: int = 10) -> list[tuple]:
    """The whole answer, one group and term at a time."""
    docs = [(lang or "", source or "", terms(text or "")) for text, lang, source in rows]
    out = []
    for lang in {x for x, _, _ in docs}:
        own = [(s, t) for x, s, t in docs if x == lang]
        in_docs = Tally(t for _, ts in own for t in set(ts))
        kept = [t for t, n in in_docs.items() if n >= least]
        all_of = Tally(t for _, ts in own for t in ts)
        by = {s: Tally(t for x, ts in own if x == s for t in ts) for s, _ in own}

        def p(n: Tally, kept=kept) -> dict[str, int]:
            total = sum(n[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (n[t] + 2) // total for t in kept}

        probs, whole = {s: p(n) for s, n in by.items()}, p(all_of)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in by:
            pair = [(o, sum(f(probs[s][t], probs[o][t]) for t in kept)) for o in by if o != s]
            term = [(t, f(probs[s][t], whole[t])) for t in kept if by[s][t] > 0 and probs[s][t] > whole[t]]
            for part, values, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def text_of(rng: random.Random, words: list[str], n: int) -> str:
    return "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "9", "_", "@[", "{"]) for _ in range(n))


WORDS = ["a", "A", "Zz", "abcdefgh", "ABCDEFGHI", "sixteenletterabc", "seventeenletters!", "é", "É", "ßtraße", "漢字" * 9, "x" * 33, "Y" * 300, "ab", "abc", "ａｂ", "🙂"]


def counted(batches: list[list[tuple[str, str, str]]]) -> Tally:
    """What a task hands on, as (language, source, term) with occurrences and documents."""
    made = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in b], pa.string()) for i in range(3)], ["lang", "source", "text"]) for b in batches]
    out: Tally = Tally()
    for batch in divergence._count(iter(made)):
        for r in batch.to_pylist():
            key = r["lang"], r["source"], r["term"].decode()
            out[(*key, "n")] += r["n"]
            out[(*key, "docs")] += r["docs"]
    return Tally({k: v for k, v in out.items() if v})


@pytest.mark.parametrize("piece,most_runs", [(1 << 22, 1_000_000), (64, 30), (7, 3)])
def test_counts_of_a_task(monkeypatch, piece, most_runs):
    """Texts longer than a piece, terms longer than a piece, empty texts, and handing on early."""
    monkeypatch.setattr(divergence, "PIECE", piece)
    monkeypatch.setattr(divergence, "MOST_RUNS", most_runs)
    rng = random.Random(piece)
    rows = [(rng.choice(["de", "en", ""]), rng.choice("pqr"), text_of(rng, WORDS, rng.choice([0, 1, 2, 60, 400]))) for _ in range(60)]
    rows += [("en", "p", "z" * 500), ("en", "p", "abc"), ("en", "p", "def"), ("en", "q", ""), ("de", "q", "!!")] * 2
    expected: Tally = Tally()
    for lang, source, text in rows:
        for t, n in Tally(terms(text)).items():
            expected[(lang, source, t, "n")] += n
            expected[(lang, source, t, "docs")] += 1
    assert counted([rows[:25], [], rows[25:26], rows[26:]]) == expected


def test_every_group_is_handed_on():
    counter = Counter()
    counter.groups = {("en", "p"): 0, ("en", "q"): 1}
    found = [r for b in counter.handed_on(True) for r in b.to_pylist()]
    assert [(r["source"], r["term"], r["n"]) for r in found] == [("p", b"", 0), ("q", b"", 0)]


def test_radix_order():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 1000).astype(np.uint32), rng.integers(0, 2**64, 1000, dtype=np.uint64)
    b[::3] = b[0]
    order = radix_order([a, b])
    assert order.tolist() == np.lexsort([np.arange(1000), a, b]).tolist()
    assert all(x <= y for x, y in pairwise(b[order].tolist()))


def test_probabilities_are_exact(spark):
    """Counts far beyond what a product in a long would hold."""
    rows = [(n, t) for n, t in [(0, 2), (0, 7), (5, 14), (10**15, 4 * 10**15), (8 * 10**15, 9 * 10**15 - 1), (3, 3 * 10**14 + 7)]]
    expected = [1 + 10**9 * (n + 2) // t for n, t in rows]
    assert probabilities(*np.array(rows).T).tolist() == expected
    df = spark.createDataFrame(rows, "n long, t long")
    assert [r.p for r in df.select(probability(F.col("n"), F.col("t")).alias("p")).collect()] == expected


def answers(spark, rows, least=10):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")
    return sorted(map(tuple, divergences(df, least_docs=least).collect()))


@pytest.mark.parametrize("group_rows,block_cells,group_sources", [(100_000, 1 << 18, 256), (7, 5, 2)])
def test_against_plain_python(spark, monkeypatch, group_rows, block_cells, group_sources):
    """Nulls, empty texts, repeated rows, sources without terms, languages without kept terms, ties."""
    monkeypatch.setattr(divergence, "GROUP_ROWS", group_rows)
    rng = random.Random(3)
    words = [*WORDS, *[a + b for a in "klmnop" for b in "aeiou"]]
    rows = [(text_of(rng, words[k % 5 :: 2], rng.randint(0, 40)), rng.choice(["de", "en"]), f"s{k % 6}") for k in range(150)]
    rows += [("one two", "it", "s1"), ("", "it", "s2"), (None, None, "s1"), ("", None, None), ("word", "fr", "s9"), ("9", "de", "none")]
    rows += rows[:30]
    if group_sources == 2:  # small groups and blocks, as the workers' module has them
        key = pa.scalar("en"), pa.scalar(0), pa.scalar(1)
        monkeypatch.setattr(divergence, "GROUP_SOURCES", 2)
        monkeypatch.setattr(divergence, "BLOCK_CELLS", 5)
        table = pa.table({"term": ["a", "a", "b", None, None, None, None], "number": [0, 3, 2, 0, 1, 2, 3], "n": [4, 1, 2, 10, 9, 8, 7]})
        got = {(r["a"], r["b"]): r["value"] for r in divergence._pair_sums(key, table).to_pylist()}
        p = lambda n, s: 1 + 10**9 * (n + 2) // [10, 9, 8, 7][s]
        f = lambda a, b: (a - b) ** 2 // (a + b)
        assert got == {(2, 3): f(p(0, 2), p(1, 3)) + f(p(2, 2), p(0, 3))}
        monkeypatch.undo()
        monkeypatch.setattr(divergence, "GROUP_ROWS", group_rows)
    assert answers(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert answers(spark, []) == []


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    df = op11_divergence(spark, sf_dir)
    expected = con.execute(f"select {', '.join(df.columns)} from ({OP11_SQL})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected)
