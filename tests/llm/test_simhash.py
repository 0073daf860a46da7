import numpy as np
import xxhash

from perkmill.llm import simhash


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Smallest print reachable over links of at most 3 bits."""
    names = sorted(prints)
    root = {p: p for p in names}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in names}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def test_cover_holds_every_choice_of_shared_bytes():
    from itertools import combinations

    sets = simhash.cover()
    assert all(any(set(s) <= set(c) for s in sets) for c in combinations(range(8), 5))


def test_query(spark, sf_dir):
    rows = simhash.op8_simhash(spark, sf_dir).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    groups = brute_groups(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(least.get(groups[p], i), i)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {i: (f"{p:016x}", least[groups[p]]) for i, p in prints.items()}


def chains(rng, n):
    """Prints in chains of few bits' steps, so that groups are long and postings full."""
    out = []
    for _ in range(4):
        p = int(rng.integers(0, 1 << 63))
        for _ in range(n):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                p ^= 1 << int(b)
            out.append(p)
    base = int(rng.integers(0, 1 << 63))
    return list({*out, *[base ^ int(rng.integers(0, 1 << 14)) for _ in range(150)]})


def test_large_postings_give_the_same_components(spark):
    prints = chains(np.random.default_rng(3), 40)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    want = {}
    for p, r in brute_groups(prints).items():
        want.setdefault(r, set()).add(signed(p))
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    for large in (simhash.LARGE, 8):
        got = {}
        for r in simhash.components(simhash.links(spark, df, large)).collect():
            got.setdefault(r.root, set()).add(r.fp)
        assert {frozenset(g) for g in got.values()} == want


def test_edge_rows(spark):
    rows = [(5, None), (3, ""), (7, "one"), (8, "One"), (None, "one"), (9, "a b c d"), (9, "a b c d"), (2, "q " * 50_000)]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, fp string, row int")
    got = {(r.doc_id, r.low) for r in simhash.near_duplicates(spark, df).collect()}
    assert got == {(5, 3), (3, 3), (7, 7), (8, 7), (None, 7), (9, 9), (2, 2)}
    kept = simhash.one_of_each(spark, df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7, 9]
    assert simhash.one_of_each(spark, df.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "one"), (None, "one")], "doc_id long, text string")
    assert simhash.one_of_each(spark, nameless).count() == 1
