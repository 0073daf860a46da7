import hashlib
import random
import re

from perkmill.llm import pii


def brute(text):
    text = text or ""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(1, *m.span())] * all(int(x) <= 255 for x in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        out += [(2, *m.span())] * (16 <= len(digits) <= 19 and sum(doubled) % 10 == 0)
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(3, *m.span())] * (8 <= sum(c.isdigit() for c in m[0]) <= 15)
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b", "@", ".", "1", "23", "255", "256", " ", "-", "+", "(", ")", "%", "4111111111111111", "a@b.c", "1.2.3.4", "+1 (223) 555-1234", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == brute(text), text


def test_runs_without_a_match_take_no_long():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "@" * 200_000, "12 " * 70_000):
        pii.entities(text)


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in pii.op5_pii(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        base, r = brute(d.text), rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith(pii.CONTEXT)] == [s for s in text.split(",") if s]


CARDS = ["4111111111111111", "4012888888881881", "5555555555554444", "6011111111111117", "5105105105105100", "5200828282828210", "2223003122003222"]


def corpus(spark, refused):
    rows = [(i, f"doc {i} my card number {n} thanks") for i, n in enumerate(CARDS)]
    rows += [(50, "doc my card number 411-23-11134 thanks"), (51, "the year 2023-10-11 was"), (52, "so 4111-1111 my order")]
    rows += [(100 + i, f"my card number 4111{i:012d} thanks") for i in range(refused) if not pii.luhn(f"4111{i:012d}")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_find_unseen_identifiers(spark):
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(corpus(spark, 0)).collect()}
    assert got[50] == [("context", 19, 31)] and got[51] == [] and got[52] == []
    assert all(len(got[i]) == 1 and got[i][0][0] == "card" for i in range(len(CARDS)))


def test_refused_matches_hold_a_context_down(spark):
    got = {r.doc_id: r.spans for r in pii.personal_data(corpus(spark, 30)).collect()}
    assert got[50] == [] and not any(got[i] for i in got if i >= 100)


def brute_scores(edges):
    """Plain version of the rounds, from (pattern, name, known) triples."""
    belief = {n: k or 0.0 for _, n, k in edges}
    for left in reversed(range(pii.ROUNDS)):
        score = {}
        for p in {p for p, _, _ in edges}:
            own = [belief[n] for q, n, _ in edges if q == p]
            score[p] = sum(own) / len(own) * (1 - 2 ** -sum(own))
        if left:
            known = {n: max((k for _, m, k in edges if m == n and k is not None), default=None) for n in belief}
            for n in belief:
                own = [score[p] for p, m, _ in edges if m == n]
                belief[n] = known[n] if known[n] is not None else sum(own) / len(own)
    return score


def test_scores_equal_a_plain_version(spark):
    rng = random.Random(9)
    known = {n: rng.choice([1.0, 0.0, None, None]) for n in range(60)}
    edges = sorted({(f"p{rng.randrange(12)}", n) for n in known for _ in range(3)})
    edges = [(p, n, known[n]) for p, n in edges]
    graph = spark.createDataFrame(edges, "pattern string, name long, known double")
    got = {r.pattern: r for r in pii.scored_patterns(graph).collect()}
    want = brute_scores(edges)
    assert got.keys() == want.keys()
    for p, r in got.items():
        assert abs(r.score - want[p]) < 1e-9
        assert r.seeds == sum(q == p and k == 1 for q, _, k in edges)


def test_masked_texts_and_edge_rows(spark):
    rows = [(1, None, 0, 1), (2, "", 0, 1), (3, "x a@b.c y", 9, 1), (3, "x a@b.c y", 9, 1), (4, "é𝔘 +1 (223) 555-1234", 20, 1), (5, "10.0.0.1@a.b z", 14, 1), (6, "w " * 50_000 + "a@b.c", 100_005, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans int")
    out = pii.masked(docs, length="n_chars")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [r.text for r in got[:6]] == [None, "", "x [EMAIL] y", "x [EMAIL] y", "é𝔘 [PHONE]", "[EMAIL] z"]
    assert got[6].text == "w " * 50_000 + "[EMAIL]" and all(r.n_chars == len(r.text or "") for r in got)
    assert pii.masked(docs.limit(0)).count() == 0 and pii.personal_data(docs.limit(0)).count() == 0
