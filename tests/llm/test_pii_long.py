import random

from perkmill.llm import pii


def test_parts_of_more_digits_than_python_reads():
    text = f"n {'0' * 5000}1.2.3.4 and {'0' * 5000}.{'0' * 5000}.2.{'0' * 5000}256 end"
    assert [k for k, _, _ in pii.base_spans(text)] == [1]
    assert pii.base_spans(f"{'0' * 5000}1.2.3.4") == [(1, 0, 5007)]
    assert pii.base_spans(f"{'0' * 5000}.1.2.3") == [(1, 0, 5006)]


def test_long_seeds_alike_at_their_start_count_one_by_one(spark):
    rows = [(i, f"please write to {'a' * 70}{i}@mail.example today") for i in range(6)] + [(9, "please write to a.b@c1234 today")]
    assert len({e["name"] for i in range(6) for e in pii.entities(rows[i][1])}) == 6
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(docs).collect()}
    assert all(len(got[i]) == 1 and got[i][0][0] == "email" for i in range(6))
    assert got[9] == [("context", 16, 25)]


def plain_patterns(text, a, b):
    before, after = text[:a].lower().split()[-2:], text[b:].lower().split()[:1]
    own = pii.shape(text[a:b])
    return [f"{' '.join(before)} {own}", f"{before[-1]} {own} {' '.join(after)}"] if before else []


def test_contexts_have_no_window():
    rng = random.Random(4)
    parts = ["a", "Be", " ", "\n", "　", "é𝔘", "1.2.3.4", "x" * 30, " " * 100, "12345", "a@b.cd", ","]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        for e in pii.entities(text):
            want = plain_patterns(text, e["start"], e["end"])
            if all(len(w) <= pii.LONG_WORD for p in want for w in p.split()):
                assert e["patterns"] == want, text
    far = pii.entities("my card" + " " * 5000 + "12345678" + "\n" * 5000 + "thanks")
    assert far[0]["patterns"] == ["my card <number>", "card <number> thanks"]


def test_long_words_of_contexts_are_told_apart():
    """By all of them, wherever they stand, A-Z as a-z."""
    of = lambda t: pii.entities(t)[0]["patterns"]
    long = "x" * 100
    assert of(f"see {long} 12345678 now") == of(f"and so on see {long.upper()} 87654321 now")
    names = {of(f"see {w} 12345678 now")[0] for w in (long, "x" * 101, "y" + long[1:], long[:-1] + "y", "x" * 80)}
    assert len(names) == 5 and not any("xx" in n for n in names)


def test_one_very_long_word_takes_one_pass():
    pii.entities("n " + "a@b.cd;" * 40_000 + " " + "1.2.3.4,12345678;" * 20_000)


def test_candidates_overlap_no_base_span():
    rng = random.Random(6)
    parts = ["+10.20.30.40", " ", "1234567", "-", "4111111111111111", "(", ")", "a@b.c", "1.2.3.4", "+1 (223) 555-1234", ".", "77"]
    assert [e["kind"] for e in pii.entities("+10.20.30.40 1234567")] == ["ip", "phone"]
    for _ in range(3000):
        found = pii.entities("".join(rng.choice(parts) for _ in range(rng.randrange(10))))
        base = [(e["start"], e["end"]) for e in found if e["kind"] in pii.KINDS]
        for e in found:
            if e["kind"] not in pii.KINDS:
                assert not any(a < e["end"] and e["start"] < b for a, b in base)


def test_masking_many_spans_takes_one_pass(spark):
    n = 100_000
    assert pii.mask("a@b.cd " * n, [{"rank": 0, "start": 7 * i, "end": 7 * i + 6} for i in range(n)]) == "[EMAIL] " * n
    docs = spark.createDataFrame([(1, "a@b.cd " * 20_000), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.masked(docs).collect()} == {1: "[EMAIL] " * 20_000, 2: None}


def test_overlapping_spans_are_masked_whole():
    spans = [{"rank": 3, "start": 2, "end": 12}, {"rank": 1, "start": 3, "end": 8}, {"rank": 2, "start": 10, "end": 15}, {"rank": 0, "start": 15, "end": 16}]
    assert pii.mask("ab0123456789012xyz", spans) == "ab[PHONE][EMAIL]yz"
