from perkmill.llm import pii

CARDS = ["4111111111111111", "4012888888881881", "5555555555554444", "6011111111111117", "5105105105105100", "5200828282828210", "2223003122003222"]


def named(spark, texts):
    """Spans of `texts` that contexts name, among texts that make the contexts of cards and phones believed."""
    seeds = [f"doc my card number {c} thanks" for c in CARDS] + [f"please call me on +44 20 7946 0{100 + k} today" for k in range(7)]
    docs = spark.createDataFrame(list(enumerate([*texts, *seeds])), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.personal_data(docs).collect()}
    assert all(len(rows[len(texts) + k]) == 1 for k in range(len(seeds)))
    return [[t[s.start : s.end] for s in rows[i] if s.kind == "context"] for i, t in enumerate(texts)]


def test_contexts_name_whole_runs_of_digit_groups(spark):
    forms = ["020 7946 0958", "(223) 555-1234", "555.123.4567", "(020) 7946 (0958)"]
    texts = [f"please call me on {x} today" for x in forms]
    texts += ["doc my card number 3782 822463 10005 thanks", "doc my card number 3782 822463 10004 thanks"]
    # A run with another number behind it; one that isn't in a believed context.
    texts += ["please call me on 020 7946 0958 or 12 today", "rooms 020 7946 0958 are free"]
    want = [[x] for x in forms] + [["3782 822463 10005"], [], ["020 7946 0958"], []]
    assert named(spark, texts) == want


def test_identifiers_of_any_length(spark):
    # Alike in their first 64 characters.
    long = ["/".join(["123456789"] * 12) + f"/{k}" for k in range(2)]
    assert named(spark, [f"doc my card number {x} thanks" for x in long]) == [[x] for x in long]
    assert len({e["name"] for x in long for e in pii.entities(f"a {x}")}) == 2


def test_runs_and_tokens_of_a_text():
    def found(text):
        return sorted((text[e["start"] : e["end"]], e["kind"], e["run"]) for e in pii.entities(text))

    assert found("ring 020 7946 0958 now") == [("020 7946 0958", "context", True)]
    # Groups end at letters and at base spans; single tokens stay candidates beside the run.
    assert found("a 12345 678 3rd") == [("12345", "context", False), ("12345 678", "context", True)]
    assert found("x 7946 0958 10.0.0.1 1234 567") == [("10.0.0.1", "ip", False), ("1234 567", "context", True), ("7946 0958", "context", True)]
    assert found("x (020 7946)") == [("020 7946", "context", True)]
    assert found("id 1234-AB 12") == [("1234-AB", "context", False)]
    places = {(e["place"], e["run"]) for e in pii.entities("a 12345 67890 b")}
    assert places == {(2, False), (2, True)}


def test_long_texts_of_digits_and_signs_take_no_long():
    for text in ("12 " * 70_000, "(" * 200_000, "1" + " (" * 100_000, "1 2.3-" * 40_000 + "x", "+(1) " * 50_000, "1-" * 100_000, "10.0.0.1 1 2 " * 15_000):
        pii.entities(text)
