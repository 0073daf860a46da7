import random
import string

from pyspark.sql import functions as F

from perkmill.llm import secrets, wordlike

ALPHABETS = {
    "upper hex": string.digits + "ABCDEF",
    "lower": string.ascii_lowercase,
    "base32": string.ascii_uppercase + "234567",
    "base36": string.ascii_lowercase + string.digits,
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "url64": string.ascii_letters + string.digits + "-_",
}
NAMES = "customer order report backup status monitor garden window letter silver planet bridge summer market doctor winter river engine rechnung kunde fenster strasse maison fichier ventana camino".split()


def named(rng, kind, n):
    """A token of `n` characters made of words, names and numbers, in the style of the alphabet."""
    number = "".join(rng.choice("234567") for _ in range(rng.randint(2, 6)))
    words = [rng.choice(NAMES) for _ in range(20)]
    upper, camel = [w.upper() for w in words], [w.capitalize() for w in words]
    style = {
        "upper hex": "FACADE" + number + "BEEF" * 20,
        "lower": "".join(words),
        "base32": upper[0] + number + "".join(upper),
        "base36": words[0] + number + "".join(words),
        "base62": camel[0] + number + "".join(camel),
        "base64": "/".join([words[0], number, *camel]),
        "url64": rng.choice("-_").join([words[0], number, *words]),
    }
    return style[kind][:n]


def test_random_tokens_among_names(spark):
    """Recall by alphabet and length where one token in ten is random; few names are taken for random."""
    rng = random.Random(12)
    rows, cases = [], [(kind, n) for kind in ALPHABETS for n in (20, 32, 40, 64)]
    for i, (kind, n) in enumerate(cases):
        rows += [(i, True, f"see {''.join(rng.choice(ALPHABETS[kind]) for _ in range(n))} end") for _ in range(100)]
        rows += [(i, False, f"see {named(rng, kind, n)} end") for _ in range(900)]
    df = spark.createDataFrame([(2 * i + planted, text) for i, planted, text in rows], "doc_id int, text string").repartition(8)
    got = {r.doc_id: r.n for r in secrets.secrets(df).groupBy("doc_id").agg(F.sum(F.size("spans")).alias("n")).collect()}
    recall = {(kind, n): got[2 * i + 1] / 100 for i, (kind, n) in enumerate(cases)}
    wrong = {case: got[2 * i] for i, case in enumerate(cases) if got[2 * i]}
    print({case: round(100 * share) for case, share in recall.items()}, wrong)
    # Measured: at 20 characters 0.83 to 0.97, from 32 on 0.95 and more.
    for (kind, n), share in recall.items():
        assert share >= (0.95 if n > 20 else 0.75 if kind == "upper hex" else 0.85), (kind, n, share)
    assert sum(wrong.values()) <= secrets.RATE * sum(got.values()), wrong


def test_chains_are_distributions():
    """The chain of every alphabet is a distribution, which is all that the bound on p-values needs."""
    alphabets = [a for _, a, _ in secrets.ENCODINGS]
    for chains in (wordlike.Chains(alphabets), wordlike.Chains(alphabets, {("", "x"): 10**6, ("x", "Y"): 10**7, ("9", "_"): 3})):
        for alphabet in alphabets:
            rows = [chains.chances(before, alphabet) for before in ["", *alphabet]]
            assert all(abs(sum(r) - 1) < 1e-9 and min(r) > 0 for r in rows)
