"""Secrets in texts: three fixed patterns, and tokens that a battery of randomness tests finds random.

A token is a run of at least `MIN_TOKEN` characters of the usual encodings. Its encoding is inferred
from its characters, which become numbers in that alphabet. Three tests ask whether these could be
drawn uniformly and independently: chi-squared uniformity, runs about the middle, and correlation of
neighbours.

Short tokens pass such tests easily, so a token is also tested against the opposite hypothesis, that it
is made of words, names and numbers (`wordlike`, fitted to the corpus' own shorter tokens, which tells
tokens of 20 characters apart). Digits make no words; a token of digits alone is tested against a choice
from half of the alphabet only: the share of equal pairs of symbols then has a mean and a spread that
shrinks with length.

All four make one p-value: that of the opposite hypothesis, divided by the battery's (three times the
least of its three p-values) over `SOFT` where that's below 1; where the battery's is below `ALPHA`, it's 1.
A token that the battery doubts loses evidence, one that it rejects all; and as a p-value only grows by
this, the control holds. Over all tokens of the corpus, for each encoding and doubling of length by itself, the
Benjamini-Hochberg step keeps the share of false discoveries below `RATE`.

Everything is Spark expressions; only counts of p-values in fixed bins and of pairs of characters reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, let, read
from .spans import matches, overlapped
from .wordlike import Chains, pairs_of_short_tokens

# Fixed patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}+"
#: Below `SOFT` the battery's p-value raises a token's, below `ALPHA` it rejects the token.
SOFT, ALPHA, RATE = 0.1, 0.01, 0.01
#: p-values are counted in bins of a quarter of a decade, down to 1e-20.
BINS, PER_DECADE = 80, 4
#: More than the length classes of an encoding.
CLASSES = 32

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
LOWER = UPPER.lower()
#: Encoding: pattern of its tokens, alphabet, whether letters count in lower case. The first that fits.
ENCODINGS = [
    (r"^[0-9]+$", DIGITS, False),
    (r"^(?:[0-9a-f]+|[0-9A-F]+)$", DIGITS + LOWER[:6], True),
    (r"^[A-Za-z]+$", LOWER, True),
    (r"^[A-Z2-7]+=*$", UPPER + DIGITS[2:8], False),
    (r"^(?:[a-z0-9]+|[A-Z0-9]+)$", LOWER + DIGITS, True),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS, False),
    (r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/", False),
    (r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_", False),
    (r"^", UPPER + LOWER + DIGITS + "+/-_", False),
]


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal Z, to about 1e-7 of its size."""

    def positive(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-x * x / 2) / 2.5066282746310002 * poly

    return let(z, lambda v: let(positive(F.abs(v)), lambda p: F.when(v >= 0, p).otherwise(1 - p)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def symbols(token: Column) -> Column:
    """Struct `s` (the symbols), `alphabet`."""
    case = F.when(F.lit(False), None)
    for pattern, alphabet, fold in ENCODINGS:
        own = F.struct((F.lower(token) if fold else F.translate(token, "=", "")).alias("s"), F.lit(alphabet).alias("alphabet"))
        case = case.when(token.rlike(pattern), own)
    return case


def counted(t: Column) -> Column:
    """Numbers of the symbols, size of the alphabet, sum of squared counts."""
    left = lambda c: F.length(t["s"]) - F.length(F.replace(t["s"], c, F.lit("")))
    return F.struct(
        F.transform(F.split(t["s"], ""), lambda c: F.position(c, t["alphabet"]).cast("double")).alias("x"),
        F.length(t["s"]).cast("double").alias("n"),
        F.length(t["alphabet"]).cast("double").alias("k"),
        total(F.transform(F.split(t["alphabet"], ""), lambda c: F.pow(left(c).cast("double"), 2.0))).alias("squares"),
    )


def moments(t: Column) -> Column:
    """What the tests need of the sequence: its runs about the middle and its neighbours' products."""
    size = F.size(t["x"])
    first, later = F.slice(t["x"], 1, size - 1), F.slice(t["x"], 2, size)
    mean, middle = total(t["x"]) / t["n"], t["k"] / 2

    def with_mean(m: Column) -> Column:
        return F.struct(
            t["n"].alias("n"),
            t["k"].alias("k"),
            t["squares"].alias("squares"),
            total(F.transform(t["x"], lambda x: (x > middle).cast("double"))).alias("high"),
            total(F.zip_with(first, later, lambda x, y: ((x > middle) != (y > middle)).cast("double"))).alias("changes"),
            total(F.zip_with(first, later, lambda x, y: (x - m) * (y - m))).alias("products"),
            total(F.transform(t["x"], lambda x: (x - m) * (x - m))).alias("spread"),
        )

    return let(mean, with_mean)


#: A statistic that no random sequence has.
NEVER = 40.0


def statistics(t: Column) -> Column:
    n, k = t["n"], t["k"]
    chi = F.pow((k / n * t["squares"] - n) / (k - 1), 1 / 3.0)
    step = 2 / (9 * (k - 1))
    expected = 2 * t["high"] * (n - t["high"]) / n
    runs_var = expected * (expected - 1) / (n - 1)
    half = 2 / k
    equal = (t["squares"] - n) / (n * (n - 1))
    return F.struct(
        n.alias("n"),
        ((chi - (1 - step)) / F.sqrt(step)).alias("chi"),
        F.when(runs_var > 0, (t["changes"] - expected) / F.sqrt(runs_var)).otherwise(F.lit(NEVER)).alias("runs"),
        F.when(t["spread"] > 0, (t["products"] / t["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(NEVER)).alias("serial"),
        ((equal - half) / F.sqrt(2 * half * (1 - half) / (n * (n - 1)))).alias("half"),
    )


def verdict(t: Column) -> Column:
    """`random` (the battery doesn't reject it), `against`: decades that the three tests take from its
    evidence; `half`: -log10 of its p-value against a choice from half of the alphabet."""
    least = F.least(upper_tail(t["chi"]), 2 * upper_tail(F.abs(t["runs"])), 2 * upper_tail(F.abs(t["serial"])))
    p = F.greatest(upper_tail(-t["half"]), F.lit(1e-300))
    return F.struct(
        (3 * least >= ALPHA).alias("random"),
        F.greatest(F.lit(0.0), F.log10(SOFT / F.greatest(3 * least, F.lit(1e-300)))).alias("against"),
        F.floor(F.log2(t["n"])).cast("int").alias("length_class"),
        (-F.log10(p)).alias("half"),
    )


def judged(token: Column, chains: Chains) -> Column:
    """Struct `length_class` (of the token's encoding), `bin` (of its p-value, up to `BINS`; 0 if the battery
    rejects it)."""

    def both(b: Column) -> Column:
        own = F.struct(
            let(moments(b), lambda c: let(statistics(c), verdict)).alias("t"),
            chains.evidence(b["x"], b["k"]).alias("words"),
            b["k"].cast("int").alias("k"),
        )
        return let(own, placed)

    def placed(o: Column) -> Column:
        place = F.when(o["k"] == len(DIGITS), o["t"]["half"]).otherwise(o["words"]) - o["t"]["against"]
        return F.struct(
            (o["k"] * CLASSES + o["t"]["length_class"]).alias("length_class"),
            F.when(o["t"]["random"], F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor(PER_DECADE * place))).cast("int")).otherwise(0).alias("bin"),
        )

    return let(symbols(token), lambda a: let(counted(a), both))


def scanned(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep`, base spans and tested tokens of each row, written out. Texts are read twice: for the chains,
    then for the tokens."""
    body = exact_text(text)
    chains = Chains([alphabet for _, alphabet, _ in ENCODINGS], pairs_of_short_tokens(docs, text))
    assign = F.filter(matches(body, ASSIGN), lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2)) >= 12)

    def kind(spans: Column, rank: int) -> Column:
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))

    base = F.concat(kind(assign, 0), kind(matches(body, ACCESS), 1), kind(matches(body, HEX), 2))
    tokens = F.transform(
        matches(body, TOKEN),
        lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("rank"), m["end"].alias("end"), judged(m["match"], chains).alias("t")),
    )
    return cut(docs.select(*keep, F.array_sort(base).alias("_base"), tokens.alias("_tokens")))


def discoveries(scans: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length class of an encoding the lowest bin whose tokens are discoveries, by Benjamini and Hochberg's
    step on the bins' edges. At most a row for each class and bin reaches the driver."""
    tests = scans.select(F.explode("_tokens.t").alias("t"))
    rows = tests.groupBy("t.length_class", "t.bin").agg(F.count(F.lit(1)).alias("n")).collect()
    lowest = {}
    for c in {r.length_class for r in rows}:
        own = {r.bin: r.n for r in rows if r.length_class == c}
        tests = sum(own.values())
        good = [j for j in range(BINS + 1) if (found := sum(n for b, n in own.items() if b >= j)) and tests * 10 ** (-j / PER_DECADE) <= rate * found]
        if good:
            lowest[c] = min(good)
    return lowest


def found_in(scans: DataFrame, lowest: dict[int, int]) -> DataFrame:
    """Adds `_spans`: base spans and the discoveries that overlap none of them, by start and kind."""
    if lowest:
        edges = F.create_map(*[F.lit(x) for pair in sorted(lowest.items()) for x in pair])
        good = lambda t: (t["t"]["bin"] > 0) & F.coalesce(t["t"]["bin"] >= F.element_at(edges, t["t"]["length_class"]), F.lit(False))
    else:
        good = lambda t: F.lit(False)
    base = F.col("_base")
    found = F.filter("_tokens", good)
    apart = overlapped(found, base, lambda meets: F.filter(found, lambda t: ~meets(t)))
    own = F.transform(apart, lambda t: F.struct(t["start"], t["rank"], t["end"]))
    return scans.withColumn("_spans", F.array_sort(F.concat(base, own.cast("array<struct<start:bigint,rank:int,end:bigint>>"))))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])))


def secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id`, `base` and `spans` (arrays of `kind`, `start`, `end` in code points, end exclusive) of
    each row. Null and empty texts have none; texts of any length are scanned whole."""
    scans = scanned(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"])
    out = found_in(scans, discoveries(scans))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda c: F.transform(c, lambda s: F.struct(names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc_id", shown("_base").alias("base"), shown("_spans").alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of documents."""
    found = secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda column, kind: F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("bigint")
    text = lambda column: F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.select(
        "doc_id",
        *[count("base", k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(text("base"), 256).alias("base_sha256"),
        text("spans").alias("spans"),
        count("spans", KINDS[3]).alias("n_random"),
    )
