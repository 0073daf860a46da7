"""Personal data in texts: four fixed patterns, and identifiers found by their contexts.

Bootstrapping: what the fixed patterns find are seeds. The words around a seed, with the seed's shape,
make a lexical pattern. Every other token with a digit is a candidate, and so is every run of digit
groups with spaces, brackets, dots or dashes between; each has patterns of its own.
Patterns and instances (distinct strings) form a graph, whose edges Spark folds before anything else.
A pattern scores as the share of its instances that are believed, less for few of them; an instance
is believed as far as its patterns score on average. What a fixed pattern matched and its check
refused (a wrong check digit, say) is never believed: such instances hold their patterns down. After
some rounds the patterns above a threshold, met with enough distinct seeds, name the candidates found
in them as identifiers.

Scores are sums and maxima over the folded edges, so a pattern or an instance with a large part of all
edges is summed where the edges lie. Nothing but the number of rounds is known to the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, free, read, ready_for_python

KINDS = ("email", "ip", "card", "phone")
CONTEXT, REFUSED = "context", "refused"
#: Rounds of scoring, threshold of a pattern, distinct seeds it needs, words of context on either side.
ROUNDS, BELIEVED, LEAST_SEEDS, CONTEXT_WORDS = 3, 0.8, 5, 2
#: Row groups of masked texts.
ROW_GROUP_BYTES = 16 << 20
#: Longer words of a context go by a hash, of this base; it has an inverse modulo 2**64.
LONG_WORD, BASE = 64, 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
_SPACES = np.array([chr(c).isspace() for c in range(0x3002)])

# Fixed patterns. Each is written so that a run that can't match is passed once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Candidates, which need at least five letters or digits: a token with a digit, a run of digit groups.
TOKEN = re.compile(r"(?<![^\s])[^\s]*[0-9][^\s]*")
_GROUP = r"[0-9]++(?![\w@]|[.-]++[^\W0-9])"
RUN = re.compile(rf"(?<![^\s\"'\[{{<:=#])[+(]*+{_GROUP}(?:[\x20\xa0().-]{{1,5}}+{_GROUP})++")
#: From so many digits on, a run of digits with a wrong check digit counts as a card that was refused.
#: One whose check digit holds is open, whatever its length: cards of 15 digits are known by their contexts.
LEAST_REFUSED = 13


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(d - 9 if (d := 2 * int(c)) > 9 else d for c in digits[-2::-2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def checked(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind number, start, end, whether its check holds) of the fixed patterns' matches."""
    if "@" in text:
        yield from ((0, a, b, True) for a, b in emails(text))
    for m in IP.finditer(text):
        yield 1, *m.span(), all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))
    for m in CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0])
        yield 2, *m.span(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield 3, *m.span(), 8 <= sum(c.isdigit() for c in m[0]) <= 15


def refuses(kind: int, match: str) -> bool:
    """Whether a match whose check failed is held against its contexts."""
    if KINDS[kind] != "card":
        return True
    digits = re.sub(r"[ -]", "", match)
    return len(digits) >= LEAST_REFUSED and not luhn(digits)


def digest(name: str) -> int:
    """Names an instance in the graph, whatever its length."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little", signed=True)


def runs(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of at least two digit groups between the `taken` spans, which are sorted."""
    at = 0
    for a, b in [*taken, (len(text), len(text))]:
        for m in RUN.finditer(text, at, max(at, a)):
            start, end = m.span()
            if m[0].startswith("(") and ")" not in m[0]:
                start += 1
            elif m[0].count("(") > m[0].count(")") and text[end : end + 1] == ")":
                end += 1
            yield start, end
        at = max(at, b)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    return [(k, a, b) for k, a, b, good in checked(text) if good]


def shape(token: str) -> str:
    """What an identifier looks like at a glance."""
    if "@" in token:
        return "<address>"
    if any(c.isalpha() for c in token):
        return "<mixed>"
    return "<number>" if sum(c.isdigit() for c in token) >= 7 else "<short>"


class Surroundings:
    """The words around places of a text, however long they are and however far apart.

    Word boundaries are found once. A word of more than `LONG_WORD` characters goes by a hash of all of
    it: sums of its characters times powers of `BASE`, from running sums over the text, so that parts of
    one very long word around very many places still take one pass.
    """

    def __init__(self, text: str):
        self.text = text
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.ones(len(self.codes) + 2, bool)
        inside[[0, -1]] = False
        inside[1:-1] = ~_SPACES[np.minimum(self.codes, len(_SPACES) - 1)]
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        self.sums: np.ndarray | None = None

    def name(self, start: int, end: int) -> str:
        if end - start <= LONG_WORD:
            return self.text[start:end].lower()
        if self.sums is None:
            n = len(self.codes)
            lower = self.codes + np.where((self.codes > 64) & (self.codes < 91), 32, 0).astype(np.uint32)
            powers = np.full(n, BASE, np.uint64)
            powers[:1] = 1
            np.cumprod(powers, out=powers)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(lower.astype(np.uint64) * powers, out=self.sums[1:])
        # Divided by the power at its start, a word's sum is the same wherever it stands.
        total = (int(self.sums[end]) - int(self.sums[start])) * pow(INVERSE, start, 2**64) % 2**64
        return f"#{end - start}:{total:x}"

    def before(self, place: int, n: int) -> list[str]:
        """The last `n` words before a place, one that it stands in up to there."""
        last = int(np.searchsorted(self.starts, place))
        first = max(0, last - n)
        return [self.name(a, min(b, place)) for a, b in zip(self.starts[first:last].tolist(), self.ends[first:last].tolist(), strict=True)]

    def after(self, place: int) -> str:
        """The word after a place, the rest of one that it stands in; none at the end."""
        k = int(np.searchsorted(self.ends, place, "right"))
        return self.name(max(int(self.starts[k]), place), int(self.ends[k])) if k < len(self.ends) else ""


def patterns(around: Surroundings, start: int, end: int) -> list[str]:
    """Contexts of a place with the shape of what stands there: the words before it, and those on
    either side, in lower case."""
    before = around.before(start, CONTEXT_WORDS)
    if not before:
        return []
    own = shape(around.text[start:end])
    return [f"{' '.join(before)} {own}", f"{before[-1]} {own} {around.after(end)}"]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans put together where they overlap, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def entities(text: str) -> list[dict]:
    """Entities of a text (`found_entities`), with the words around them taken only where there are any."""
    around: list[Surroundings] = []

    def contexts(start: int, end: int) -> list[str]:
        if not around:
            around.append(Surroundings(text))
        return patterns(around[0], start, end)

    return found_entities(text, contexts)


def found_entities(text: str, contexts: Callable[[int, int], list[str]]) -> list[dict]:
    """Base spans and candidates of a text with their contexts; candidates overlap no base span. A token
    that overlaps a run of digit groups has that run's start as its `place`, all others their own."""
    matched = list(checked(text))
    base = [(k, a, b) for k, a, b, good in matched if good]
    out = [
        {"kind": KINDS[k], "start": a, "end": b, "place": a, "run": False, "name": digest(text[a:b]), "patterns": contexts(a, b)}
        for k, a, b in base
    ]
    taken = merged([(a, b) for _, a, b in base])
    refused = merged([(a, b) for k, a, b, good in matched if not good and refuses(k, text[a:b])])
    groups = list(runs(text, taken))

    def last(spans: list[tuple[int, int]], a: int, b: int) -> tuple[int, int] | None:
        """Of spans apart from each other the last that starts before `b`, if it ends after `a`."""
        return spans[i - 1] if (i := bisect(spans, (b, -1))) > 0 and spans[i - 1][1] > a else None

    def candidate(a: int, b: int, place: int, run: bool) -> None:
        if sum(c.isalnum() for c in text[a:b]) >= 5:
            kind = REFUSED if last(refused, a, b) else CONTEXT
            out.append({"kind": kind, "start": a, "end": b, "place": place, "run": run, "name": digest(text[a:b]), "patterns": contexts(a, b)})

    for m in TOKEN.finditer(text):
        raw = m[0].strip(".,;:!?()[]{}\"'<>")
        a = m.start() + m[0].find(raw)
        b = a + len(raw)
        if not last(taken, a, b):
            run = last(groups, a, b)
            if run != (a, b):
                candidate(a, b, run[0] if run else a, False)
    for a, b in groups:
        candidate(a, b, a, True)
    return out


ENTITY = "struct<kind:string,start:bigint,end:bigint,place:bigint,run:boolean,name:bigint,patterns:array<string>>"
ENTITY_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("place", pa.int64()), ("run", pa.bool_()), ("name", pa.int64()), ("patterns", pa.list_(pa.string()))]
    )
)


def found(spark: SparkSession, text: Column) -> Column:
    ready_for_python(spark)

    @F.arrow_udf(f"array<{ENTITY}>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([entities(t) for t in texts.to_pylist()], ENTITY_ARROW)

    return run(exact_text(text))


def edges(rows: DataFrame, entity: str) -> DataFrame:
    """`pattern`, `name`, `known` (1 a seed, 0 refused, null open): the distinct edges of the graph."""
    one = rows.select(F.explode(entity).alias("e"))
    known = F.when(F.col("e.kind") == REFUSED, 0.0).when(F.col("e.kind") != CONTEXT, 1.0)
    out = one.select(F.explode("e.patterns").alias("pattern"), F.col("e.name").alias("name"), known.alias("known"))
    return out.groupBy("pattern", "name").agg(F.max("known").alias("known"))


def scored_patterns(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`pattern`, `score` in [0, 1], `seeds`: after `rounds` rounds between patterns and instances."""
    belief = graph.withColumn("belief", F.coalesce("known", F.lit(0.0)))
    for k in range(rounds):
        total = F.sum("belief")
        score = total / F.count(F.lit(1)) * (1 - F.pow(F.lit(2.0), -total))
        scores = cut(belief.groupBy("pattern").agg(score.alias("score"), F.count_if(F.col("known") == 1).alias("seeds")))
        if k + 1 < rounds:
            scored = graph.join(scores.select("pattern", "score"), "pattern")
            mean = scored.groupBy("name").agg(F.coalesce(F.max("known"), F.avg("score")).alias("belief"))
            belief = cut(graph.join(mean, "name"))
    return scores


def with_spans(rows: DataFrame, entity: str, row: str) -> DataFrame:
    """`row`, `spans`: identifiers that believed patterns name, for the rows that have some. Of a run of
    digit groups and the tokens that overlap it the run counts, if it's named."""
    graph = cut(edges(rows, entity))
    good = scored_patterns(graph).filter((F.col("score") >= BELIEVED) & (F.col("seeds") >= LEAST_SEEDS)).select("pattern")
    one = rows.select(F.col(row).alias("row"), F.explode(entity).alias("e")).filter(F.col("e.kind") == CONTEXT)
    met = one.select("row", "e.start", "e.end", "e.place", "e.run", F.explode("e.patterns").alias("pattern")).join(good, "pattern", "left_semi")
    span = F.struct("start", "end")
    places = met.groupBy("row", "place").agg(F.collect_set(span).alias("any"), F.collect_set(F.when(F.col("run"), span)).alias("runs"))
    kept = places.select("row", F.when(F.size("runs") > 0, F.col("runs")).otherwise(F.col("any")).alias("spans"))
    return kept.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


def all_spans(entity: str, named: str) -> Column:
    """Base spans and discoveries (`rank`, `start`, `end`) by kind, then start."""
    seeds = F.filter(entity, lambda e: e["kind"].isin(*KINDS))
    ranks = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform(seeds, lambda e: F.struct((F.array_position(ranks, e["kind"]) - 1).cast("int").alias("rank"), e["start"].alias("start"), e["end"].alias("end")))
    found = F.coalesce(F.col(named), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return F.concat(base, F.transform(found, lambda s: F.struct(F.lit(len(KINDS)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"))))


def detected(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, str]:
    """`keep` and a column with every span (`rank`, `start`, `end`) of each row, by kind, then start.

    Texts are read once; what is found is written with a number for each row, which the discoveries
    are joined back by.
    """
    spark = docs.sparkSession
    entity, row, spans = free(docs, "entity", "row", "spans")
    rows = cut(docs.select(*[F.col(f"`{c}`") for c in keep], found(spark, F.col(text)).alias(entity), F.monotonically_increasing_id().alias(row)))
    named = cut(with_spans(rows, entity, row).select(F.col("row").alias(row), F.col("spans").alias(spans)))
    return rows.join(named, row, "left").withColumn(spans, all_spans(entity, spans)).drop(entity, row), spans


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id`, `spans` (array of `kind`, `start`, `end`, code points, end exclusive, by kind then start).
    Null and empty texts have none; texts of any length are scanned whole."""
    out, spans = detected(docs, text, [doc_id])
    names = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])
    shown = F.transform(spans, lambda s: F.struct(names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select(F.col(doc_id).alias("doc_id"), shown.alias("spans"))


def mask(text: str, spans: list[dict]) -> str:
    """`text` with spans (`rank`, `start`, `end`) replaced by their kinds."""
    pieces, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"], s["rank"])):
        if s["start"] >= at:
            pieces += [text[at : s["start"]], f"[{(*KINDS, CONTEXT)[s['rank']].upper()}]"]
        # What an overlapping span has beyond the one before it goes too.
        at = max(at, s["end"])
    return "".join([*pieces, text[at:]])


def masked(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """`docs` with every span in `text` replaced by its kind in brackets; of overlapping spans the one
    that starts first (then the longest) is replaced whole and the rest of the others left out.
    `length` names a column that holds the text's code points; it follows. A null text stays null."""
    spark = docs.sparkSession
    key, clean = free(docs, "text_key", "masked")
    keyed = docs.withColumn(key, F.sha2(exact_text(text), 256))
    texts = keyed.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # What's found is written without the texts, and texts with spans are met again by their digest.
    rows = cut(texts.select("key", found(spark, F.col("text")).alias("entity")).filter(F.size("entity") > 0))
    named = with_spans(rows, "entity", "key").select(F.col("row").alias("key"), F.col("spans").alias("named"))
    marks = rows.dropDuplicates(["key"]).join(named, "key", "left").select("key", all_spans("entity", "named").alias("spans"))
    marks = cut(marks.filter(F.size("spans") > 0))

    @F.arrow_udf("string")
    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([mask(t, s) for t, s in zip(texts.to_pylist(), found.to_pylist(), strict=True)], pa.string())

    once = texts.join(marks, "key").dropDuplicates(["key"])
    done = cut(once.select(F.col("key").alias(key), run("text", "spans").alias(clean)), ROW_GROUP_BYTES)
    # The narrow side is hashed, so that texts needn't be sorted.
    out = keyed.join(done.hint("shuffle_hash"), key, "left")
    if length:
        kind = dict(docs.dtypes)[length]
        out = out.withColumn(length, F.coalesce(F.length(clean).cast(kind), F.col(length)))
    out = out.withColumn(text, F.coalesce(clean, text))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text of documents."""
    rows = personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != CONTEXT)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        count(CONTEXT).alias("n_context"),
    )
