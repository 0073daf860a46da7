"""Quality rules: word statistics and a decision list learned from labelled ones.

Sequential covering: a rule is grown from labelled documents as a conjunction of thresholds, always by
the condition with the largest information gain, then pruned on labelled documents that growing didn't
see; what it covers is set aside, and the next rule is grown on the rest. The list becomes one ordered
Spark conditional expression, with a reason for each rejected document.

Learning needs only counts: how many labelled documents of either class fall between each pair of
neighbouring thresholds. Spark counts them over all labels; their number is bounded by the thresholds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, let, read

WORD = r"[^\x20\x09-\x0D]+"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbol_share", "repeat_share", "dup_line_share", "word_length"]
#: Thresholds lie between quantiles of the two classes: at most 11 a feature, so at most 12**4 cells.
QUANTILES = [0.02, 0.1, 0.25, 0.5, 0.9, 0.98]
#: Conditions of a rule, rules of a list, labelled documents a rule must cover, share of rejected ones among them.
MOST_CONDITIONS, MOST_RULES, LEAST_SUPPORT, LEAST_PRECISION = 3, 12, 8, 0.9


def repeated_words(windows: Column) -> Column:
    """Words in windows of three that occur twice or more; `windows` are strings in text order."""

    def covered(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda s, i: F.struct(s.alias("s"), i.alias("i"))))

        def starts(v: Column) -> Column:
            same = lambda x, other: F.coalesce(x["s"] == other["s"], F.lit(False))
            mark = lambda x, j: F.when(same(x, F.get(v, j - 1)) | same(x, F.get(v, j + 1)), x["i"])
            return F.sort_array(F.array_compact(F.transform(v, mark)))

        def add(acc: Column, i: Column) -> Column:
            new = (i + 3 - F.greatest(acc["end"], i)).cast("bigint")
            return F.struct((i + 3).cast("int").alias("end"), (acc["n"] + new).alias("n"))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(let(placed, starts), zero, add, lambda acc: acc["n"])

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w)))


def statistics(text: Column) -> Column:
    """Struct of the `BASE` counts and `n_lines` (lines with a word) of a whole text, null as empty."""
    body = exact_text(text)

    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words) - 2, F.lit(0))
        pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
        windows = F.zip_with(pairs, F.slice(words, 3, n), lambda ab, c: F.concat(ab, F.lit(" "), c))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_words(windows).alias("n_repeat_words"),
        )

    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    words = let(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), of_words)
    symbols = F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("bigint")
    return F.struct(words.alias("w"), of_lines.alias("l"), symbols.alias("s"))


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep`, the counts and the features of each row, written out: texts are read once."""
    rows = docs.select(*keep, statistics(F.col(text)).alias("_s"))
    counts = rows.select(
        *keep,
        F.col("_s.w.n_words"),
        F.col("_s.w.word_chars"),
        F.col("_s.s").alias("n_symbols"),
        F.col("_s.l.n_dup_lines"),
        F.col("_s.w.n_repeat_words"),
        F.col("_s.l.n_lines"),
    )
    return cut(counts)


def features() -> dict[str, Column]:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "word_length": share("word_chars", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Cell:
    """Labelled documents with the same place among the thresholds: bin number by feature."""

    bins: tuple[int, ...]
    grow: bool
    bad: bool
    n: int


class Learner:
    """Sequential covering over cells. Bin b of a feature holds the values over b of its thresholds."""

    def __init__(self, cells: list[Cell], thresholds: dict[str, list[float]]):
        self.cells, self.thresholds = cells, thresholds
        self.place = {f: i for i, f in enumerate(thresholds)}

    def holds(self, rule: Rule, cell: Cell) -> bool:
        return all((cell.bins[self.place[c.feature]] > self.thresholds[c.feature].index(c.threshold)) == c.above for c in rule)

    def counts(self, rule: Rule, cells: list[Cell]) -> tuple[int, int]:
        own = [c for c in cells if self.holds(rule, c)]
        return sum(c.n for c in own if c.bad), sum(c.n for c in own if not c.bad)

    def grown(self, cells: list[Cell]) -> Rule:
        rule: Rule = ()
        inside = cells
        options = [Condition(f, above, t) for f, ts in self.thresholds.items() for t in ts for above in (True, False)]
        while len(rule) < MOST_CONDITIONS:
            bad, good = self.counts((), inside)
            if not bad or not good:
                break
            before = math.log2(bad / (bad + good))
            best, most = None, 1e-9
            for option in options:
                p, n = self.counts((option,), inside)
                gain = p * (math.log2(p / (p + n)) - before) if p else 0
                if gain > most:
                    best, most = option, gain
            if not best:
                break
            rule += (best,)
            inside = [c for c in inside if self.holds((best,), c)]
        return rule

    def pruned(self, rule: Rule, cells: list[Cell]) -> Rule:
        """The first conditions that have the best (bad - good) / (bad + good) where growing didn't look."""

        def worth(r: Rule) -> tuple[float, int]:
            p, n = self.counts(r, cells)
            return ((p - n) / (p + n) if p + n else -1.0, -len(r))

        return max((rule[:i] for i in range(1, len(rule) + 1)), key=worth, default=())

    def learn(self) -> list[Rule]:
        rules: list[Rule] = []
        rest = self.cells
        while len(rules) < MOST_RULES:
            rule = self.pruned(self.grown([c for c in rest if c.grow]), [c for c in rest if not c.grow])
            bad, good = self.counts(rule, rest)
            if not rule or bad + good < LEAST_SUPPORT or bad < LEAST_PRECISION * (bad + good):
                break
            rules.append(rule)
            rest = [c for c in rest if not self.holds(rule, c)]
        return rules


def learned(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> list[Rule]:
    """Rules that reject, from all labels (doc_id, quality: 0 is bad) whose document has words. Null
    labels aren't learned from; without both classes there's no rule."""
    marks = labels.select(F.col("doc_id").alias(doc_id), (F.col("quality") == 0).alias("_bad")).filter(F.col("_bad").isNotNull())
    known = cut(stats.filter(F.col("n_words") > 0).join(marks, doc_id).select(doc_id, "_bad", *[c.alias(f) for f, c in features().items()]))
    rows = known.groupBy("_bad").agg(*[F.percentile_approx(f, QUANTILES, 10000).alias(f) for f in FEATURES]).collect()
    if len(rows) < 2:
        return []
    marks_of = {f: sorted({float(x) for r in rows for x in r[f]}) for f in FEATURES}
    # Midway, so that a rule keeps a distance to the documents on either side.
    thresholds = {f: [(a + b) / 2 for a, b in pairwise(marks)] for f, marks in marks_of.items()}
    if not any(thresholds.values()):
        return []
    place = lambda f: reduce(lambda a, b: a + b, [(F.col(f) > t).cast("int") for t in thresholds[f]], F.lit(0))
    # A third of the documents is kept for pruning.
    binned = known.select("_bad", (F.pmod(F.xxhash64(doc_id), F.lit(3)) != 0).alias("grow"), *[place(f).alias(f) for f in FEATURES])
    cells = binned.groupBy("_bad", "grow", *FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((Cell(tuple(r[f] for f in FEATURES), r.grow, r._bad, r.n) for r in cells), key=lambda c: (c.bins, c.grow, c.bad))
    return Learner(rows, thresholds).learn()


def reason(rules: list[Rule]) -> Column:
    """The first rule that a document meets, as text; null if it meets none."""
    case = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        case = case.when(reduce(and_, [c.column() for c in rule]), F.lit(" and ".join(map(str, rule))))
    return case


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics and verdict of every whole text of documents, rules learned from all labels."""
    stats = with_statistics(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["doc_id"])
    rules = learned(stats, read(spark, sf_dir, "labels"))
    out = stats.withColumn("base_failed", base_failed()).withColumn("reason", reason(rules))
    return out.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.col("reason").isNull()).alias("kept"), "reason")
