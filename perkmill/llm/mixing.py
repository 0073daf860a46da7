"""Mixing sources to target weights: temperature, then budgeted block permutations.

A source with the share p of all tokens gets a weight in proportion to p**alpha: alpha 1 keeps the
shares, alpha 0 makes them equal. The weights' entropy falls as alpha rises, and so does the largest
number of times that a source is repeated; alpha is found by bisection, several halvings in one
aggregation over the sources, as the one that meets a target entropy without passing a repetition
limit.

A source's budget is its weight of the total. It is realised as whole permutations of its documents
and a part of one more: a document's place in a permutation is a hash of its id, the source and the
permutation's number. Places are cut into as many cells as the square root of the documents, and the
budget is filled cell by cell: only the cell in which it runs out is ordered, so a source with a large
part of all documents is never ordered in one task. The k-th block of the mix takes the k-th part of each
source's permutations, so every stretch of the mix holds the sources by weight.

Everything is Spark expressions; one row of sums for each bisection step reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, free, read, row_key

#: Entropy to reach, as a share of that of equal weights; most passes over a source.
TARGET_ENTROPY, MOST_PASSES = 0.985, 4.0
#: Halvings of one aggregation, aggregations.
HALVINGS, STEPS = 5, 5
#: Rows of a block, about.
BLOCK = 1024
SEED = 11


def n_tokens(text: Column) -> Column:
    """Words of a text, null as empty."""
    return F.size(F.regexp_extract_all(exact_text(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("bigint")


def weights_at(shares: DataFrame, alphas: list[float], cover: bool) -> list[tuple[float, float]]:
    """For each exponent the entropy of the weights, and the most that a source's tokens are repeated
    in a mix of as many tokens as there are (with `cover`: of the least that holds each source whole).

    With Z the sum of p**alpha, the entropy is log Z - alpha / Z * sum(p**alpha log p)."""
    sums = []
    for k, a in enumerate(alphas):
        power = F.pow("p", F.lit(a))
        ratio = power / F.col("p")
        sums += [F.sum(power).alias(f"z{k}"), F.sum(power * F.log("p")).alias(f"l{k}"), F.max(ratio).alias(f"m{k}"), F.min(ratio).alias(f"n{k}")]
    r = shares.agg(*sums).first()
    return [(math.log(r[f"z{k}"]) - a * r[f"l{k}"] / r[f"z{k}"], r[f"m{k}"] / (r[f"n{k}"] if cover else r[f"z{k}"])) for k, a in enumerate(alphas)]


def exponent(shares: DataFrame, entropy: float, most_passes: float, cover: bool, times: float = 1.0) -> float:
    """The largest exponent in [0, 1] whose weights reach the entropy, raised until no source is passed
    over more than `most_passes` times (`times`: the mix's tokens by all tokens).

    Entropy falls with the exponent, and so do repetitions. Halvings go in groups: all points that
    `HALVINGS` halvings could meet are tried in one aggregation.
    """

    def last(holds) -> float:
        """The largest exponent, to within the last interval, up to which a condition holds."""
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            points = [low + (high - low) * i / 2**HALVINGS for i in range(1, 2**HALVINGS + 1)]
            k = sum(holds(*v) for v in weights_at(shares, points, cover))
            low, high = (points[k - 1] if k else low), points[min(k, len(points) - 1)]
        return low

    by_entropy = last(lambda h, _: h >= entropy - 1e-9)
    too_often = last(lambda _, m: m * times > most_passes)
    nothing_too_often = too_often == 0.0
    return max(by_entropy, 0.0 if nothing_too_often else min(1.0, too_often + 2.0 ** -(HALVINGS * STEPS)))


def budgets(sources: DataFrame, target: float = TARGET_ENTROPY, most_passes: float = MOST_PASSES, total: int | None = None, cover: bool = False) -> DataFrame:
    """`source`, `docs`, `tokens`, `weight`, `budget` (tokens) of each source with tokens.

    `total` is the mix's tokens, by default as many as there are; with `cover` the least that takes
    every source whole at least once. Sources without tokens have no budget.
    """
    known = cut(sources.filter(F.col("tokens") > 0))
    sums = known.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not sums.n:
        return known.select("source", "docs", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("budget"))
    shares = known.withColumn("p", F.col("tokens") / float(sums.t))
    alpha = exponent(shares, target * math.log(sums.n), most_passes, cover, (total or sums.t) / sums.t if not cover else 1.0) if sums.n > 1 else 1.0
    power = F.pow("p", F.lit(alpha))
    z = shares.agg(F.sum(power).alias("z"), F.max(F.col("p") / power).alias("m")).first()
    size = sums.t * z.z * z.m if cover else float(total or sums.t)
    return shares.select("source", "docs", "tokens", (power / z.z).alias("weight"), F.round(power / z.z * size).cast("bigint").alias("budget"))


def mix(docs: DataFrame, tokens: str, source: str, doc_id: str, target: float = TARGET_ENTROPY, most_passes: float = MOST_PASSES, cover: bool = False, total: int | None = None) -> DataFrame:
    """`row`, `id`, `source`, `tokens`, `pass` (from 0), `block` (from 0): which rows the mix holds, and where.

    `docs` has `tokens`, `source` (null is a source of its own), `doc_id` and `row`, which tells each row
    from the others. A row without tokens goes with its source's permutations like any other; a source
    without any tokens isn't in the mix. A budget that ends inside a document leaves it out.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = docs.select("row", F.col(doc_id).alias("id"), name.alias("source"), F.col(tokens).alias("tokens"))
    sources = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = budgets(sources, target, most_passes, total, cover)
    plan = plan.select(
        "source",
        F.ceil(F.sqrt("docs")).alias("cells"),
        F.expr("budget div tokens").alias("passes"),
        F.expr("budget % tokens").alias("rest"),
        (F.col("budget") / F.col("tokens")).alias("length"),
        (F.col("docs") * F.col("budget") / F.col("tokens")).alias("size"),
    )
    plan = cut(plan)
    blocks = max(1, math.ceil((plan.agg(F.sum("size")).first()[0] or 0) / BLOCK))
    placed = rows.join(plan, "source").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes"))))
    # In [0, 1): the place in this pass of the source; rows with the same id differ by what tells them apart.
    place = F.xxhash64(F.lit(SEED), "source", "pass", "id", "row").bitwiseAND(F.lit(2**52 - 1)) / float(2**52)
    placed = placed.withColumn("place", place).withColumn("cell", F.floor(F.col("place") * F.col("cells")))
    whole = placed.filter(F.col("pass") < F.col("passes")).select("row", "id", "source", "tokens", "pass", "place", "length")
    last = placed.filter((F.col("pass") == F.col("passes")) & (F.col("rest") > 0))
    cells = last.groupBy("source", "cell").agg(F.sum("tokens").alias("in_cell"))
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("before", F.coalesce(F.sum("in_cell").over(before), F.lit(0))).drop("in_cell")
    within = Window.partitionBy("source", "cell").orderBy("place", "row").rowsBetween(Window.unboundedPreceding, 0)
    started = last.join(starts, ["source", "cell"]).filter(F.col("before") < F.col("rest"))
    part = started.withColumn("upto", F.col("before") + F.sum("tokens").over(within)).filter(F.col("upto") <= F.col("rest"))
    # A source's whole passes, then its part of one, stretch over all blocks in this order.
    chosen = whole.unionByName(part.select(whole.columns))
    block = F.floor((F.col("pass") + F.col("place")) / F.col("length") * blocks)
    named = F.when(F.col("source") != "", F.substr("source", F.lit(2))).alias("source")
    return chosen.select("row", "id", named, "tokens", F.col("pass").cast("int").alias("pass"), F.least(block, F.lit(blocks - 1)).cast("bigint").alias("block"))


#: Copies of a row that are made from its count at a time.
COPIES = 1 << 16


def told_apart(docs: DataFrame, source: str, doc_id: str, text: str) -> DataFrame:
    """`docs`' ids, sources and token counts with a `row` for each: the row's content and its number among
    the rows that are alike in everything. It's the same however the table is split or ordered.

    Such rows are counted and written out as often as they occur, so none need to be ordered.
    """
    one = docs.select(row_key(docs, text).alias("key"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_tokens(F.col(text)).alias("tokens"))
    alike = one.groupBy("key", "doc_id", "source", "tokens").agg(F.count(F.lit(1)).alias("n"))
    parts = alike.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))))
    copies = F.explode(F.sequence(F.col("first"), F.least(F.col("first") + COPIES, F.col("n")) - 1))
    each = parts.withColumn("copy", copies)
    return cut(each.select("doc_id", "source", "tokens", F.struct("key", "copy").alias("row")))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", target: float = TARGET_ENTROPY, most_passes: float = MOST_PASSES, cover: bool = True) -> DataFrame:
    """The rows of `docs` that the mix holds, as often as it holds them, with their columns. `docs` is
    read twice. Rows that are alike in everything are repeated together."""
    key, times = free(docs, "row_key", "times")
    keyed = docs.withColumn(key, row_key(docs, text))
    rows = told_apart(docs, source, doc_id, text)
    chosen = mix(rows, "tokens", "source", "doc_id", target, most_passes, cover).select(F.col("row.key").alias("key"))
    often = cut(chosen.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("times")))
    one = keyed if rows.filter(F.col("row.copy") > 0).isEmpty() else keyed.dropDuplicates([key])
    # The narrow side is hashed, so that texts needn't be sorted.
    out = one.join(often.select(F.col("key").alias(key), F.col("times").alias(times)).hint("shuffle_hash"), key)
    return out.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: a row for each time a document is in it.

    `doc_id`, `source`, `n_tokens`, `pass` (which of its source's permutations), `block` and `slot`
    (from 1, the place in its block).
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = told_apart(docs, "source", "doc_id", "text")
    chosen = mix(rows, "tokens", "source", "doc_id")
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(SEED), "row", "pass"), "row", "pass")
    return chosen.select(F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "pass", "block", F.row_number().over(order).alias("slot"))
