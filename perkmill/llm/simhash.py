"""SimHash near-duplicates: fingerprints, an inverted index on their byte positions, components.

Two 64-bit fingerprints that differ in at most `MOST_BITS` = 3 bits differ in at most 3 of their 8
bytes, so the tally of positional bytes that they share is at least 5, the guaranteed minimum. Posting
single bytes and adding up a pair's tally would meet nearly every pair of a large corpus, since a
posting of one byte holds a 256th of it. The index posts sets of `POSTED` = 4 positions instead, a cover:
any 5 shared positions hold one whole set. A pair meets in a posting only if its tally is at least 4, and
every pair with the minimum does; that is the count filter, and it's decided before any two fingerprints
are put side by side. Of pairs that met, those whose tally is under 5 are passed over, and the rest
verified bit by bit.

A posting with more than `LARGE` fingerprints isn't paired. What it doesn't fix are 4 bytes, and linked
two share one of these too: its members are posted again under each of them, 5 bytes a posting. One
that is still too large leaves 24 bits open, of which linked two agree but for 3: its members are grouped
under every choice of 3 bits left out. The at most 8 members of such a group are all within 3 bits of
each other, so linking them to the smallest gives the same components, in a number of rows proportional
to the posting.

Components come from rounds of smallest neighbour and pointer jumping, each written out.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, free, read, ready_for_python, row_key

SHINGLE_WORDS, SEED, MOST_BITS = 3, 42, 3
BYTES = 8
SHARED = BYTES - MOST_BITS
POSTED = 4
LARGE = 8192
#: Shingles hashed at a time, so that a very long text needs little memory.
CHUNK = 1 << 15


def fingerprint_of(text: str, words: int = SHINGLE_WORDS) -> int:
    """Unsigned. Words are split at ASCII white space, A-Z in lower case; no word: 0."""
    parts = text.encode("utf-8").lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    digest = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = [digest(line[a:b]) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK], strict=False)]
        raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint(spark: SparkSession, text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a whole text as a signed long; null and texts without words: 0."""
    ready_for_python(spark)

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        prints = np.array([fingerprint_of(t, words) for t in texts.to_pylist()], np.uint64)
        return pa.array(prints.view(np.int64))

    return run(exact_text(text))


def cover(posted: int = POSTED, shared: int = SHARED) -> list[tuple[int, ...]]:
    """Sets of `posted` byte positions such that every `shared` positions hold one of them, chosen
    greedily."""
    sets = list(combinations(range(BYTES), posted))
    open_ = {c for c in combinations(range(BYTES), shared)}
    chosen = []
    while open_:
        best = max(sets, key=lambda s: sum(set(s) <= set(c) for c in open_))
        chosen.append(best)
        open_ = {c for c in open_ if not set(best) <= set(c)}
    return chosen


def mask_of(positions: tuple[int, ...]) -> int:
    """The bits of these bytes, as a signed long."""
    bits = sum(0xFF << (8 * p) for p in positions)
    return bits - (1 << 64) if bits >> 63 else bits


def shared_bytes(x: Column, y: Column) -> Column:
    """The tally of positional bytes that two fingerprints have in common."""
    z = x.bitwiseXOR(y)
    return functools.reduce(lambda a, b: a + b, [(z.bitwiseAND(F.lit(mask_of((i,)))) == 0).cast("int") for i in range(BYTES)])


def masks_of(sets: list[tuple[int, ...]]) -> Column:
    return F.array(*[F.lit(mask_of(s)) for s in sets])


def postings(prints: DataFrame) -> DataFrame:
    """`fp` under each set of the cover: `part` numbers the set, `post` holds its bytes."""
    keyed = prints.select("fp", F.posexplode(masks_of(cover())).alias("part", "mask"))
    return keyed.select("fp", F.col("part").cast("int").alias("part"), F.col("fp").bitwiseAND(F.col("mask")).alias("post"))


def postings_of_large(members: DataFrame) -> DataFrame:
    """Members of large postings under each further byte: `part` numbers their set and that byte."""
    sets = cover()
    further = F.array(*[masks_of([(*s, p) for p in range(BYTES) if p not in s]) for s in sets])
    keyed = members.select("fp", "part", F.posexplode(F.get(further, F.col("part"))).alias("k", "mask"))
    return keyed.select("fp", (F.col("part") * BYTES + F.col("k")).cast("int").alias("part"), F.col("fp").bitwiseAND(F.col("mask")).alias("post"))


def split_by_size(index: DataFrame, large: int) -> tuple[DataFrame, DataFrame | None]:
    """Postings of at most `large` members, and the rest, if any."""
    big = cut(index.groupBy("part", "post").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > large).select("part", "post"))
    if big.isEmpty():
        return index, None
    return index.join(big, ["part", "post"], "left_anti"), index.join(big, ["part", "post"], "left_semi")


def pairs_of(index: DataFrame) -> DataFrame:
    """`a`, `b`, a > b: the pairs in a posting that are linked."""
    left, right = index.alias("x"), index.alias("y")
    x, y = F.col("x.fp"), F.col("y.fp")
    close = (x > y) & (shared_bytes(x, y) >= SHARED) & (F.bit_count(x.bitwiseXOR(y)) <= MOST_BITS)
    pairs = left.join(right, (F.col("x.part") == F.col("y.part")) & (F.col("x.post") == F.col("y.post")) & close)
    return pairs.select(x.alias("a"), y.alias("b"))


def links(spark: SparkSession, prints: DataFrame, large: int = LARGE) -> DataFrame:
    """`a`, `b`, a > b: pairs of the distinct `fp` whose components equal those of all pairs within
    `MOST_BITS` bits."""
    small, big = split_by_size(cut(postings(prints)), large)
    found = pairs_of(small)
    if big is not None:
        again, too_big = split_by_size(cut(postings_of_large(big)), large)
        found = found.unionByName(pairs_of(again))
        if too_big is not None:
            found = found.unionByName(links_of_large(too_big))
    return found.distinct()


def links_of_large(members: DataFrame) -> DataFrame:
    """Each member of a posting of 5 bytes linked to the smallest that agrees with it but for 3 bits."""
    spark = members.sparkSession
    rows = []
    for number, positions in enumerate(cover()):
        others = [p for p in range(BYTES) if p not in positions]
        for k, fixed in enumerate(others):
            rest = [8 * p + i for p in others if p != fixed for i in range(8)]
            for three in combinations(rest, MOST_BITS):
                bits = ~sum(1 << b for b in three) & ((1 << 64) - 1)
                rows.append((number * BYTES + k, bits - (1 << 64) if bits >> 63 else bits))
    # A table of fixed size: one row for each posting set and choice of bits.
    masks = spark.createDataFrame(rows, "part int, left_out bigint")
    cells = members.join(F.broadcast(masks), "part").select("fp", "left_out", F.col("fp").bitwiseAND(F.col("left_out")).alias("cell"))
    groups = cells.distinct().groupBy("left_out", "cell").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("all"))
    return groups.select(F.explode("all").alias("a"), "b").filter(F.col("a") > F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """`fp`, `root` (the smallest fp reachable) of every fp that `edges` (a, b) names."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut(both.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.col("fp")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("fp").alias("b"), "root"), "b").groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("near"))
        lower = labels.join(near, "fp").select("fp", F.least("root", "near").alias("next"), F.col("root").alias("before"))
        # A root is some fp itself: jump to where that one points.
        up = labels.select(F.col("fp").alias("next"), F.col("root").alias("above"))
        now = cut(lower.join(up, "next").select("fp", F.least("next", "above").alias("root"), "before"))
        labels = now.select("fp", "root")
        if now.filter(F.col("root") != F.col("before")).isEmpty():
            return labels


def groups_of_prints(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """`fp`, `root` for the fingerprints that are linked to another one."""
    return components(links(spark, prints))


def with_components(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Adds `low`, the smallest `key` among the rows whose fingerprints are reachable from a row's `fp`.

    Equal fingerprints are folded first, so that groups of copies cost one row in everything after;
    the join back is on the fingerprint, where adaptive execution splits a hot one.
    """
    prints = cut(rows.groupBy("fp").agg(F.min("key").alias("least")))
    roots = groups_of_prints(spark, prints.select("fp"))
    rooted = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("least").alias("low"))
    named = cut(rooted.join(lows, "root").select("fp", "low"))
    return rows.join(named, "fp")


def near_duplicates(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id`, `fp`, `low`: a row for each row of `docs`, with its component's smallest doc_id.

    Null and wordless texts have fingerprint 0 and link like any other. A null doc_id is passed over
    as the smallest unless its component has no other.
    """
    rows = cut(docs.select(F.col(doc_id).alias("key"), fingerprint(spark, F.col(text)).alias("fp")))
    return with_components(spark, rows).select(F.col("key").alias("doc_id"), "fp", "low")


def one_of_each(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs`, one of each component: that with the smallest doc_id, nulls last, and of
    rows with the same one any single one. Columns stay as they are. `docs` is read twice."""
    (row,) = free(docs, "row")
    keyed = docs.withColumn(row, row_key(docs, text))
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    prints = cut(keyed.select(key.alias("key"), fingerprint(spark, F.col(text)).alias("fp")))
    found = with_components(spark, prints).filter(F.col("key") == F.col("low"))
    first = cut(found.groupBy(F.col("key.row").alias(row)).agg(F.count(F.lit(1)).alias("rows")))
    # The narrow side is hashed, so that texts needn't be sorted.
    kept = keyed.join(first.select(row).hint("shuffle_hash"), row, "left_semi")
    if not first.filter(F.col("rows") > 1).isEmpty():
        kept = kept.dropDuplicates([row])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(spark, docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("low").alias("component_id"))
