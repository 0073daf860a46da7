"""How far the sources of a language are apart: counts of terms, packed into machine words by length.

A term is a run of letters and of characters beyond ASCII. In a task, the bytes of many texts are cut
into terms at once. Terms of up to 8 bytes become one 64-bit word, those of up to 16 bytes two, big end
first and padded with zero bytes, so that words order as bytes do; they're radix-sorted by 16-bit digits
and counted as runs. Longer terms go by powers of two of their length into buckets that are sorted as
bytes. What a task has counted is folded again whenever it grows past a bound, and handed to Spark,
which adds up by language, term and source in one shuffle.

Of the terms kept, divergences between the sources are summed in numpy over a bounded number of rows at
a time; they're dealt by language and a hash of the term into as many groups as the rows need.

All arithmetic is on whole numbers. Counts of one source may reach 9e15.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, read, ready_for_python

#: Documents of a language that a kept term occurs in at least; parts a probability is counted in; ranks of terms.
LEAST_DOCS, PARTS, TOP_TERMS = 10, 1_000_000_000, 10
#: Bytes of text cut into terms at a time, counted runs a task keeps at most, bytes of long terms among them.
PIECE, MOST_RUNS, MOST_LONG = 4 << 20, 1_000_000, 16 << 20
#: Rows of kept terms in a group, cells of a block of counts, sources a group compares with all others.
GROUP_ROWS, BLOCK_CELLS, GROUP_SOURCES = 100_000, 1 << 18, 256

_TERM = np.zeros(256, bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Keeps the first n bytes of a word, big end first.
_FIRST = np.array([0] + [(2**64 - 1) << (64 - 8 * n) & (2**64 - 1) for n in range(1, 9)], np.uint64)


@dataclass
class Runs:
    """Counted terms: one or two words each, or bytes; the group, occurrences and documents."""

    keys: list[np.ndarray]
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def __len__(self) -> int:
        return len(self.group)

    def terms(self) -> pa.Array:
        if self.keys[0].dtype.kind == "S":
            return pa.array(self.keys[0].tolist(), pa.binary())
        width = 8 * len(self.keys)
        # A numpy string ends before its trailing zero bytes, as the terms do.
        packed = np.stack(self.keys, axis=1).astype(">u8").view(f"S{width}")[:, 0]
        return pa.array(packed.tolist(), pa.binary())


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """A stable order by several keys, the last one counting most: whole numbers by 16-bit digits from
    the lowest, each digit by numpy's radix sort of 16-bit numbers, and strings as bytes."""
    order = np.arange(len(keys[0]))
    for key in keys:
        if key.dtype.kind == "S":
            order = order[np.argsort(key[order], kind="stable")]
            continue
        for shift in range(0, 8 * key.dtype.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def counted(keys: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> Runs:
    """Runs of equal terms of a group, from single occurrences whose documents ascend."""
    if not len(group):
        return Runs(keys, group, np.zeros(0, np.int64), np.zeros(0, np.int64))
    order = radix_order([group, *reversed(keys)])
    keys, group, doc = [k[order] for k in keys], group[order], doc[order]
    new = _changes([*keys, group])
    start = np.flatnonzero(new)
    new[1:] |= doc[1:] != doc[:-1]
    n = np.diff(np.append(start, len(group)))
    return Runs([k[start] for k in keys], group[start], n.astype(np.int64), np.add.reduceat(new.astype(np.int64), start))


def folded(parts: list[Runs], one_document: bool = False) -> Runs:
    """Runs added up. Those of one document's pieces are still one document."""
    keys = [np.concatenate(k) for k in zip(*[p.keys for p in parts], strict=True)]
    group, n, docs = (np.concatenate([getattr(p, f) for p in parts]) for f in ("group", "n", "docs"))
    if not len(group):
        return Runs(keys, group, n, docs)
    order = radix_order([group, *reversed(keys)])
    keys, group = [k[order] for k in keys], group[order]
    start = np.flatnonzero(_changes([*keys, group]))
    add = np.maximum if one_document else np.add
    return Runs([k[start] for k in keys], group[start], np.add.reduceat(n[order], start), add.reduceat(docs[order], start))


def pack(data: np.ndarray, doc_starts: np.ndarray, group_of: np.ndarray) -> dict[int, Runs]:
    """Counted terms of the texts that lie side by side in `data`, by bucket: 1 and 2 are words, larger
    ones the bytes that a bucket's terms have at most."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[doc_starts] = True  # a term ends with its text
    edge[-1] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    length = np.flatnonzero(inside & (~after | edge[1:])) + 1 - start
    doc = np.searchsorted(doc_starts, start, "right") - 1
    group = group_of[doc]
    lower = np.zeros(len(data) + 16, np.uint8)
    lower[: len(data)] = _LOWER[data]
    # The 8 bytes from each place on as one number: a view, nothing is copied.
    words = np.ndarray((len(data) + 9,), ">u8", lower.data, strides=(1,))
    out: dict[int, Runs] = {}
    short = length <= 8
    if short.any():
        s, n = start[short], length[short]
        out[1] = counted([words[s].astype(np.uint64) & _FIRST[n]], group[short], doc[short])
    middle = (length > 8) & (length <= 16)
    if middle.any():
        s, n = start[middle], length[middle]
        out[2] = counted([words[s].astype(np.uint64), words[s + 8].astype(np.uint64) & _FIRST[n - 8]], group[middle], doc[middle])
    long = np.flatnonzero(length > 16)
    if len(long):
        raw = lower.tobytes()
        bucket = 1 << np.ceil(np.log2(length[long])).astype(np.int64)
        for width in np.unique(bucket).tolist():
            own = long[bucket == width]
            terms = np.array([raw[a : a + n] for a, n in zip(start[own].tolist(), length[own].tolist(), strict=True)], f"S{width}")
            out[width] = counted([terms], group[own], doc[own])
    return out


def _cuts(data: np.ndarray) -> list[int]:
    """Where a long text is cut into pieces: before a byte that's in no term, `PIECE` or more apart."""
    out, at = [0], PIECE
    while at < len(data):
        gap = -1
        for a in range(at, len(data), PIECE):
            if (~_TERM[data[a : a + PIECE]]).any():
                gap = a + int(np.argmax(~_TERM[data[a : a + PIECE]]))
                break
        if gap < 0:
            break
        out.append(gap)
        at = gap + PIECE
    return [*out, len(data)]


class Counter:
    """What a task has counted and not handed on yet."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: dict[int, list[Runs]] = {}

    def add(self, found: dict[int, Runs]) -> None:
        for bucket, runs in found.items():
            self.parts.setdefault(bucket, []).append(runs)

    def texts(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts texts, given as their bytes and where each begins (and the last ends)."""
        first = 0
        while first < len(group):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
            own = data[offsets[first] : offsets[last]]
            if len(own) <= PIECE:
                if len(own):
                    filled = first + np.flatnonzero(np.diff(offsets[first : last + 1]))
                    self.add(pack(own, offsets[filled] - offsets[first], group[filled]))
            else:  # one text
                cuts = _cuts(own)
                pieces = [pack(own[a:b], np.zeros(1, np.int64), group[first:last]) for a, b in zip(cuts, cuts[1:], strict=False)]
                self.add({bucket: folded([p[bucket] for p in pieces if bucket in p], True) for bucket in {b for p in pieces for b in p}})
            first = last
            yield from self.handed_on(False)

    def handed_on(self, everything: bool) -> Iterator[pa.RecordBatch]:
        if everything or self._size() > 1:
            self.parts = {bucket: [folded(parts)] for bucket, parts in self.parts.items()}
            if everything or self._size() > 0.5:
                names = [*self.groups]
                for bucket in [*self.parts]:
                    (runs,) = self.parts.pop(bucket)
                    step = max(1, min(1 << 16, (4 << 20) // bucket))
                    for a in range(0, len(runs), step):
                        yield _batch(names, Runs([k[a : a + step] for k in runs.keys], runs.group[a : a + step], runs.n[a : a + step], runs.docs[a : a + step]))
        if everything:
            none = np.zeros(len(self.groups), np.int64)
            yield _batch([*self.groups], Runs([np.zeros(len(none), "S1")], np.arange(len(none)), none, none))

    def _size(self) -> float:
        """Of what's kept by what may be."""
        words = sum(len(p) for b in (1, 2) for p in self.parts.get(b, []))
        long = sum(p.keys[0].nbytes + 24 * len(p) for b, parts in self.parts.items() if b > 2 for p in parts)
        return words / MOST_RUNS + long / MOST_LONG


_COUNTS = "lang string, source string, term binary, n long, docs long"


def _batch(names: list[tuple[str, str]], runs: Runs) -> pa.RecordBatch:
    by = [pa.array([x[i] for x in names], pa.string()).take(pa.array(runs.group.astype(np.int64))) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([*by, runs.terms(), pa.array(runs.n), pa.array(runs.docs)], ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language, source and term of a task's texts, and an empty term for each group met."""
    counter = Counter()
    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        group = np.array([counter.groups.setdefault(g, len(counter.groups)) for g in groups], np.uint32)
        text = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        yield from counter.texts(data, offsets, group)
    yield from counter.handed_on(True)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """`lang`, `source`, `term`, `n`, `n_lang`, `first`, written out: occurrences of the kept terms that a
    source has, there and in the whole language; `first` is true for one row of each term. A source has
    one row more, with an empty term.

    Nulls are empty. Terms, of any length, are those of whole texts; a repeated row is a document more.
    """
    ready_for_python(docs.sparkSession)
    rows = docs.select(exact_text(lang).alias("lang"), exact_text(source).alias("source"), exact_text(text).alias("text"))
    # One shuffle: what adds up by source, too, lies where its term does.
    met = rows.mapInArrow(_count, _COUNTS).repartition("lang", "term").groupBy("lang", "term", "source")
    cells = met.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    whole = cells.withColumns(
        {"in_docs": F.sum("docs").over(own), "n_lang": F.sum("n").over(own), "first": F.row_number().over(own.orderBy("source")) == 1}
    )
    kept = whole.filter((F.col("in_docs") >= least_docs) | (F.length("term") == 0))
    return cut(kept.select("lang", "source", F.col("term").cast("string").alias("term"), "n", "n_lang", "first"))


def probability(n: Column, total: Column) -> Column:
    """1 + floor(PARTS * (n + 2) / total), exactly, in Spark."""
    wide = lambda c: c.cast("decimal(18,0)")
    return 1 + F.call_function("div", (wide(n) + 2) * F.lit(PARTS).cast("decimal(10,0)"), wide(total)).cast("bigint")


def probabilities(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same in numpy: a long division by thousands, so that longs hold every step."""
    quotient, rest = np.divmod(n + 2, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + more
    return quotient + 1


def _pair_sums(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of divergences between the sources of a language over a group of terms. Of each two, the one
    with the smaller number is in the group's block of sources. Rows without a term hold sources' totals."""
    sources, terms = rows.filter(pc.is_null(rows["term"])), rows.filter(pc.is_valid(rows["term"]))
    total = sources.sort_by("number").column("n").to_numpy()
    block = key[2].as_py() * GROUP_SOURCES
    own = range(block, min(block + GROUP_SOURCES, len(total)))
    sums = np.zeros((len(own), len(total)), np.int64)
    of_term = terms.column("term").combine_chunks().dictionary_encode()
    if len(terms):
        place = of_term.indices.to_numpy()
        by_term = np.argsort(place, kind="stable")
        place, number, n = place[by_term], terms.column("number").to_numpy()[by_term], terms.column("n").to_numpy()[by_term]
        step = max(1, BLOCK_CELLS // len(total))
        for first in range(0, len(of_term.dictionary), step):
            a, b = np.searchsorted(place, [first, first + step])
            counts = np.zeros((min(step, len(of_term.dictionary) - first), len(total)), np.int64)
            counts[place[a:b] - first, number[a:b]] = n[a:b]
            p = probabilities(counts, total)
            for i, s in enumerate(own):
                gap, both = p[:, s + 1 :] - p[:, s, None], p[:, s + 1 :] + p[:, s, None]
                sums[i, s + 1 :] += (gap * gap // both).sum(axis=0)
    a, b = np.nonzero(np.arange(len(total))[None, :] > np.array(own)[:, None]) if len(own) else (np.zeros(0, int),) * 2
    columns = [pa.array([key[0].as_py()] * len(a), pa.string()), pa.array(a + block, pa.int32()), pa.array(b, pa.int32()), pa.array(sums[a, b], pa.int64())]
    return pa.Table.from_arrays(columns, ["lang", "a", "b", "value"])


def pairs(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """`lang`, `source`, `item`, `value` for each source and each other one of its language."""
    kept = cells.filter(F.col("term") != "")
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    sources = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    shape = cut(
        sources.join(size, "lang", "left").select(
            "lang",
            F.greatest(F.lit(1), F.ceil(F.coalesce("rows", F.lit(0)) / GROUP_ROWS)).cast("int").alias("groups"),
            F.ceil(F.col("sources") / GROUP_SOURCES).cast("int").alias("blocks"),
        )
    )
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = (
        kept.join(shape, "lang").join(totals.select("lang", "source", "number"), ["lang", "source"])
        .select("lang", F.pmod(F.xxhash64("term"), F.col("groups")).cast("int").alias("part"), "blocks", "term", "number", "n")
        .select("lang", "part", all_of("blocks").alias("block"), "term", "number", "n")
    )
    every = totals.join(shape, "lang").select("lang", "blocks", all_of("groups").alias("part"), "number", "total")
    every = every.select("lang", "part", all_of("blocks").alias("block"), F.lit(None).cast("string").alias("term"), "number", F.col("total").alias("n"))
    sums = dealt.unionByName(every).groupBy("lang", "part", "block").applyInArrow(_pair_sums, "lang string, a int, b int, value long")
    both = cut(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = lambda number, as_: totals.select("lang", F.col("number").alias(number), F.col("source").alias(as_))
    named = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value")
    return named.unionByName(named.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def divergences(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: of each source its divergence from every other
    one of its language (`pair`), and the terms it has most above its language (`term`, to rank
    `TOP_TERMS`).

    An empty table has no rows; a source without terms counts every kept term as zero, and a language
    without kept terms has divergences of 0. Ties go to the smaller item by its bytes. Extra columns
    aren't read.
    """
    cells = term_counts(docs, text, lang, source, least_docs)
    in_lang = cells.groupBy("lang").agg(F.count_if(F.col("first") & (F.col("term") != "")).alias("terms"), F.sum("n").alias("n_all"))
    by_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    totals = by_source.join(in_lang, "lang").select(
        "lang",
        "source",
        number.alias("number"),
        (F.col("n_source") + 2 * F.col("terms")).alias("total"),
        (F.col("n_all") + 2 * F.col("terms")).alias("total_lang"),
    )
    totals = cut(totals)
    met = cells.filter((F.col("term") != "") & (F.col("n") > 0)).join(totals, ["lang", "source"])
    p, q = F.col("p"), F.col("q")
    scored = met.withColumns({"p": probability(F.col("n"), F.col("total")), "q": probability(F.col("n_lang"), F.col("total_lang"))})
    above = scored.filter(p > q).select("lang", "source", F.col("term").alias("item"), F.call_function("div", (p - q) * (p - q), p + q).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    return ranked(pairs(cells, totals), "pair").unionByName(ranked(above, "term").filter(F.col("rank") <= TOP_TERMS))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources of documents."""
    return divergences(read(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
met AS (SELECT i, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT i, lang, source, unnest(regexp_extract_all(text, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS t FROM docs)),
kept AS MATERIALIZED (SELECT lang, term, count(*)::HUGEINT AS n FROM met GROUP BY ALL HAVING count(DISTINCT i) >= {LEAST_DOCS}),
sources AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT l.lang, count(k.term)::HUGEINT AS v, coalesce(sum(k.n), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang FROM docs) AS l LEFT JOIN kept AS k USING (lang) GROUP BY l.lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM met GROUP BY ALL),
cells AS MATERIALIZED (SELECT k.lang, s.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS n_lang
  FROM kept AS k JOIN sources AS s USING (lang) LEFT JOIN counts AS c USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM cells GROUP BY ALL),
scored AS MATERIALIZED (SELECT c.lang, c.source, c.term, c.n, 1 + ({PARTS}::HUGEINT * (c.n + 2)) // (t.n + 2 * z.v) AS p,
  1 + ({PARTS}::HUGEINT * (c.n_lang + 2)) // (z.n + 2 * z.v) AS q
  FROM cells AS c JOIN totals AS t USING (lang, source) JOIN sizes AS z USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM scored AS a JOIN scored AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
best AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM scored WHERE n > 0 AND p > q)
SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value,
  row_number() OVER (PARTITION BY a.lang, a.source ORDER BY coalesce(value, 0) DESC, b.source)::INTEGER AS rank
FROM sources AS a JOIN sources AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM best) WHERE rank <= {TOP_TERMS}
"""
