"""Quality of documents, learned from preferences between two of them.

Bradley and Terry: a document has a utility, linear in its features, and of two documents the first is
preferred with the probability logistic(utility difference). Pairs of a document marked good and one
marked bad are such preferences; the weights minimise the logistic loss on the differences of their
features (Newton's steps on a convex loss). Utilities alone have no zero: the threshold is the quantile
of utilities at the share of bad documents among the labels, and the score is a logistic of the distance
to it that puts the threshold at `LEAST_GOOD`.

All labelled documents that aren't held out are learned from. They're dealt by hash into blocks of both
classes, pairs are formed within a block, and each of Newton's steps sums loss, slope and curve over the
blocks; the quantile is found by counts of all their utilities, digit by digit.

Features come from the bytes of a whole text: shares of bytes, lengths, repeated words, windows of three
words and lines. They're taken in numpy for many texts at once, a very long text in pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut

from .common import exact_text, read, ready_for_python
from .langid import held_out

#: Pairs that each good document is in.
PAIRS = 10
#: Documents of a block, about; those of the rarer class at least, where there are several blocks; sums of
#: blocks added up at a time; pairs looked at at a time.
BLOCK, LEAST, WIDE, CHUNK = 2048, 64, 16, 4096
#: Score of the threshold; pull of the weights towards zero; Newton's steps.
LEAST_GOOD, RIDGE, STEPS, SEED = 0.3, 1e-3, 25, 5
#: Bytes of text looked at at a time; of a row group of blocks.
PIECE, ROW_GROUP_BYTES = 4 << 20, 16 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True
#: Bytes beyond ASCII count as one.
_KIND = np.minimum(np.arange(256), 128).astype(np.int64)
KINDS = 129
STATISTICS = ["words", "word_bytes", "repeated_words", "repeated_windows", "line_words", "repeated_lines", "capital_words", "stopped_words"]
WIDTH = KINDS + len(STATISTICS)
_FIRST = np.array([0] + [(2**64 - 1) << (64 - 8 * n) & (2**64 - 1) for n in range(1, 9)], np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """Words of some texts in their order: a hash, the text, the line (from 0 in all texts together),
    and whether it begins with a capital and ends in a stop."""

    key: np.ndarray
    doc: np.ndarray
    line: np.ndarray
    capital: np.ndarray
    stopped: np.ndarray


def words_of(data: np.ndarray, starts: np.ndarray) -> Words:
    """Of the texts that lie side by side in `data` and begin at `starts` (none of them empty). A hash
    takes a word's first and last 8 bytes, its length and the sum of its bytes."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = edge[-1] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    begin = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    n = end - begin
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8 : 8 + len(data)] = data
    words = np.ndarray((len(data) + 9,), ">u8", padded.data, strides=(1,))  # the 8 bytes from each place on, 8 places later
    first = words[begin + 8].astype(np.uint64) & _FIRST[np.minimum(n, 8)]
    last = np.where(n > 8, words[end].astype(np.uint64), np.uint64(0))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data, out=sums[1:])
    total = sums[end] - sums[begin]
    key = _stirred(first * _A + _stirred(last * _C + n.astype(np.uint64) * _B + total))
    return Words(
        key,
        np.searchsorted(starts, begin, "right") - 1,
        np.searchsorted(np.flatnonzero(data == 10), begin),
        _UPPER[data[begin]],
        _STOP[data[end - 1]],
    )


def _seen_before(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal key comes earlier; whether there's an equal key at all."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    later, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] |= same
    any_[order[:-1]] |= same
    return later, any_


def _statistics(w: Words, docs: int, n_bytes: np.ndarray) -> np.ndarray:
    """(docs, `STATISTICS`) of the words of some texts."""
    per = lambda mask: np.bincount(w.doc[mask], minlength=docs).astype(float)
    n = np.bincount(w.doc, minlength=docs).astype(float)
    out = np.zeros((docs, len(STATISTICS)))
    some = np.maximum(n, 1)
    own = w.key ^ _stirred(w.doc.astype(np.uint64) * _A + _C)
    out[:, 0] = np.log1p(n)
    out[:, 1] = np.log1p(n_bytes / some)
    out[:, 6], out[:, 7] = per(w.capital) / some, per(w.stopped) / some
    if len(own):
        out[:, 2] = per(_seen_before(own)[0]) / some
        whole = np.flatnonzero(w.doc[2:] == w.doc[:-2])
        windows = _stirred(_stirred(own[whole] + _A) * _B + _stirred(own[whole + 1] + _B) * _C + own[whole + 2])
        if len(windows):
            again = whole[_seen_before(windows)[1]]
            covered = np.zeros(len(own), bool)
            for k in range(3):
                covered[again + k] = True
            out[:, 3] = per(covered) / some
        new = np.ones(len(own), bool)
        new[1:] = (w.line[1:] != w.line[:-1]) | (w.doc[1:] != w.doc[:-1])
        first = np.flatnonzero(new)
        place = (np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))).astype(np.uint64)
        line = np.add.reduceat(_stirred(own + place * _C), first)
        lines = np.bincount(w.doc[first], minlength=docs).astype(float)
        out[:, 4] = np.log1p(n / np.maximum(lines, 1))
        out[:, 5] = np.bincount(w.doc[first][_seen_before(line)[0]], minlength=docs) / np.maximum(lines, 1)
    return out


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of about `PIECE` bytes that end before white space."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data):
            gap = _SPACE[data[end : end + PIECE]]
            if gap.any():
                end += int(np.argmax(gap))
                break
            end += PIECE
        yield data[at : min(end, len(data))]
        at = end


def features(texts: pa.Array) -> np.ndarray:
    """(texts, features): roots of the shares of bytes, then `STATISTICS`; of an empty text all zero."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    size = np.diff(offsets)
    out = np.zeros((len(texts), WIDTH))
    filled = np.flatnonzero(size)
    first = 0
    while first < len(filled):
        # Whole texts up to PIECE bytes, or one.
        limit = offsets[filled[first]] + PIECE
        last = max(first + 1, int(np.searchsorted(offsets[filled + 1], limit, "right")))
        own = filled[first:last]
        body = data[offsets[own[0]] : offsets[own[-1] + 1]]
        if len(body) <= PIECE:
            starts = offsets[own] - offsets[own[0]]
            owner = np.repeat(np.arange(len(own)) * KINDS, size[own])
            kinds = np.bincount(owner + _KIND[body], minlength=len(own) * KINDS).reshape(-1, KINDS)
            words = words_of(body, starts)
        else:
            kinds, parts, lines = np.zeros((1, KINDS), np.int64), [], 0
            for piece in _pieces(body):
                kinds[0] += np.bincount(_KIND[piece], minlength=KINDS)
                parts.append(words_of(piece, np.zeros(1, np.int64)))
                parts[-1].line += lines
                lines += int((piece == 10).sum())
            words = Words(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("key", "doc", "line", "capital", "stopped")])
        out[own, :KINDS] = np.sqrt(kinds / size[own][:, None])
        out[own, KINDS:] = _statistics(words, len(own), kinds.sum(axis=1) - kinds[:, _SPACE[:KINDS]].sum(axis=1))
        first = last
    return out


@dataclass(frozen=True)
class Ranker:
    """Utilities are `weights` times features over their `spread`; `threshold` is one."""

    weights: np.ndarray
    threshold: float

    def utilities(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Up to 30 from the threshold on, beyond any document learned from, a score is as good as 0 or 1."""
        z = np.clip(self.utilities(x) - self.threshold, -30, 30) + math.log(LEAST_GOOD / (1 - LEAST_GOOD))
        return 1 / (1 + np.exp(-z))


def preferences(good: int, bad: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the preferred and the other document of each pair: each good one in `PAIRS` of them,
    or more where there are more bad ones than those reach, so that every document is in one."""
    rng = np.random.default_rng(SEED)
    n = max(good * PAIRS, bad)
    others = np.concatenate([rng.permutation(bad) for _ in range(-(-n // bad))])[:n]
    return np.arange(n) % good, others


def loss(weights: np.ndarray, gaps: np.ndarray) -> float:
    """Logistic loss on the feature differences of pairs, and the pull to zero."""
    return float(np.logaddexp(0, -(gaps @ weights)).mean() + RIDGE / 2 * weights @ weights)


def pair_sums(good: np.ndarray, bad: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Over the pairs of some documents, side by side: their number, the loss, its slope, and the upper half
    of its curve. Nothing but zeros where a class is missing."""
    n, value, slope, curve = 0, 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    if len(good) and len(bad):
        a, b = preferences(len(good), len(bad))
        n, good, bad = len(a), good * scale, bad * scale
        for k in range(0, n, CHUNK):
            gaps = good[a[k : k + CHUNK]] - bad[b[k : k + CHUNK]]
            u = gaps @ w
            p = 1 / (1 + np.exp(np.clip(u, -500, 500)))
            value += np.logaddexp(0, -u).sum()
            slope -= p @ gaps
            curve += gaps.T @ (gaps * (p * (1 - p))[:, None])
    return np.concatenate([[n, value], slope, curve[np.triu_indices(len(w))]])


def scale_of(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)


def newton(sums: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The weights of the least loss; `sums(w)` are `pair_sums` of all pairs."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = sums(w)
        mean = found[1:] / found[0]
        curve = np.zeros((size, size))
        curve[np.triu_indices(size)] = mean[1 + size :]
        curve += np.triu(curve, 1).T
        return mean[0] + RIDGE / 2 * w @ w, mean[1 : 1 + size] + RIDGE * w, curve + RIDGE * np.eye(size)

    w = np.zeros(size)
    value, slope, curve = at(w)
    for _ in range(STEPS):
        step = np.linalg.solve(curve, slope)
        if np.abs(step).max() < 1e-8:
            return w - step
        part = 1.0
        after = at(w - step)
        while part > 1e-6 and after[0] > value + 1e-12:  # less is rounding
            part /= 2
            after = at(w - part * step)
        w = w - part * step
        value, slope, curve = after
    return w


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float) -> Ranker:
    """From features of good and of bad documents at hand; `share_bad` is that among all labels. `train`
    does the same for any number."""
    scale = scale_of(np.concatenate([good, bad]).std(axis=0))
    weights = newton(lambda w: pair_sums(good, bad, scale, w), good.shape[1]) * scale
    return Ranker(weights, quantile(good @ weights, bad @ weights, share_bad))


def quantile(good: np.ndarray, bad: np.ndarray, share_bad: float) -> float:
    """The utility with `share_bad` of all below it, where either class weighs as among the labels:
    midway between the neighbours."""
    u = np.concatenate([good, bad])
    weight = np.concatenate([np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))])
    order = np.argsort(u, kind="stable")
    k = int(np.searchsorted(np.cumsum(weight[order]), share_bad - 1e-9)) + 1
    u = u[order]
    return float((u[k - 1] + u[min(k, len(u) - 1)]) / 2)


def vectors(spark: SparkSession, text: Column) -> Column:
    """Features of whole texts as bytes; null counts as the empty text."""
    ready_for_python(spark)

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        x = np.ascontiguousarray(features(texts), "<f8")
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * WIDTH), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())

    return run(exact_text(text))


def _matrix(x: bytes) -> np.ndarray:
    return np.frombuffer(x, "<f8").reshape(-1, WIDTH)


def seen(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Id and features of every row, written once: all are learned from or scored, most are both."""
    return cut(docs.select(F.col(doc_id).alias("i"), vectors(docs.sparkSession, F.col(text)).alias("x")))


def _known(docs: DataFrame, found: DataFrame, clear: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The labelled documents with their features, one row an id: of rows with the same id the least text's.
    Texts are only read again where rows of an id differ."""
    rows = found.filter(F.col("i").isNotNull() & ~held_out(F.col("i").cast("string"))).join(clear, "i").groupBy("i", "q", "place")
    known = cut(rows.agg(F.min("x").alias("x"), F.max("x").alias("most")).select("i", "q", "place", "x", (F.col("x") != F.col("most")).alias("differ")))
    several = known.filter("differ").select("i", "q", "place")
    if several.isEmpty():
        return known.drop("differ")
    texts = docs.select(F.col(doc_id).alias("i"), exact_text(text).alias("t")).join(cut(several), "i").groupBy("i", "q", "place").agg(F.min("t").alias("t"))
    return cut(known.filter(~F.col("differ")).drop("differ").unionByName(texts.withColumn("x", vectors(docs.sparkSession, F.col("t"))).drop("t")))


def _dealt(known: DataFrame, good: int, bad: int) -> tuple[DataFrame, int, int, int]:
    """Blocks as rows (number, features of its good and of its bad ones in order of ids), the number of
    blocks, the rarer class, and its copies.

    Blocks have about `BLOCK` documents and both classes. Where the rarer class is too small for that,
    there are fewer, and the other class of each is dealt over several rows that all have its rarer ones:
    only those with a number divisible by the copies count as documents, the others just as partners.
    """
    rare, fewer, more = (1, good, bad) if good < bad else (0, bad, good)
    blocks = 1
    while blocks * BLOCK < good + bad and fewer >= 2 * blocks * LEAST:
        blocks *= 2
    while blocks > 1 and known.select((F.col("place") % blocks).alias("b"), "q").distinct().count() < 2 * blocks:
        blocks //= 2
    copies = -(-more // (blocks * BLOCK))
    # Blocks go by the place's last bits, the rows of one by its first 20.
    part = F.when(F.col("q") == rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array((F.shiftright("place", 20) * copies / float(2**20)).cast("int")))
    dealt = known.withColumn("part", F.explode(part)).select(((F.col("place") % blocks) * copies + F.col("part")).alias("number"), "i", "q", "x")

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        x = [b"".join(table.filter(pc.equal(table["q"], k))["x"].to_pylist()) for k in (1, 0)]
        return pa.table({"number": table["number"][:1], "good": pa.array(x[:1], pa.binary()), "bad": pa.array(x[1:], pa.binary())})

    return cut(dealt.groupBy("number").applyInArrow(pack, "number long, good binary, bad binary"), ROW_GROUP_BYTES), blocks * copies, rare, copies


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["number"], _matrix(row["good"]), _matrix(row["bad"])


def _summed(blocks: DataFrame, n: int, of: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of `of(number, good, bad)` over `n` blocks, added up in order of their numbers, so that it's the
    same however tasks hold them. At most `WIDE` sums meet in a task or on the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, good, bad in _rows(batches):
            yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), "part": pa.array([of(number, good, bad).tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        total = sum(np.frombuffer(p, "<f8") for p in table["part"].to_pylist())
        return pa.table({"number": pc.divide(table["number"][:1], WIDE), "part": pa.array([total.tobytes()], pa.binary())})

    parts = blocks.mapInArrow(each, "number long, part binary")
    while n > WIDE:
        parts = parts.groupBy(F.expr(f"number div {WIDE}")).applyInArrow(add, "number long, part binary")
        n = -(-n // WIDE)
    return sum(np.frombuffer(r.part, "<f8") for r in sorted(parts.collect(), key=lambda r: r.number))


def threshold_of(utilities: DataFrame, good: int, bad: int, share_bad: float) -> float:
    """`quantile` of any number of utilities, given as `order_key` and class `q`: counted by 16 bits of
    the key at a time, each time among those that agree with the bits found."""
    each = {1: (1 - share_bad) / good, 0: share_bad / bad}
    weight = lambda g, b: g * each[1] + b * each[0]
    target, below, key = share_bad - 1e-9, (0, 0), None
    for shift in (48, 32, 16, 0):
        left = utilities if key is None else utilities.filter(F.shiftright("key", shift + 16) == key)
        sums = left.groupBy(F.shiftright("key", shift).alias("k")).agg(F.sum("q").alias("g"), F.sum(1 - F.col("q")).alias("b"))
        counts = sorted(sums.collect(), key=lambda r: r.k)
        for r in counts:
            if r is counts[-1] or weight(below[0] + r.g, below[1] + r.b) >= target:
                key, own = r.k, (r.g, r.b)
                break
            below = below[0] + r.g, below[1] + r.b
    value = _value(key)
    # Of equal utilities the good ones come first: is there one more behind the one found?
    last = (0, 1) if own[1] else (1, 0)
    if weight(below[0] + own[0] - last[0], below[1] + own[1] - last[1]) >= target and sum(own) > 1:
        return value
    following = utilities.filter(F.col("key") > key).agg(F.min("key")).first()[0]
    return value if following is None else (value + _value(following)) / 2


def order_key(u: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the utilities."""
    bits = np.ascontiguousarray(u + 0.0, np.float64).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def _value(key: int) -> float:
    return float(np.array([key if key >= 0 else key ^ (2**63 - 1)], np.int64).view(np.float64)[0])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", found: DataFrame | None = None) -> Ranker | None:
    """Learns from every labelled document that's not held out; none if a class is missing. `found` is
    `seen(docs)`, if it's there already.

    A label that's neither 0 nor 1 is none, and documents with labels of both kinds aren't learned from; of
    rows with the same id one text is. Only sums over documents, and counts of utilities, reach the driver.
    """
    quality = F.col("quality")
    marks = labels.select(F.col("doc_id").alias("i"), quality.alias("q")).filter(quality.isin(0, 1) & F.col("i").isNotNull() & ~held_out(F.col("i").cast("string")))
    clear = marks.groupBy("i").agg(F.min("q").cast("int").alias("q"), F.max("q").alias("most")).filter(F.col("q") == F.col("most"))
    clear = cut(clear.select("i", "q", F.xxhash64("i").bitwiseAND(F.lit(2**40 - 1)).alias("place")))
    count = lambda df: {r.q: r.n for r in df.groupBy("q").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = count(clear)
    if len(counts) < 2:
        return None
    known = _known(docs, seen(docs, text, doc_id) if found is None else found, clear, text, doc_id)
    there = count(known)
    if len(there) < 2:
        return None
    blocks, n, rare, copies = _dealt(known, there[1], there[0])

    def own(number: int, good: np.ndarray, bad: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The documents that count here, by class."""
        return [(q, x) for q, x in ((1, good), (0, bad)) if q != rare or number % copies == 0]

    total = there[0] + there[1]
    mean = _summed(blocks, n, lambda *row: sum(x.sum(axis=0) for _, x in own(*row))) / total
    spread = np.sqrt(_summed(blocks, n, lambda *row: sum(((x - mean) ** 2).sum(axis=0) for _, x in own(*row))) / total)
    scale = scale_of(spread)
    weights = newton(lambda w: _summed(blocks, n, lambda _, good, bad: pair_sums(good, bad, scale, w)), WIDTH) * scale

    def utilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            for q, x in own(*row):
                yield pa.RecordBatch.from_pydict({"key": order_key(x @ weights), "q": pa.array([q] * len(x), pa.int32())})

    keys = cut(blocks.mapInArrow(utilities, "key long, q int"))
    return Ranker(weights, threshold_of(keys, there[1], there[0], counts[0] / (counts[0] + counts[1])))


def rated(spark: SparkSession, ranker: Ranker | None, x: Column) -> Column:
    """Score of `vectors`, from 0 to 1; where there was nothing to learn from, all score 0.5."""
    ready_for_python(spark)

    @F.arrow_udf("double")
    def run(x: pa.Array) -> pa.Array:
        if ranker is None:
            return pa.array([0.5] * len(x), pa.float64())
        return pa.array(np.round(ranker.scores(_matrix(b"".join(x.to_pylist()))), 6))

    return run(x)


def scored(spark: SparkSession, ranker: Ranker | None, text: Column) -> Column:
    """Score of whole texts, from 0 to 1. Null counts as the empty text, which scores by its features as
    any other; where there was nothing to learn from, all score 0.5."""
    return rated(spark, ranker, vectors(spark, text))


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and verdict of every whole text of documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = seen(docs)
    ranker = train(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"), found=found)
    out = found.select(F.col("i").alias("doc_id"), held_out("i").alias("held_out"), rated(spark, ranker, F.col("x")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= LEAST_GOOD, 1).otherwise(0))
