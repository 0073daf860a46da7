"""Language of texts: a byte convolutional network over fixed-length windows, trained in numpy.

Bytes are embedded; filters of several widths slide over a window; each filter's maximum over the
window goes through a rectifier into a softmax over the languages. A text is cut into windows that
cover all of it, and its prediction is the mean of their probabilities, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exact_text, read, ready_for_python

UNKNOWN = "und"
#: Texts of each language that are learned from at most, and windows of each such text.
SAMPLE_TEXTS, SAMPLE_WINDOWS = 200, 4
#: Languages that are learned at most, the most frequent ones: a dirty column may hold any number of values.
MOST_LANGS = 256
#: Bytes of a window, and windows that go through the network at a time.
WINDOW, BATCH = 256, 128
HELD_OUT_MODULUS = 5


@dataclass
class Net:
    """Weights. Byte 0, which pads the last window, is embedded as zeros."""

    langs: list[str]
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 24
    size: int = 8
    seed: int = 7
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        make = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.w["embed"] = make(256, self.size, scale=0.5)
        self.w["embed"][0] = 0
        for k in self.widths:
            self.w[f"conv{k}"] = make(k * self.size, self.filters, scale=(k * self.size) ** -0.5)
            self.w[f"bias{k}"] = np.zeros(self.filters, np.float32)
        wide = self.filters * len(self.widths)
        self.w["out"] = make(wide, len(self.langs), scale=wide**-0.5)
        self.w["out_bias"] = np.zeros(len(self.langs), np.float32)

    def forward(self, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Probabilities (windows, languages) of byte windows; `keep` gets what learning needs."""
        x = self.w["embed"][windows]
        n, length, _ = x.shape
        pooled = []
        for k in self.widths:
            # Consecutive positions lie side by side in memory, so a window of k of them is a view.
            s = x.strides
            cols = np.lib.stride_tricks.as_strided(x, (n, length - k + 1, k * self.size), (s[0], s[1], s[2])).reshape(-1, k * self.size)
            y = (cols @ self.w[f"conv{k}"]).reshape(n, length - k + 1, self.filters)
            pooled.append(y.max(axis=1) + self.w[f"bias{k}"])
            if keep is not None:
                keep[k] = cols, y.argmax(axis=1)
        h = np.maximum(np.concatenate(pooled, axis=1), 0)
        z = h @ self.w["out"] + self.w["out_bias"]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        if keep is not None:
            keep["h"] = h
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy; `target` holds language numbers."""
        keep: dict = {}
        n, length = windows.shape
        d = self.forward(windows, keep)
        d[np.arange(n), target] -= 1
        d /= n
        g = {"out": keep["h"].T @ d, "out_bias": d.sum(axis=0), "embed": np.zeros_like(self.w["embed"])}
        back = (d @ self.w["out"].T) * (keep["h"] > 0)
        for j, k in enumerate(self.widths):
            dk = back[:, j * self.filters : (j + 1) * self.filters]
            cols, at = keep[k]
            rows = np.arange(n)[:, None] * (length - k + 1) + at  # only the maximum of a filter passes its gradient
            g[f"bias{k}"] = dk.sum(axis=0)
            g[f"conv{k}"] = np.einsum("nfc,nf->cf", cols[rows], dk)
            dx = np.einsum("nf,cf->nfc", dk, self.w[f"conv{k}"]).reshape(n, self.filters, k, self.size)
            for i in range(k):
                np.add.at(g["embed"], windows[np.arange(n)[:, None], at + i], dx[:, :, i])
        g["embed"][0] = 0
        return g

    def learn(self, windows: np.ndarray, target: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 4e-3) -> None:
        """Adam over shuffled batches; the same weights for the same input."""
        rng = np.random.default_rng(self.seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                step += 1
                for k, g in self.gradients(windows[chosen], target[chosen]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)


def cut_windows(raw: bytes) -> np.ndarray:
    """All of a text in windows, A-Z in lower case, the last one padded with zero bytes."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.lower().ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def fit(texts: list[tuple[str, str]], epochs: int = 4) -> Net | None:
    """A net from (text, language) rows, or none if there's nothing to learn from."""
    langs = sorted({lang for _, lang in texts})
    if not langs:
        return None
    net = Net(langs)
    rng = np.random.default_rng(net.seed)
    windows, target = [], []
    for text, lang in sorted(texts):
        own = cut_windows(text.encode("utf-8"))
        chosen = own[rng.permutation(len(own))[:SAMPLE_WINDOWS]]
        windows.append(chosen)
        target += [langs.index(lang)] * len(chosen)
    net.learn(np.concatenate(windows), np.array(target), epochs)
    return net


_LETTER = regex.compile(r"\p{L}").search


def _scored(net: Net, texts: list[str]) -> Iterator[tuple[str, float]]:
    """Prediction and score of each text, windows of many texts batched together."""
    raws = [t.encode("utf-8") for t in texts]
    total = np.zeros((len(texts), len(net.langs)))
    pending: list[tuple[int, np.ndarray]] = []
    waiting = 0

    def flush() -> None:
        nonlocal pending, waiting
        if pending:
            windows = np.concatenate([w for _, w in pending])
            owner = np.concatenate([np.full(len(w), i) for i, w in pending])
            np.add.at(total, owner, net.forward(windows) * (windows != 0).sum(axis=1)[:, None])
        pending, waiting = [], 0

    for i, raw in enumerate(raws):
        if not _LETTER(texts[i]):
            continue
        windows = cut_windows(raw)
        for at in range(0, len(windows), BATCH):
            pending.append((i, windows[at : at + BATCH]))
            waiting += len(pending[-1][1])
            if waiting >= BATCH:
                flush()
    flush()
    for row in total:
        weight = row.sum()
        if weight > 0:
            best = int(row.argmax())
            yield net.langs[best], min(1.0, max(0.0, round(float(row[best] / weight), 6)))
        else:
            yield UNKNOWN, 0.0


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % HELD_OUT_MODULUS == 0, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Net | None:
    """Learns from at most `SAMPLE_TEXTS` texts of each language among the documents not held out.

    The sample is the lowest hashes of doc_id: languages are counted first, so that only about the
    needed share of ids is gathered, and only the chosen texts leave the executors. A null language
    isn't learned from, nor a text without letters; of rows with the same id and language one text is. Of
    more than `MOST_LANGS` languages the most frequent are learned.
    """
    rows = docs.select(F.col(doc_id).alias("i"), F.col(lang).alias("l"), F.col(text).alias("t"))
    rows = rows.filter(F.col("l").isNotNull() & F.col("i").isNotNull() & ~held_out(F.col("i").cast("string")) & F.col("t").rlike(r"\p{L}"))
    often = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(MOST_LANGS)
    counts = {r.l: r.n for r in often.collect()}
    if not counts:
        return None
    # A language keeps the hashes below its share, with a margin that makes too few unlikely.
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, (2.0 * SAMPLE_TEXTS + 50) / n))])
    place = (F.xxhash64("i").bitwiseAND(F.lit(2**40 - 1)) / float(2**40)).alias("p")
    near = rows.select("i", "l", place).filter(F.col("p") < F.element_at(share, F.col("l")))
    chosen: dict[str, list] = {}
    for r in near.distinct().orderBy("p", "i").collect():
        if len(chosen.setdefault(r.l, [])) < SAMPLE_TEXTS and r.i not in chosen[r.l]:
            chosen[r.l].append(r.i)
    ids = [i for own in chosen.values() for i in own]
    texts = rows.filter(F.col("i").isin(ids)).groupBy("i", "l").agg(F.min("t").alias("t")).collect()
    return fit([(r.t, r.l) for r in texts])


def predicted(spark: SparkSession, net: Net | None, text: Column) -> Column:
    """Struct `lang_pred`, `score` of whole texts. Null, or no letter at all, or nothing to learn
    from: `und` with score 0. Repeated rows are predicted alike; an empty table stays empty."""
    ready_for_python(spark)

    @F.arrow_udf("lang_pred string, score double")
    def run(texts: pa.Array) -> pa.Array:
        found = list(_scored(net, texts.to_pylist())) if net else [(UNKNOWN, 0.0)] * len(texts)
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["lang_pred", "score"])

    return run(exact_text(text))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every whole text of documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train(docs)
    out = docs.select("doc_id", predicted(spark, net, F.col("text")).alias("p"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")
