"""BPE encoding and decoding: a heap of merge ranks over a doubly linked list of symbols.

The vocabulary is a tokenizers-library JSON file whose path is a parameter. The driver reads it (a
fixed file of a few MB) and broadcasts its bytes, so executors need no copy of it.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exact_text, read, ready_for_python

#: Words whose tokens a Python worker remembers in each of two generations: when the younger one is
#: full, it becomes the older one, and words move back from there when they're met again.
REMEMBERED = 100_000
#: Words of a text encoded at a time; between them the memory is looked after.
SLICE = 50_000

# Fixed: Unicode's White_Space characters.
SPACE = "\t-\r \x85\xa0  -     　"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one above 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    above = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(above)) for b in range(256)]


def _latin(kind: str) -> str:
    """The characters below 256 of a kind: among these the standard library's faster patterns do."""
    return "".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == kind)


class Codec:
    """Encodes as a tokenizers file of this kind says: special tokens in the text first, then NFC,
    single spaces, lower case, words by its pattern, bytes as characters, merges."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.merges[self.vocab[left], self.vocab[right]] = rank, self.vocab[left + right]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space only parts words, so it isn't made single spaces first.
        self.words = regex.compile(pattern.replace(r"\s", SPACE)).findall
        latin = {r"\s": SPACE, r"\p{L}": _latin("L"), r"\p{N}": _latin("N")}
        for name, chars in latin.items():
            pattern = pattern.replace(name, chars)
        self.latin_words = re.compile(pattern).findall
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = byte_characters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def word(self, word: str) -> list[int]:
        """Token ids of one word. The heap holds (rank, left place, left id, right id); an entry whose
        symbols have changed since is stale and skipped."""
        chars = [self.letters[b] for b in word.encode("utf-8")]
        chars[-1] += self.suffix
        ids = [self.vocab[c] for c in chars]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(m[0], i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (m := self.merges.get(pair))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0 and (m := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (m[0], a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens, normalized."""
        text = unicodedata.normalize("NFC", text)
        # A word-final sigma is lowered by context in Python, by itself here.
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words(text)
        return self.latin_words(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for k, part in enumerate(self.at_special.split(text) if self.special else [text]):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            words = self.split(part)
            for at in range(0, len(words), SLICE):
                own = words[at : at + SLICE]
                if len(self.known) >= REMEMBERED:
                    self.known, self.older = {}, self.known
                known, older = self.known, self.older
                for w in {*own}.difference(known):
                    known[w] = older.get(w) or b"".join([i.to_bytes(4, "little") for i in self.word(w)])
                out.append(b"".join([known[w] for w in own]))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings of packed ids, put together as a file without a decoder has them: a space
        between."""
        strings = self.strings
        return " ".join([strings[i] for i in memoryview(ids).cast("I")])


_CODEC: list = [None, None]


def _codec(raw) -> Codec:
    """The codec of a broadcast file, built once in a Python worker."""
    if _CODEC[0] is not raw:
        _CODEC[:] = raw, Codec(raw.value)
    return _CODEC[1]


TOKENS = "ids binary, n_tokens bigint, decoded string"


def tokens(spark: SparkSession, text: Column, vocab_path: str) -> Column:
    """Struct `ids` (little-endian unsigned 32-bit), `n_tokens`, `decoded` of a text; null is the empty
    text, which has no tokens. Texts of any length are encoded whole."""
    ready_for_python(spark)
    raw = spark.sparkContext.broadcast(Path(vocab_path).read_bytes())

    @F.arrow_udf(TOKENS)
    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(raw)
        ids = [codec.encode(text) for text in texts.to_pylist()]
        decoded = [codec.decode(x) for x in ids]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), counts, pa.array(decoded, pa.string())], ["ids", "n_tokens", "decoded"])

    return run(exact_text(text))


def decoded(spark: SparkSession, ids: Column, vocab_path: str) -> Column:
    """The text of packed ids (null or empty: the empty text)."""
    ready_for_python(spark)
    raw = spark.sparkContext.broadcast(Path(vocab_path).read_bytes())

    @F.arrow_udf("string")
    def run(packed: pa.Array) -> pa.Array:
        codec = _codec(raw)
        return pa.array([codec.decode(x or b"") for x in packed.to_pylist()], pa.string())

    return run(ids)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark: SparkSession, sf_dir: str, vocab_path: str | None = None) -> DataFrame:
    """Tokens of every whole text of documents, and their decoding, as digests."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select("doc_id", tokens(spark, F.col("text"), vocab_path or default_vocabulary()).alias("t"))
    return out.select(
        "doc_id",
        F.col("t.n_tokens").alias("n_tokens"),
        F.sha2("t.ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("t.decoded", "utf-8"), 256).alias("decoded_sha256"),
    )
