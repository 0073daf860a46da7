import hashlib
import random
import unicodedata

import pytest

from perkmill.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    rng = random.Random(4)
    some = ["", "Hello, World's  ÉÀ 123\n<|endoftext|> a <|startoftext|>b", "ΣΑΣ İstanbul ﬁ Ⅷ ²", "'S DON'T x", "a" * 700, "<|endoftext|>" * 3]
    for _ in range(400):
        chars = [chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0x370, 0x3000)])) if rng.random() < 0.7 else " " for _ in range(rng.randrange(40))]
        some.append("".join(c for c in chars if unicodedata.category(c) not in ("Cn", "Cs")))
    return some


def test_codec_equals_library(library):
    codec = bpe.Codec(open(bpe.default_vocabulary(), "rb").read())
    for text in texts():
        ids = codec.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(ids).cast("I")) == want, text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_words_are_remembered_in_two_generations(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    codec = bpe.Codec(open(bpe.default_vocabulary(), "rb").read())
    for text in texts()[:80]:
        ids = list(memoryview(codec.encode(text)).cast("I"))
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_query(spark, sf_dir, library):
    rows = {r.doc_id: r for r in bpe.op9_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert rows[d.doc_id][1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_null_empty_long_and_back(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word, " * 30_000), (3, "word, " * 30_000)], "doc_id int, text string")
    path = bpe.default_vocabulary()
    out = df.select("doc_id", bpe.tokens(spark, df.text, path).alias("t"))
    out = out.select("doc_id", "t.n_tokens", "t.decoded", bpe.decoded(spark, out["t.ids"], path).alias("again")).orderBy("doc_id").collect()
    assert [r.n_tokens for r in out] == [0, 0, 60_000, 60_000]
    assert all(r.decoded == r.again for r in out)
    assert bpe.tokens(spark, df.text, path) is not None and df.limit(0).select(bpe.tokens(spark, df.text, path)).count() == 0
