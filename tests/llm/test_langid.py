import math
import zlib

import numpy as np

from perkmill.llm import langid


def test_gradients_equal_differences():
    net = langid.Net(["a", "b", "c"], widths=(2, 3), filters=3, size=2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rng = np.random.default_rng(1)
    windows = rng.integers(1, 200, (4, 12)).astype(np.uint8)
    target = np.array([0, 1, 2, 1])

    def loss():
        return -np.log(net.forward(windows)[np.arange(4), target]).mean()

    g = net.gradients(windows, target)
    for name, w in net.w.items():
        for at in zip(*[rng.integers(0, s, 6) for s in w.shape], strict=True):
            if name == "embed":
                at = (int(windows[0, 3]), at[1])
            was = w[at]
            w[at] = was + 1e-6
            up = loss()
            w[at] = was - 1e-6
            down = loss()
            w[at] = was
            assert abs((up - down) / 2e-6 - g[name][at]) < 1e-4, name


def test_windows_cover_whole_texts():
    for n in (0, 1, langid.WINDOW, langid.WINDOW + 1, 5 * langid.WINDOW - 1):
        raw = b"x" * n
        assert langid.cut_windows(raw).tobytes().rstrip(b"\0") == raw


def test_query_on_held_out_documents(spark, sf_dir):
    rows = langid.op1_langid(spark, sf_dir).collect()
    docs = {d.doc_id: d for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) >= 0.9


def test_nothing_known_about_a_text_but_itself(spark):
    rows = [(i, "the cat and the dog " * 5 if i % 2 else "der hund und die katze " * 5, "en" if i % 2 else "de", 1) for i in range(60)]
    rows += [(None, "the cat", "en", 1), (61, "le chat", None, 1)]
    net = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, p int"))
    assert net.langs == ["de", "en"]
    asked = spark.createDataFrame([(1, None), (2, ""), (3, "12 $$ !"), (4, "the dog and the cat"), (4, "the dog and the cat"), (5, "der hund " * 20_000)], "doc_id int, text string")
    got = asked.select("doc_id", langid.predicted(spark, net, asked.text).alias("p")).orderBy("doc_id").collect()
    assert [r.p.lang_pred for r in got] == ["und", "und", "und", "en", "en", "de"]
    assert [r.p.score for r in got[:3]] == [0.0] * 3 and got[3].p.score == got[4].p.score


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.train(docs) is None and langid.train(docs.limit(0)) is None
    assert docs.select(langid.predicted(spark, None, docs.text).alias("p")).first().p == ("und", 0.0)


def plain_score(net, text):
    """Prediction and score of one text, one window, filter and place at a time."""
    raw = text.encode()
    total = [0.0] * len(net.langs)
    for at in range(0, max(len(raw), 1), langid.WINDOW):
        window = raw[at : at + langid.WINDOW].lower()
        padded = [*window, *[0] * (langid.WINDOW - len(window))]
        hidden = []
        for k in net.widths:
            for f in range(net.filters):
                best = -math.inf
                for p in range(langid.WINDOW - k + 1):
                    x = [float(v) for b in padded[p : p + k] for v in net.w["embed"][b]]
                    best = max(best, sum(a * float(b) for a, b in zip(x, net.w[f"conv{k}"][:, f], strict=True)))
                hidden.append(max(0.0, best + float(net.w[f"bias{k}"][f])))
        z = [sum(h * float(w) for h, w in zip(hidden, net.w["out"][:, j], strict=True)) + float(net.w["out_bias"][j]) for j in range(len(net.langs))]
        e = [math.exp(v - max(z)) for v in z]
        for j, v in enumerate(e):
            total[j] += v / sum(e) * sum(b != 0 for b in window)
    best = max(range(len(total)), key=lambda j: total[j])
    return net.langs[best], total[best] / sum(total)


def test_scores_equal_a_plain_forward_pass():
    net = langid.Net(["a", "b", "c"], widths=(2, 3), filters=4, size=3)
    texts = ["short", "Ünïcode ТЕКСТ", "x" * 300 + " and MORE " * 30, "q"]
    got = list(langid._scored(net, texts))
    for text, (lang, score) in zip(texts, got, strict=True):
        want, value = plain_score(net, text)
        assert lang == want and abs(score - value) < 1e-4


def test_many_values_of_the_language_column(spark, monkeypatch):
    """The most frequent languages are learned; a language whose first texts have no letters is, too."""
    monkeypatch.setattr(langid, "MOST_LANGS", 2)
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 5)
    rows = [(i, "the cat and the dog", "en") for i in range(60)] + [(100 + i, "12 34" if i < 90 else "der hund", "de") for i in range(120)]
    rows += [(300 + i, f"word {i}", f"dirt{i}") for i in range(20)]
    net = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert net.langs == ["de", "en"]
