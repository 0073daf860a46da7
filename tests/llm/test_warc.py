import base64
import gzip
import hashlib
import io
import random

import duckdb

from perkmill.functions.lineage import shared_folder
from perkmill.llm import warc


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) of rows with distinct page_ids."""
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        other = top[h or ""] if top[h or ""] != i else None
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if other is None else "revisit", other))
    return sorted(out)


def summary(rows):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


def test_query(spark, sf_dir):
    got = warc.op10_warc(spark, sf_dir).collect()
    assert summary(got) == brute([tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()])
    keys = [(r.url_key, r.captured, r.page_id) for r in sorted(got, key=lambda r: r.position)]
    assert keys == sorted(keys) and [r.position for r in sorted(got, key=lambda r: r.position)] == list(range(1, len(got) + 1))


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    answer = con.execute(warc.OP10_SQL)
    names = [d[0] for d in answer.description]
    got = warc.op10_warc(spark, sf_dir)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, answer.fetchall())) == sorted(str(tuple(r)) for r in got.select(names).collect())


def test_copies_many_files_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 400)
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    rng = random.Random(1)
    # A third of all pages has one payload, and a third one URL.
    rows = [(i, "http://a.b/hot" if i % 3 == 0 else f"http://www.{rng.choice('cd')}.b/{i % 7}?x={i % 2}", "same" if i % 3 == 1 else f"p{i % 50}\r\n\r\nWARC/1.1\r\n") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = warc.archived(spark, df).collect()
    assert summary(got) == brute(rows)
    keys = [(r.url_key, r.captured, r.page_id) for r in sorted(got, key=lambda r: (r.index_part, r.index_row))]
    assert keys == sorted(keys) and len({r.index_part for r in got}) > 5


def test_edge_rows(spark):
    rows = [(1, "http://a.b/c?d=1", "x\r\n\r\ny"), (2, None, None), (3, "u\r\nv", ""), (4, "http://[bad", "é𝔘\n"), (5, "http://www.A.b", "é𝔘\n")]
    rows += [(5, "http://www.A.b", "é𝔘\n"), (None, "x", "é𝔘\n"), (6, "http://a.b/", "z" * 3_000_000)]
    df = spark.createDataFrame([(i, u, h, "k", 1) for i, u, h in rows], "page_id long, url string, html string, key string, payload int")
    got = warc.archived(spark, df).collect()
    by = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=lambda r: (r[0] is not None, r))
    assert by == [(None, "revisit", 5), (1, "response", None), (2, "revisit", 3), (3, "response", None), (4, "revisit", 5), (5, "response", None), (5, "revisit", 5), (6, "response", None)]
    assert {r.payload_bytes for r in got if r.page_id == 6} == {3_000_000}
    assert warc.archived(spark, df.limit(0)).count() == 0


def test_files_are_archives(spark):
    path = f"{shared_folder(spark)}/archives-test"
    df = spark.createDataFrame([(1, "http://a.b/", "one"), (2, "http://a.b/", "one")], "page_id long, url string, html string")
    assert warc.write_archives(df.coalesce(1), path) == 2
    raw = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    found = {r["page_id"]: r for r in warc.records(io.BytesIO(raw))}
    assert found[2]["record_type"] == "response" and found[1]["refers_to"] == 2
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 7, 8, 20):
        runs = [sorted(({"url_key": str(rng.randrange(5)), "captured": "", "page_id": rng.choice([None, rng.randrange(9)])} for _ in range(rng.randrange(9))), key=warc.order) for _ in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert list(map(warc.order, merged)) == sorted(warc.order(x) for r in runs for x in r)
