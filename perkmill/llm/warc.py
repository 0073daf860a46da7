"""Web archives: pages written as WARC records, read back, and an index of captures in global order.

Writing takes Spark expressions and its text writer only: a record ends with two line breaks, so these
are the writer's line separator, and the files are committed like any table's, in any store Spark
writes to. A payload that several pages share is written once, as the response record of the largest
page_id; the others become revisit records that refer to it and carry its digest and length.

Each file read back is a run of captures sorted by URL key and time. The index is an external merge:
runs are cut at the same keys into ranges, and each range's pieces are merged by a loser tree. A URL
with a large part of all captures is cut by time like the rest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perkmill.functions.lineage import cut, new_folder

from .common import exact_text, read, ready_for_python

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Bytes of a file's payloads: about, and at most (if no single page has more). Rows of an index range, about.
FILE_BYTES, MOST_BYTES, RANGE_ROWS = 32 << 20, 1 << 29, 20_000
#: Pages have no capture time; a page is captured its page_id's seconds after this one (2024-01-01).
FIRST_CAPTURE = 1_704_067_200
END = "\r\n\r\n"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hex string of 40 digits: 5 digits are 4 letters."""

    def letters(i: Column) -> Column:
        bits = F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        part = lambda k: F.substring(F.lit(BASE32), (F.shiftright(bits, k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
        return F.concat(part(15), part(10), part(5), part(0))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def with_types(pages: DataFrame) -> tuple[DataFrame, dict]:
    """`pages` (page_id, url, payload, key) with `refers_to` and `revisit`, and sums over the payloads.

    Only keys that several rows share are joined back. Of rows that share a page_id too, any single one
    is the response; a null page_id is the smallest.
    """
    ids = pages.groupBy("key", "page_id").agg(F.count(F.lit(1)).alias("n"), F.first(F.octet_length("payload").cast("bigint")).alias("bytes"))
    ids = cut(ids)
    sums = ids.agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("bytes")).alias("bytes"), F.max("bytes").alias("most")).first().asDict()
    best = F.max_by("n", F.coalesce("page_id", F.lit(-(2**63))))
    shared = cut(ids.groupBy("key").agg(F.max("page_id").alias("top"), F.sum("n").alias("all"), best.alias("at_top")).filter(F.col("all") > 1))
    joined = pages.join(shared.drop("all"), "key", "left")
    is_top = F.col("at_top").isNull() | F.col("page_id").eqNullSafe(F.col("top"))
    columns = ["page_id", "url", "payload"]
    out = joined.filter(~is_top | F.coalesce(F.col("at_top") == 1, F.lit(True)))
    out = out.select(*columns, (~is_top).alias("revisit"), F.when(~is_top, F.col("top")).alias("refers_to"))
    tied = shared.filter(F.col("at_top") > 1)
    if not tied.isEmpty():
        rows = pages.join(tied.select("key", "top"), "key").filter(F.col("page_id").eqNullSafe(F.col("top")))
        rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
        first = rows.groupBy("key").agg(F.min("row").alias("first"))
        again = F.col("row") != F.col("first")
        out = out.unionByName(rows.join(first, "key").select(*columns, again.alias("revisit"), F.when(again, F.col("top")).alias("refers_to")))
    return out, sums


def record(payload: Column, url: Column, page_id: Column, revisit: Column, refers_to: Column, captured: Column) -> Column:
    """A record without the two line breaks that end it."""
    line = lambda *x: F.concat(*[F.lit(c) if isinstance(c, str) else c for c in x], F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    safe = F.replace(F.replace(exact_text(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(line("HTTP/1.1 200 OK"), line("Content-Type: text/html; charset=utf-8"), line("Content-Length: ", F.octet_length(payload).cast("string")), F.lit("\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(payload))
    return F.concat(
        line("WARC/1.1"),
        line("WARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID: ", urn(page_id)),
        line("WARC-Target-URI: ", safe),
        line("WARC-Date: ", captured),
        line("WARC-Payload-Digest: sha1:", base32_of_hex(F.sha1(payload))),
        F.when(revisit, F.concat(line("WARC-Refers-To: ", urn(refers_to)), line("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        line("Content-Type: application/http; msgtype=response"),
        line("Content-Length: ", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> int:
    """Writes a record for each row and returns their number. Null html is an empty payload."""
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), exact_text(html).alias("payload"))
    rows, sums = with_types(rows.withColumn("key", F.sha2("payload", 256)))
    n = sums["rows"] or 0
    per_file = max(1, min(FILE_BYTES * n // max(1, sums["bytes"] or 0), MOST_BYTES // max(1, sums["most"] or 0)))
    seconds = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0)))
    captured = F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    value = record(F.col("payload"), F.col("url"), F.col("page_id"), F.col("revisit"), F.col("refers_to"), captured)
    writer = rows.select(value.alias("value")).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", int(min(per_file, 2**31 - 1))).text(path)
    return n


def url_key(url: str) -> str:
    """The host's names from the last to the first, then path and query; lower case, without www."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def records(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an open archive, by their lengths."""
    while True:
        version = stream.readline()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record where one should start: {version[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            head[name.lower()] = value
        block = stream.read(int(head["content-length"]))
        stream.readline(), stream.readline()
        http, _, payload = block.partition(END.encode())
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        of = lambda name, head=head: int(v) if (v := head.get(name, "").removeprefix("<urn:page:").removesuffix(">")) else None
        revisit = head["warc-type"] == "revisit"
        found = head["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and (digest(payload) != found or len(payload) != length):
            raise ValueError(f"payload of {head['warc-record-id']} isn't what was written")
        yield {
            "page_id": of("warc-record-id"),
            "url_key": url_key(head["warc-target-uri"]),
            "captured": head["warc-date"],
            "payload_bytes": length,
            "payload_digest": found,
            "record_type": head["warc-type"],
            "refers_to": of("warc-refers-to") if revisit else None,
        }


CAPTURE = "page_id bigint, url_key string, captured string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
RUN = pa.schema(
    [("page_id", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.int64()), ("run", pa.string())]
)


def order(capture: dict) -> tuple:
    return capture["url_key"], capture["captured"], capture["page_id"] is not None, capture["page_id"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Captures of the archives in a folder; each file is a `run`, its captures in order."""
    ready_for_python(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as f:
                    found = sorted(records(io.BufferedReader(f, 1 << 20)), key=order)
                yield pa.RecordBatch.from_pylist([r | {"run": name} for r in found], RUN)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, f"{CAPTURE}, run string")


class LoserTree:
    """The smallest head of k sorted runs: inner nodes hold the losers of their matches, so a new head
    plays only the matches on its way up."""

    def __init__(self, runs: list[Iterator[dict]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        k = len(runs)
        self.tree = [-1] * k
        winners = [-1] * k + list(range(k))
        for i in range(k - 1, 0, -1):
            a, b = winners[2 * i], winners[2 * i + 1]
            winners[i], self.tree[i] = (a, b) if self.before(a, b) else (b, a)
        self.top = winners[1] if k > 1 else 0

    def before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (order(x), a) < (order(y), b)

    def __iter__(self) -> Iterator[dict]:
        while self.runs and (head := self.heads[self.top]) is not None:
            yield head
            winner = self.top
            self.heads[winner] = next(self.runs[winner], None)
            i = (winner + len(self.runs)) // 2
            while i:
                if self.before(self.tree[i], winner):
                    self.tree[i], winner = winner, self.tree[i]
                i //= 2
            self.top = winner


def merged_index(runs: DataFrame, rows: int) -> DataFrame:
    """The captures with `index_part` and `index_row`: their order by these is that by URL key, time and
    page. Of each run a range gets a sorted piece."""
    ready_for_python(runs.sparkSession)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[dict]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                pieces.setdefault(r["run"], []).append(r)
        # Shuffling keeps a run's order but where its rows were fetched in several parts; sorting what's
        # sorted already costs one pass.
        tree = LoserTree([iter(sorted(pieces.pop(name), key=order)) for name in sorted(pieces)])
        part, out, n = TaskContext.get().partitionId(), [], 0
        for r in tree:
            del r["run"]
            out.append(r | {"index_part": part, "index_row": n})
            n += 1
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, INDEXED)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, INDEXED)

    ranges = max(1, math.ceil(rows / RANGE_ROWS))
    keys = ["url_key", "captured", "page_id"]
    return runs.repartitionByRange(ranges, *keys).mapInArrow(merge, f"{CAPTURE}, index_part int, index_row bigint")


INDEXED = pa.schema([*[f for f in RUN if f.name != "run"], pa.field("index_part", pa.int32()), pa.field("index_row", pa.int64())])


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes `pages` to archives in the shared folder and returns the index of what they hold, with
    each capture's `position` in the order of all (from 1)."""
    path = new_folder(spark)
    rows = write_archives(pages, path)
    index = cut(merged_index(cut(read_archives(spark, path)), rows))
    # A row for each range: their sizes add up to where each begins.
    sizes = index.groupBy("index_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("index_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("index_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    position = (F.col("start") + F.col("index_row") + 1).cast("bigint")
    return index.join(starts, "index_part").withColumn("position", position).drop("start")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an archive holds it, with its place in the captures' order."""
    return archived(spark, read(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position"
    )


# For pages with distinct page_ids and URLs with a scheme.
OP10_SQL = f"""
with payloads as (
  select page_id, coalesce(url, '') as url, coalesce(html, '') as payload,
         max(page_id) over (partition by coalesce(html, '')) as top
  from pages),
parts as (
  select *, sha1(payload) as digest,
         list_reverse(string_split(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\\.', ''), '.')) as host,
         regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) as query
  from payloads),
named as (
  select *, lower(array_to_string(host, ',') || ')' || case when path = '' then '/' else path end
                  || case when query = '' then '' else '?' || query end) as url_key,
         strftime(make_timestamp(({FIRST_CAPTURE} + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as captured
  from parts)
select page_id, cast(octet_length(encode(payload)) as bigint) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1 + (
         (cast('0x' || substr(digest, 1 + 5 * cast(floor(i / 4) as int), 5) as int) >> cast(15 - 5 * (i % 4) as int)) & 31), 1)), '') as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id = top then null else top end as refers_to,
       url_key, captured, row_number() over (order by url_key, captured, page_id) as position
from named"""
