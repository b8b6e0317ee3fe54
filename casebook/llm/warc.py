"""WARC archives: write pages as records, resolve revisits, write them anew, read back.

Archives are written by Spark's own text writer, one record a row with the record
terminator as line separator, so a lost executor's attempt is never committed, and on
any file system Spark reaches. They are read as binary files and cut by each record's
``Content-Length``, so payloads may hold anything, record-like text included.

Resolution shuffles headers only: the digests' first responses are a partially
aggregated minimum, and revisit records are joined to them. Payloads meet their
resolution by (file, ordinal), which no group of copies can make uneven.

Defined results: a null html is an empty payload; payloads under ``MIN_PAYLOAD`` bytes
are always responses; null page ids come last among equals; of rows that repeat the
smallest page id the first read is the response and the others revisit it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.common import stage
from casebook.session import checkpoint_dir

MIN_PAYLOAD = 100
RECORDS_PER_FILE = 10_000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"  # ends the header block, and a record
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(*parts: Column) -> Column:
    """A urn from a digest of the parts."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, n), F.lit("-" if a < 21 else ">"))])


def _field(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null. Line breaks can't leave the line."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))


def _http(n_bytes: Column) -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes.cast("string"), F.lit(END))


def record_text(kind: Column, record_id: Column, page_id: Column, url: Column, digest: Column, n_bytes: Column, payload: Column, refers_to: Column) -> Column:
    """One record without its terminator. A revisit's block ends after the HTTP header."""
    http = _http(n_bytes)
    revisit = kind == "revisit"
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.octet_length(payload))
    return F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", kind), _field("WARC-Record-ID", record_id), _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", url), _field("Page-Id", page_id), F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _field("WARC-Refers-To", F.when(revisit, refers_to)),
        _field("Content-Length", length), F.lit("\r\n"), http, F.when(revisit, F.lit("")).otherwise(payload))


def write_archive(records: DataFrame, path: str) -> None:
    """``records``: one column of record texts."""
    (records.write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


class _Inflated:
    """A compressed file's bytes, a little at a time."""

    def __init__(self, content: bytes):
        self.rest, self.held, self.zip = memoryview(content), bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        if not len(self.rest):
            return False
        self.held += self.zip.decompress(self.rest[:1 << 18])
        self.rest = self.rest[1 << 18:]
        while self.zip.eof and (self.zip.unused_data or len(self.rest)):  # several members
            left = self.zip.unused_data
            if not left and not len(self.rest):
                break
            self.zip = zlib.decompressobj(31)
            if left:
                self.held += self.zip.decompress(left)
            else:
                break
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        got = bytes(self.held[:n])
        del self.held[:n]
        return got


def parse(content: bytes):
    """(header fields, payload) of each record."""
    end = END.encode()
    data = _Inflated(content)
    while (head := data.until(end)) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)
        block = data.take(int(fields["Content-Length"]))
        data.take(len(end))
        yield fields, block[block.index(end) + len(end):]


HEADERS = "file string, ordinal long, record_id string, kind string, page_id long, url string, refers_to string, stated_digest string, payload_bytes long, payload_digest string"


def read_archive(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """One row per record; digest and size are those of the bytes read."""
    schema = HEADERS + (", payload string" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64()}[c.split()[1]] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                name, rows, held = file.as_py().rsplit("/", 1)[-1], [], 0
                for k, (f, payload) in enumerate(parse(content.as_buffer())):
                    page = f.get("Page-Id")
                    row = (name, k, f["WARC-Record-ID"], f["WARC-Type"], None if page is None else int(page), f.get("WARC-Target-URI"), f.get("WARC-Refers-To"),
                           f["WARC-Payload-Digest"].removeprefix("sha256:"), len(payload), hashlib.sha256(payload).hexdigest())
                    rows.append((*row, payload.decode()) if payloads else row)
                    held += len(payload) if payloads else 0
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def resolve_revisits(headers: DataFrame) -> DataFrame:
    """``file, ordinal, kind_, refers_id_``: the first record of each digest (of payloads
    long enough) is the response, the others revisit it."""
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "file", "ordinal", "record_id")
    first = headers.where(F.col("payload_bytes") >= MIN_PAYLOAD).groupBy("payload_digest").agg(F.min(order).alias("first_"), F.count(F.lit(1)).alias("n_")).where("n_ > 1")
    is_first = (F.col("first_.file") == F.col("file")) & (F.col("first_.ordinal") == F.col("ordinal"))
    joined = headers.where(F.col("payload_bytes") >= MIN_PAYLOAD).join(first, "payload_digest").where(~is_first)
    return joined.select("file", "ordinal", F.col("first_.file").alias("first_file"), F.col("first_.ordinal").alias("first_ordinal"))


def deduplicate(spark: SparkSession, raw: str, out: str) -> None:
    """Rewrite the archive at ``raw`` with revisits resolved and fresh headers."""
    revisits = resolve_revisits(stage(read_archive(spark, raw, payloads=False), "warc-headers"))
    records = read_archive(spark, raw, payloads=True).join(revisits, ["file", "ordinal"], "left")
    kind = F.when(F.col("first_file").isNotNull(), "revisit").otherwise("response")
    text = record_text(kind, _record_id(F.col("file"), F.col("ordinal")), F.col("page_id"), F.col("url"), F.col("payload_digest"),
                       F.col("payload_bytes"), F.col("payload"), _record_id(F.col("first_file"), F.col("first_ordinal")))
    write_archive(records.select(text.alias("value")), out)


def archive_pages(pages: DataFrame) -> str:
    """Write a response record per row; returns the archive's folder."""
    html = F.coalesce(F.col("html"), F.lit(""))
    digest = F.sha2(html.cast("binary"), 256)
    path = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    text = record_text(F.lit("response"), _record_id(F.col("page_id"), F.col("url"), digest), F.col("page_id"), F.col("url"), digest, F.octet_length(html), html, F.lit(None).cast("string"))
    write_archive(pages.select("page_id", "url", "html").select(text.alias("value")), path)
    return path


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages, deduplicate, read back: one row per record, revisits joined to
    their response."""
    spark = pages.sparkSession
    raw = archive_pages(pages)
    out = raw + "-dedup"
    deduplicate(spark, raw, out)
    back = stage(read_archive(spark, out, payloads=False), "warc-back")
    responses = back.where("kind = 'response'")
    keep = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = responses.select(F.col("record_id").alias("first_id"), F.col("page_id").alias("first_page"), F.col("payload_bytes").alias("first_bytes"))
    revisits = back.where("kind = 'revisit'").select("page_id", "refers_to", "stated_digest").join(first, F.col("refers_to") == F.col("first_id"))
    return (responses.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select("page_id", F.col("first_bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest"),
                                         F.lit("revisit").alias("record_type"), F.col("first_page").alias("refers_to")).select(*keep)))


# Pages beyond the tables' own columns are ignored; this is the same answer in SQL.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
                  row_number() OVER same AS place, first_value(page_id) OVER same AS first_id
           FROM p WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_id END AS refers_to
FROM q
"""
