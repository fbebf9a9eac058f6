"""WARC archives: writing, reading back, and revisit resolution.

Archives are written by Spark's text writer: every row is one whole record and the line
separator is the blank lines that end a record, so each (gzip) part file is a valid
WARC file, committed like any Spark output and written to any store Spark writes to.
Files hold at most ``RECORDS_PER_FILE`` records. They are read back as binary files and
parsed by ``Content-Length`` while they are unpacked, one record at a time.

Resolution (``resolve``): the headers of the raw archives (page, payload digest, record
id, uri) are grouped by digest; of equal payloads the record with the largest page stays
a response and the others become revisit records that name it. Only the digests that
occur more than once are joined back to the records: by broadcast when that table's
measured size is small, else by a shuffle on the digest. The deduplicated archives get
fresh headers and record ids.

Cases: null html is an empty payload; a null url is written as an empty target; control
characters and spaces in a url are percent-encoded in the header; a null ``page_id`` is a
page like any other and loses against any number; rows that repeat page and payload: one
of them (the smallest record number) is the response, the others refer to its page; an
empty table gives archives without records; further columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import broadcast_if_small, staged, table

RECORDS_PER_FILE = 2000
MIN_BYTES = 0           # payloads below this are never revisited
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

RECORD = "page_id bigint, url string, record_id string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, refers_id string"


def safe_uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_text(fields: dict[str, str | None], http: str, body: str) -> str:
    """One record without its closing blank lines."""
    block = len(http.encode()) + len(body.encode())
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {block}"]
    return "\r\n".join(lines) + END + http + body


def make_record(page_id: int | None, url: str | None, html: str, kind: str, digest: str, size: int, record_id: str,
                refers_to: int | None = None, refers_id: str | None = None) -> str:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}{END}"
    fields = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": DATE, "WARC-Target-URI": safe_uri(url),
        "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Profile": PROFILE if kind == "revisit" else None,
        "WARC-Refers-To": f"<urn:uuid:{refers_id}>" if refers_id else None,
        "Content-Type": "application/http; msgtype=response", "X-Page-ID": None if page_id is None else str(page_id),
        "X-Refers-To-Page-ID": None if refers_to is None else str(refers_to)}
    return record_text(fields, http, "" if kind == "revisit" else html)


def new_id() -> str:
    return str(uuid.uuid4())


def write_archives(records: DataFrame, path: str) -> str:
    """A one-column frame of record texts as gzip WARC files."""
    (records.write.option("lineSep", END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    return path


def unpacked(content: bytes) -> io.BufferedReader:
    """A stream over a gzip file (of one or more members)."""

    class Members(io.RawIOBase):
        def __init__(self):
            self.left, self.z, self.ready = memoryview(content), zlib.decompressobj(31), b""

        def readable(self):
            return True

        def readinto(self, out):
            while not self.ready:
                if self.z.eof:
                    self.left, self.z = memoryview(self.z.unused_data + bytes(self.left)), zlib.decompressobj(31)
                if not len(self.left):
                    return 0
                piece, self.left = self.left[:1 << 16], self.left[1 << 16:]
                self.ready = self.z.decompress(piece)
            n = min(len(out), len(self.ready))
            out[:n], self.ready = self.ready[:n], self.ready[n:]
            return n

    return io.BufferedReader(Members(), 1 << 16)


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    stream = unpacked(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("the archive ends inside a record")
        yield fields, block


def bare_id(field: str | None) -> str | None:
    return field[len("<urn:uuid:"):-1] if field else None


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the archives: header columns (RECORD) and, on request, the payload.
    Payload size and digest are taken from the payload itself where the record has one."""
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64() if " bigint" in p else pa.binary() if " binary" in p else pa.string() for p in schema.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for fields, block in parse_archive(content.as_py()):
                    http, _, body = block.partition(b"\r\n\r\n")
                    kind = fields["warc-type"]
                    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), len(body)
                    if kind == "response":
                        if payload_digest(body) != digest:
                            raise ValueError(f"payload digest of {fields['warc-record-id']} doesn't hold")
                    else:
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    ref, page = fields.get("x-refers-to-page-id"), fields.get("x-page-id")
                    rows.append((None if page is None else int(page), fields["warc-target-uri"], bare_id(fields["warc-record-id"]), kind,
                                 digest, size, None if ref is None else int(ref), bare_id(fields.get("warc-refers-to")),
                                 *([body] if with_payload else [])))
                    held += len(body)
                    if len(rows) >= 1000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, schema)


def archive_pages(pages: DataFrame, path: str) -> str:
    """Write every page as a response record."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256).to_pylist()
                out = []
                for r in rows:
                    html = r["html"] or ""
                    payload = html.encode()
                    out.append(make_record(r["page_id"], r["url"], html, "response", payload_digest(payload), len(payload), new_id()))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    return write_archives(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(build, "value string"), path)


def repeated_payloads(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per digest that occurs more than once: the record that stays a response."""
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "record_id")
    groups = headers.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest") \
        .agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("first"))
    return groups.filter("n > 1").select(F.col("payload_digest").alias("first_digest"), F.col("first.page_id").alias("first_page"),
                                         F.col("first.record_id").alias("first_id"))


def resolve(spark: SparkSession, raw: str, path: str, min_bytes: int = MIN_BYTES) -> str:
    """Deduplicate the archives under ``raw`` into fresh archives under ``path``."""
    headers = staged(read_archives(spark, raw, with_payload=False).select("page_id", "record_id", "payload_digest", "payload_bytes"), "warc-headers")
    firsts = broadcast_if_small(staged(repeated_payloads(headers, min_bytes), "warc-firsts"))
    records = read_archives(spark, raw).join(firsts, F.col("payload_digest") == F.col("first_digest"), "left")
    kind = F.when((F.col("first_id") != F.col("record_id")) & (F.col("payload_bytes") >= min_bytes), "revisit").otherwise("response")
    records = records.withColumn("kind", kind).select(
        "page_id", "url", "record_id", "payload_digest", "payload_bytes", "kind", F.col("payload").cast("string").alias("html"),
        F.when(F.col("kind") == "revisit", F.col("first_page")).alias("first_page"),
        F.when(F.col("kind") == "revisit", F.col("first_id")).alias("first_id"))

    def fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the new id follows from the old one, so a revisit can name its response before that is written
        renewed = lambda old: old and str(uuid.uuid5(uuid.NAMESPACE_URL, f"deduplicated:{old}"))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = [make_record(r["page_id"], r["url"], r["html"], r["kind"], r["payload_digest"], r["payload_bytes"],
                                   renewed(r["record_id"]), r["first_page"], renewed(r["first_id"]))
                       for r in batch.slice(start, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    return write_archives(records.mapInArrow(fresh, "value string"), path)


def op8_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "llm-warc-raw"))
    done = resolve(spark, raw, scratch_path(spark, "llm-warc"))
    return read_archives(spark, done, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base 32 by five-byte groups: 40 hex digits are 32 letters of 5 bits.
ORACLE = """
WITH p AS (
  SELECT row_number() OVER () AS i, page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT i, page_id, strlen(html) AS payload_bytes, list_aggregate(list_transform(range(32), lambda k:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((
             ('0x' || sha1(html)[(k // 8) * 10 + 1 : (k // 8) * 10 + 10])::BIGINT >> (35 - 5 * (k % 8))::BIGINT) & 31)::INT + 1]), 'string_agg', '') AS payload_digest
  FROM p),
w AS (
  SELECT *, first_value(i) OVER g AS first_i, first_value(page_id) OVER g AS first_page
  FROM d WINDOW g AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, i))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN i = first_i THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN i <> first_i THEN first_page END AS refers_to
FROM w
"""
