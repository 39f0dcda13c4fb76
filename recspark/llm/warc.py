"""WARC archives and revisit resolution (operator 1).

``write_responses`` turns pages into response records.  ``resolve_revisits``
reads archives, shuffles the record headers by payload digest, picks one
original for each digest and writes new archives with fresh headers: originals
keep their payload, every other copy becomes a revisit record that refers to
its original.  ``resolved_records`` reads archives back and joins revisits to
the responses they refer to.

A WARC record ends with two line ends, so Spark's text sink with that line
separator writes archives (gzip) on any file system; reading parses whole
records by their Content-Length.  Payloads travel by record id, which is
unique, never by digest: a payload that a third of all records share stays on
one original.

Defined cases: null payload is empty; a null page id writes no id field and is
the smallest when an original is chosen; equal (digest, page id) copies are
told apart by record id; a digest with revisits only keeps them as they are;
payloads shorter than ``min_payload`` bytes all stay responses; empty input
gives archives without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import scratch_path
from .common import saved, table

END = "\r\n\r\n"
#: Profile of a revisit with an identical payload (fixed value of the format).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD = "X-Page-Id"

_HEAD = StructType([StructField(n, t) for n, t in (
    ("record_id", StringType()), ("page_id", LongType()), ("record_type", StringType()),
    ("uri", StringType()), ("date", StringType()), ("payload_digest", StringType()),
    ("payload_bytes", LongType()), ("refers_to_id", StringType()))])
_FULL = StructType([*_HEAD.fields, StructField("payload", BinaryType())])


# ---------------------------------------------------------------- writing

def _base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: five bytes (ten hex digits) make eight letters."""
    hexa = F.sha1(payload)
    part = [F.lpad(F.conv(F.substring(hexa, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends in a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record(kind: str, record_id: Column, page_id: Column, uri: Column, date: Column, digest: Column,
            payload: Column | None, payload_bytes: Column, extra: Column) -> Column:
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    payload_bytes.cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + (payload_bytes if payload is not None else F.lit(0))
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"), _field("WARC-Record-ID", record_id),
        _field("WARC-Date", date), _field("WARC-Target-URI", uri), _field(PAGE_FIELD, page_id),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), extra,
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _field("Content-Length", length), F.lit("\r\n"))
    return F.concat(head, http, payload.cast("string")) if payload is not None else F.concat(head, http)


def _write(records: DataFrame, path: str, records_per_file: int) -> None:
    (records.write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def write_responses(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                    payload_col: str = "html", date: str = "2024-01-01T00:00:00Z",
                    records_per_file: int = 20_000) -> None:
    """One response record for each page, as the crawl would have written it."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = (pages.withColumn("_n", F.monotonically_increasing_id())
            .select(F.col(id_col).cast("long").alias("page_id"), F.col(uri_col).alias("uri"),
                    payload.alias("payload"), "_n"))
    _write(rows.select(_record(
        "response", _urn(F.col("page_id"), F.col("uri"), F.col("_n")), F.col("page_id"), F.col("uri"),
        F.lit(date), _base32_sha1(F.col("payload")), F.col("payload"),
        F.octet_length("payload").cast("long"), F.lit("")).alias("value")), path, records_per_file)


# ---------------------------------------------------------------- reading

def _records(content: bytes):
    """(fields, block) of every record of one archive, plain or gzip of any number of members."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    f = io.BufferedReader(f, 1 << 20)
    while True:
        line = f.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"not a WARC record: {line[:60]!r}")
            continue
        fields = {}
        while (line := f.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = f.read(size)
        if len(block) != size:
            raise ValueError("record is cut short")
        yield fields, block


def _parser(with_payload: bool):
    schema = _FULL if with_payload else _HEAD
    names = [x.name for x in schema.fields]
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def flush(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], types.get(n, pa.string())) for k, n in enumerate(names)], names=names)

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in _records(content.as_py()):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if payload is not None:
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    page = fields.get(PAGE_FIELD.lower())
                    row = [fields.get("warc-record-id"), int(page) if page else None, kind,
                           fields.get("warc-target-uri"), fields.get("warc-date"), digest,
                           None if payload is None else len(payload), fields.get("warc-refers-to")]
                    if with_payload:
                        row.append(payload)
                        held += len(payload or b"")
                    rows.append(row)
                    if len(rows) >= 1000 or held >= 8 << 20:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)
    return parse, schema


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Response and revisit records of the archives under ``path``.

    An archive file is one row of bytes for one task, so writers bound their
    files (``records_per_file`` and the size of a partition).
    """
    parse, schema = _parser(with_payload)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, schema)


# ---------------------------------------------------------------- revisit resolution

def resolve_revisits(spark: SparkSession, path: str, out: str, min_payload: int = 0,
                     records_per_file: int = 20_000) -> None:
    """Write archives in which each payload of at least ``min_payload`` bytes is stored once."""
    heads = saved(read_records(spark, path), "warc-heads")
    large = (F.col("record_type") == "response") & (F.col("payload_bytes") >= min_payload)
    best = F.max(F.struct(F.col("page_id"), F.col("record_id"), F.col("uri"), F.col("date"),
                          F.col("payload_bytes")))
    originals = heads.where(large).groupBy("payload_digest").agg(best.alias("o"))
    fresh = _urn(F.lit("fresh"), F.col("record_id"))

    whole = heads.where((F.col("record_type") == "response") & ~large).select("record_id")
    kept = originals.select(F.col("o.record_id").alias("record_id")).unionByName(whole)
    responses = (read_records(spark, path, with_payload=True).where(F.col("record_type") == "response")
                 .join(kept, "record_id", "left_semi")
                 .select(_record("response", fresh, F.col("page_id"), F.col("uri"), F.col("date"),
                                 F.col("payload_digest"), F.col("payload"), F.col("payload_bytes"),
                                 F.lit("")).alias("value")))

    copies = (heads.where(large | (F.col("record_type") == "revisit"))
              .join(originals, "payload_digest", "left")
              .where(~F.coalesce(F.col("record_id") == F.col("o.record_id"), F.lit(False))))
    refers = F.coalesce(_urn_or_null(F.col("o.record_id")), F.col("refers_to_id"))
    extra = F.concat(_field("WARC-Profile", F.lit(PROFILE)), _field("WARC-Refers-To", refers),
                     _field("WARC-Refers-To-Target-URI", F.col("o.uri")),
                     _field("WARC-Refers-To-Date", F.col("o.date")))
    revisits = copies.select(_record("revisit", fresh, F.col("page_id"), F.col("uri"), F.col("date"),
                                     F.col("payload_digest"), None,
                                     F.coalesce(F.col("o.payload_bytes"), F.lit(0)), extra).alias("value"))
    _write(responses.unionByName(revisits), out, records_per_file)


def _urn_or_null(old_id: Column) -> Column:
    return F.when(old_id.isNotNull(), _urn(F.lit("fresh"), old_id))


def resolved_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record with the full payload's size and digest; revisits carry their response's page id."""
    heads = saved(read_records(spark, path), "warc-resolved")
    responses = heads.where(F.col("record_type") == "response")
    target = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                              F.col("payload_bytes").alias("_bytes"))
    revisits = (heads.where(F.col("record_type") == "revisit").drop("payload_bytes")
                .join(target, "refers_to_id", "left"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (responses.withColumn("refers_to", F.lit(None).cast("long")).select(cols)
            .unionByName(revisits.withColumnRenamed("_bytes", "payload_bytes").select(cols)))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, resolve revisits, and read the deduplicated archives back."""
    crawl, out = scratch_path(spark, "warc-crawl"), scratch_path(spark, "warc-dedup")
    write_responses(table(spark, sf_dir, "pages"), crawl)
    resolve_revisits(spark, crawl, out, min_payload=0)
    return resolved_records(spark, out)


QUERIES = {"op1_warc": op1_warc}
SQL = {"op1_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p
), b AS (
  SELECT page_id, payload_bytes, list_aggregate([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT
                        >> (35 - 5 * (i % 8))) & 31)::INT, 1)
           FOR i IN range(32)], 'string_agg', '') AS payload_digest
  FROM d
), o AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM b
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM o
"""}
