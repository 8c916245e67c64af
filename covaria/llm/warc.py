"""WARC archives with revisit records: duplicates by payload digest point to their original response."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, shared_folder
from .common import spread_join, table
from .registry import query

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Files are closed after this many records.
FILE_RECORDS = 20_000
READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary"
)


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: each 20 bits of the digest are four letters."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(records: DataFrame, order: str, min_bytes: int = 0) -> DataFrame:
    """Add record_type, and refers_to / refers_uri / refers_date of the original for revisits.

    `records`: target_uri, warc_date, payload (binary), and the column `order`.
    Of the records with one payload digest that with the smallest `order` is
    the response, the others revisit it.  Payloads under `min_bytes`, payloads
    that occur once and records without `order` stay responses; records that
    tie for the smallest are all responses.  Null payloads count as empty.

    Only digests and headers are aggregated; a payload travels once.
    """
    rows = records.withColumn("payload", F.coalesce("payload", F.lit(b"")))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": payload_digest(F.col("payload"))})
    heads = rows.filter(F.col(order).isNotNull() & (F.col("payload_bytes") >= min_bytes))
    heads = heads.select("payload_digest", order, "target_uri", "warc_date")
    first = heads.groupBy("payload_digest").agg(
        F.min(F.struct(F.col(order).alias("_o"), F.col("target_uri").alias("_u"), F.col("warc_date").alias("_d"))).alias("_first"),
        F.count(F.lit(1)).alias("_n"),
    )
    first = cut_lineage(first.filter("_n > 1"))
    total = first.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    found = spread_join(rows, first, ["payload_digest"], "_n", total, [order, "target_uri"])
    again = (F.col("_first._o") < F.col(order)) & (F.col("payload_bytes") >= min_bytes)
    return found.withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"),
        "refers_to": F.when(again, F.col("_first._o")),
        "refers_uri": F.when(again, F.col("_first._u")),
        "refers_date": F.when(again, F.col("_first._d")),
    }).drop("_first", "_n")


def _field(name: str, value: Column) -> Column:
    """A header line; control characters and blanks of the value are escaped, null values give no line."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def record_id(order: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), order.cast("string"), F.lit(">"))


def write_archives(resolved: DataFrame, order: str, path: str) -> None:
    """Write records with fresh headers as gzipped WARC 1.1 files of a bounded number of records.

    A revisit carries the HTTP header only; its payload is that of the record
    that it refers to.  Spark's text writer does the writing, with the two
    line ends that close a record as its separator.
    """
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", record_id(F.col(order))),
        _field("WARC-Target-URI", F.col("target_uri")),
        _field("WARC-Date", F.col("warc_date")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to")))),
        _field("WARC-Refers-To-Target-URI", F.col("refers_uri")),
        _field("WARC-Refers-To-Date", F.col("refers_date")),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"),
        _field("Content-Length", length), F.lit(CRLF),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    out = resolved.select(F.concat(head, http, body).alias("value"))
    out.write.option("compression", "gzip").option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(stream: io.BufferedIOBase, source: str, payload: bool = True) -> Iterator[tuple]:
    """Records of one archive; the payload's length and digest are taken from its bytes, for revisits from the headers."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{source}: no WARC record at {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head.get("content-length", 0))
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"{source}: record {head.get('warc-record-id')} is cut short")
        kind, body, length = head.get("warc-type"), block, size
        if "application/http" in head.get("content-type", ""):
            http, _, body = block.partition(b"\r\n\r\n")
            fields = dict(x.lower().split(b":", 1) for x in http.split(b"\r\n")[1:] if b":" in x)
            length = len(body)
            if kind == "revisit":
                length = int(fields.get(b"content-length", 0))
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind != "revisit":
            real = base64.b32encode(hashlib.sha1(body).digest()).decode()
            if digest and digest != real:
                raise ValueError(f"{source}: record {head.get('warc-record-id')} does not match its digest")
            digest = real
        yield (
            head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-date"), digest or None, length,
            head.get("warc-refers-to"), body if payload and kind != "revisit" else None,
        )


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the WARC files below `path`, gzipped or plain.

    A file is one row for Spark and unpacked record by record; files of up to
    about a gigabyte are meant.  Cut or damaged records raise an error.
    """
    names = [f.split()[0] for f in READ_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        for b in batches:
            for source, content in zip(b.column(0), b.column(1)):
                raw = io.BytesIO(content.as_buffer())
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if raw.read(2) == b"\x1f\x8b" else raw
                raw.seek(0)
                rows, held = [], 0
                for r in parse(stream, source.as_py(), payload):
                    rows.append(r)
                    held += len(r[-1] or b"") + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, READ_SCHEMA)


def _number(column: str) -> Column:
    return F.regexp_extract(column, r"^<urn:record:(-?\d+)>$", 1)


BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n{i // 4} >> {5 * (3 - i % 4)}) & 31)::int, 1)" for i in range(32)
)
OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
d AS (SELECT *, {', '.join(f"('0x' || substr(h, {5 * k + 1}, 5))::bigint AS n{k}" for k in range(8))} FROM h),
g AS (SELECT page_id, payload_bytes, {BASE32_SQL} AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to FROM f
"""


@query("op1_warc_revisits", OP1_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(
        "page_id", F.col("url").alias("target_uri"), F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    path = f"{shared_folder(spark)}/warc"
    write_archives(resolve(pages, "page_id"), "page_id", path)
    return read_archives(spark, path, payload=False).select(
        _number("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", _number("refers_to").cast("long")).alias("refers_to"),
    )
