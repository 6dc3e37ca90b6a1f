"""Legacy ARC archives converted to WARC, with identical payloads written as revisits.

``write_arc`` writes pages as ARC files, version 1 and 2 by turns (the legacy input).
``parse_arc`` reads them by the version block, the field line it holds and each
record's declared length.  ``convert`` makes a WARC record of each: identifier,
timestamp, type and payload digest are synthesised from what the ARC header has.
``mark_revisits`` turns all but the first of equal payloads into revisit records,
``write_warc`` writes real WARC files and ``read_warc`` parses them back.

Archives are written by Spark's text sink (a record per row, the record separator as
line separator), so they go wherever Spark writes and lost tasks leave nothing
behind.  An archive holds what one task reads (``spark.sql.files.maxPartitionBytes``).
Null html is an empty payload; null url becomes ``about:blank``; a row without
page_id is always a response and never referred to.  Repeated rows give a record
each.  A record cut short by the end of its file is kept and marked truncated.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shared_path, shuffle_cleanup, stored

# Fixed values of the two ARC versions: the field line of a record header.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_DATE = 1577836800  # 2020-01-01, the crawl's begin; a page's date is its id in seconds later
_MB8 = 8 << 20

RECORDS = (
    "page_id long, kind string, target_uri string, ip string, warc_date string, "
    "content_type string, truncated boolean, head binary, payload binary, "
    "payload_bytes long, payload_digest string"
)
_RECORDS_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("kind", pa.string()),
        ("target_uri", pa.string()),
        ("ip", pa.string()),
        ("warc_date", pa.string()),
        ("content_type", pa.string()),
        ("truncated", pa.bool_()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- the legacy side ----------------------------------------------------------


def _arc_record(version: int, url: str, date: str, mime: str, body: bytes, offset: int, name: str):
    if version == 1:
        fields = f"{url} 0.0.0.0 {date} {mime} {len(body)}"
    else:
        checksum = hashlib.md5(body).hexdigest()
        fields = f"{url} 0.0.0.0 {date} {mime} 200 {checksum} - {offset} {name} {len(body)}"
    return fields.encode() + b"\n" + body


def _version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n".encode() + body


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    version, name = 1 + part % 2, f"pages-{part:06d}.arc"
    opening, offset = True, 0
    for batch in batches:
        rows, size = [], 0
        if opening:
            rows.append(_version_block(version, name, "20200101000000"))
            offset, opening = len(rows[0]) + 1, False
        for page, url, date, html in zip(
            *(batch.column(c).to_pylist() for c in ("page_id", "url", "date", "html"))
        ):
            payload = (html or "").encode()
            head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            head += f"X-Page-Id: {page}\r\n" if page is not None else ""
            head += f"Content-Length: {len(payload)}\r\n\r\n"
            body = head.encode() + payload
            # a header line has neither blanks nor line ends inside a field
            clean = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
            rows.append(_arc_record(version, clean, date, "text/html", body, offset, name))
            offset += len(rows[-1]) + 1
            size += len(rows[-1])
            if size > _MB8:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files of ``pages`` (page_id, url, html), one per task, gzip-compressed."""
    second = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)) + FIRST_DATE
    date = F.date_format(F.timestamp_seconds(second), "yyyyMMddHHmmss")
    records = pages.select("page_id", "url", date.alias("date"), "html").mapInArrow(
        _to_arc, "value binary"
    )
    # a cast of bytes to string leaves them as they are; records are separated by a line end
    records.select(F.col("value").cast("string")).write.option("compression", "gzip").text(path)


def open_archive(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 18)


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records of one ARC file: fields by name, ``body``, ``truncated``; the version block too."""
    archive = open_archive(content)
    fields = ARC_FIELDS[1].split()  # the version block itself has the five fields of version 1
    while line := archive.readline():
        line = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not line:
            continue
        opening = line.startswith("filedesc://")
        names = ARC_FIELDS[1].split() if opening else fields
        values = line.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC record header: {line[:200]!r}")
        record = dict(zip(names, values))
        length = int(values[-1])
        body = archive.read(length)
        if opening:
            said = body.decode("utf-8", "replace").split("\n")
            version = int(said[0].split(" ")[0])
            fields = said[1].split() if len(said) > 1 and said[1].startswith("URL") else (
                ARC_FIELDS[version].split()
            )
        yield record | {"opening": opening, "body": body, "truncated": len(body) < length}


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; no head if the body does not begin with one."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    end = body.find(b"\r\n\r\n")
    return (body, b"") if end < 0 else (body[: end + 4], body[end + 4 :])


def head_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def _iso(date: str) -> str:
    d = (date + "00000101000000"[len(date) :]) if len(date) < 14 else date
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_fields(record: dict) -> tuple:
    """The row of RECORDS that is equivalent to an ARC record."""
    head, payload = split_http(record["body"])
    uri = record["URL"]
    kind = "warcinfo" if record["opening"] else "response" if head else "resource"
    page = head_field(head, "X-Page-Id")
    return (
        int(page) if page else None,
        kind,
        uri,
        record["IP-address"],
        _iso(record["Archive-date"]),
        record["Content-type"],
        record["truncated"],
        head,
        payload,
        len(payload),
        sha1_base32(payload),
    )


def _rows_in_batches(rows: Iterator[tuple], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size > _MB8 or len(held) >= 4096:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for content in batch.column("content"):
            yield content.as_py()


def _from_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (warc_fields(r) for content in _archives(batches) for r in parse_arc(content))
    yield from _rows_in_batches(rows, _RECORDS_ARROW, lambda r: len(r[8]))


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def convert(spark: SparkSession, path: str) -> DataFrame:
    """Equivalent WARC records of all ARC files under ``path``."""
    return binary_files(spark, path).mapInArrow(_from_arc, RECORDS)


# ---- the WARC side --------------------------------------------------------------


def mark_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds record_type and refers_to: of equal payloads the smallest page_id is the response.

    The minimum per payload is combined before the shuffle and only payloads that occur
    more than once are kept, so the join's right side is small and its left side can
    be split where one payload holds much of the input.
    """
    spark = records.sparkSession
    key = ["payload_digest", "payload_bytes"]
    pages = records.filter((F.col("kind") == "response") & F.col("page_id").isNotNull())
    first = (
        pages.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(*key)
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    first = stored(spark, first, "warc-first")
    again = (
        (F.col("kind") == "response")
        & F.col("first_page").isNotNull()
        & F.col("page_id").isNotNull()
        & (F.col("page_id") != F.col("first_page"))
    )
    return (
        records.join(first, key, "left")
        .withColumn("record_type", F.when(again, F.lit("revisit")).otherwise(F.col("kind")))
        .withColumn("refers_to", F.when(again, F.col("first_page")))
        .drop("first_page")
    )


def record_id(page_id: str) -> F.Column:
    """urn:uuid whose first half is the page id: unique, repeatable, and readable back."""
    half = F.lpad(F.lower(F.hex(page_id)), 16, "0")
    rest = F.lpad(F.substring(F.sha1(F.concat(F.lit("page"), half)), 1, 16), 16, "0")
    whole = F.concat(half, rest)
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws(
            "-", *(F.substring(whole, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        ),
        F.lit(">"),
    )


def _header(name: str, value) -> F.Column:
    """The header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC 1.1 files of marked records; a revisit keeps its HTTP head only."""
    revisit = F.col("record_type") == "revisit"
    info = F.col("record_type") == "warcinfo"
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    other_id = F.sha1(F.concat_ws(" ", "record_type", "target_uri", "warc_date", "payload_digest"))
    own_id = F.coalesce(
        record_id("page_id"),
        F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.substring(other_id, 1, 32), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">")),
    )
    kind = F.when(info, F.lit("application/warc-fields")).when(
        F.octet_length("head") > 0, F.lit("application/http; msgtype=response")
    ).otherwise(F.col("content_type"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", own_id),
        _header("WARC-Target-URI", F.when(~info, F.col("target_uri"))),
        _header("WARC-Filename", F.when(info, F.col("target_uri"))),
        _header("WARC-Date", F.col("warc_date")),
        _header("WARC-IP-Address", F.col("ip")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Truncated", F.when(F.col("truncated"), F.lit("length"))),
        _header("WARC-Refers-To", record_id("refers_to")),
        _header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        _header("Content-Type", kind),
        _header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    lines = records.withColumn("block", block).select(
        F.concat(header.cast("binary"), F.col("block")).cast("string").alias("value")
    )
    lines.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of one WARC file."""
    archive = open_archive(content)
    while line := archive.readline():
        line = line.strip()
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        fields = {}
        while (line := archive.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, archive.read(int(fields["content-length"]))


_READ_ARROW = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
        ("target_uri", pa.string()),
        ("warc_date", pa.string()),
        ("payload_digest", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
    ]
)
READ = (
    "record_type string, record_id string, refers_to_id string, target_uri string, "
    "warc_date string, payload_digest string, page_id long, payload_bytes long"
)


def _read_fields(fields: dict[str, str], block: bytes) -> tuple:
    head, payload = split_http(block)
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":  # the payload stands in another record; the HTTP head tells its size
        size = int(head_field(head, "Content-Length") or 0)
    elif digest and sha1_base32(payload) != digest:
        raise ValueError(f"payload digest of {fields.get('warc-record-id')} does not hold")
    page = head_field(head, "X-Page-Id")
    return (
        kind,
        fields.get("warc-record-id"),
        fields.get("warc-refers-to"),
        fields.get("warc-target-uri"),
        fields.get("warc-date"),
        digest,
        int(page) if page else None,
        size,
    )


def _from_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (_read_fields(*r) for content in _archives(batches) for r in parse_warc(content))
    yield from _rows_in_batches(rows, _READ_ARROW, lambda r: 200)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Header facts of all records of the WARC files under ``path``; payload digests are verified."""
    return binary_files(spark, path).mapInArrow(_from_warc, READ)


def page_of(record_id_column: str) -> F.Column:
    """The page id in an identifier that ``record_id`` made."""
    half = F.substring(F.regexp_replace(record_id_column, "urn:uuid:|[^0-9a-f]", ""), 1, 16)
    return F.conv(half, 16, -10).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: pages as ARC files, converted to WARC with revisits, and read back."""
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    with shuffle_cleanup(spark):
        write_arc(read(spark, sf_dir, "pages"), arc)
        write_warc(mark_revisits(convert(spark, arc), min_bytes=0), warc)
    back = read_warc(spark, warc).filter("record_type in ('response', 'revisit')")
    return back.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to_id").alias("refers_to"),
    )


# base32 digit k of a SHA-1 holds its bits 5k .. 5k+4; ``h`` is the digest in hex digits
SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) || '0' AS h FROM pages
), d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(((((instr('0123456789abcdef', substr(h, CAST(5 * k // 4 AS INTEGER) + 1, 1)) - 1) * 16
             + instr('0123456789abcdef', substr(h, CAST(5 * k // 4 AS INTEGER) + 2, 1)) - 1)
             >> CAST(3 - (5 * k) % 4 AS INTEGER)) & 31) AS INTEGER), 1) for k in range(0, 32)], '') AS payload_digest
  FROM p
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_page FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
FROM m
"""
