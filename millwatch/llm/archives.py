"""Legacy archive converter: ARC files in, equivalent WARC files out, and a reader of both.

An ARC file opens with a version block whose last line but one names the fields of a
record's header line; a record is that line, then as many bytes as the line declares.
The converter synthesises what WARC asks for and ARC lacks: record ids, ISO time stamps,
record types and payload digests. Records with equal payloads become one response and
revisits of it. Files are written by Spark's text writer (a record is one row, the
separator follows from the format) with gzip, so any file system that Spark knows will do;
they are read as binary files of bounded size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm.common import BROADCAST_IDS, arrow_map, written
from millwatch.session import scratch_path

# Header fields of the two ARC versions (fixed by the format).
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length"],
}
ARC_DATE = "20200101000000"
# An archive file aims at this many bytes of payload, since its reader holds one file.
FILE_BYTES = 4 << 20
MIN_PAYLOAD = 0


def gunzip(content: bytes) -> bytes:
    """A compressed archive's bytes; plain archives pass."""
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_url(url: str | None) -> str:
    """A URL that fits a space-separated header line; "-" for none."""
    return re.sub(r"[\s\x00-\x20\x7f]", lambda m: f"%{ord(m[0]) & 0xFF:02X}", url or "") or "-"


def http_block(page_id: int | None, payload: bytes) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"{head}{own}Content-Length: {len(payload)}\r\n\r\n".encode() + payload


def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n".encode()
    fields = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Content-type": "text/plain", "Result-code": "200"}
    return arc_line(fields, len(body), version) + b"\n" + body


def arc_line(fields: dict[str, str], length: int, version: int) -> bytes:
    values = {"Archive-date": ARC_DATE, **fields, "Archive-length": str(length)}
    return " ".join(values.get(f, "-") for f in ARC_FIELDS[version]).encode()


def parse_arc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record, by the version the file declares.

    Lengths are trusted only inside the file: a record that runs over its end, or a header
    line with the wrong number of fields, raises ValueError.
    """
    if not content:  # the file of a task without rows
        return
    end = content.index(b"\n")
    length = int(content[:end].rsplit(b" ", 1)[1])
    version_line, field_line = content[end + 1 : end + 1 + length].split(b"\n")[:2]
    version = int(version_line.split(b" ")[0])
    names = field_line.decode().split(" ")
    if names != ARC_FIELDS.get(version):
        raise ValueError(f"unknown ARC version or fields: {version} {names}")
    at = end + 1 + length
    while True:
        while content[at : at + 1] == b"\n":
            at += 1
        if at >= len(content):
            return
        end = content.index(b"\n", at)
        values = content[at:end].decode().split(" ")
        if len(values) != len(names):
            raise ValueError(f"ARC header line has {len(values)} fields, not {len(names)}")
        fields = dict(zip(names, values, strict=True))
        at, stop = end + 1, end + 1 + int(fields["Archive-length"])
        if stop > len(content):
            raise ValueError("ARC record is longer than its file")
        yield fields, content[at:stop]
        at = stop


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}, payload


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def iso_date(stamp: str) -> str:
    s = stamp.ljust(14, "0")
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def warc_record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block


def warc_from(row: dict) -> bytes:
    """A response, or a revisit that keeps the HTTP header and leaves out the payload."""
    digest, keep = row["payload_digest"], row["keep_id"]
    revisit = row["is_revisit"]
    block = row["block"]
    if revisit:
        block = block[: len(block) - row["payload_bytes"]]
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], digest)),
        ("WARC-Date", iso_date(row["date"])),
        ("WARC-Target-URI", None if row["url"] == "-" else row["url"]),
        ("WARC-IP-Address", None if row["ip"] == "-" else row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", record_id(keep, digest) if revisit else None),
        ("WARC-Refers-To-Date", iso_date(row["date"]) if revisit else None),
        ("X-Refers-To-Page-Id", keep if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return warc_record(headers, block)


def warc_info(name: str) -> bytes:
    block = b"software: archive converter\r\nformat: WARC File Format 1.1\r\n"
    headers = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", iso_date(ARC_DATE)),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ]
    return warc_record(headers, block)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        if not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        at, stop = end + 4, end + 4 + int(headers["Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("WARC record does not end where its length says")
        yield headers, content[at:stop]
        at = stop + 4



def _text_rows(df: DataFrame, make, first, label: str) -> DataFrame:
    """Rows as archive records, after each task's opening record."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                rows = batch.slice(start, 200).to_pylist()
                values = [make(r) for r in rows]
                if not opened:
                    values.insert(0, first(f"{label}-{TaskContext.get().partitionId():05d}"))
                    opened = True
                yield pa.RecordBatch.from_pydict({"value": values}, pa.schema([("value", pa.binary())]))

    # The records are UTF-8: headers are, and payloads come from strings. No byte changes here.
    return arrow_map(df, work, "value binary").select(F.col("value").cast("string"))


def _dealt(df: DataFrame, total_bytes: int) -> DataFrame:
    """Round robin by rows into files of about FILE_BYTES, whatever keys the rows have."""
    return df.repartition(max(1, -(-total_bytes // FILE_BYTES)))


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """``pages`` (page_id, url, html) as ARC files under ``path``; null html is an empty payload."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )

    def make(row: dict) -> bytes:
        block = http_block(row["page_id"], row["payload"])
        fields = {"URL": safe_url(row["url"]), "IP-address": "0.0.0.0", "Content-type": "text/html", "Result-code": "200"}
        return arc_line(fields, len(block), version) + b"\n" + block

    size = rows.agg(F.sum(F.length("payload") + 200)).first()[0] or 0
    lines = _text_rows(_dealt(rows, size), make, lambda name: arc_version_block(name, version), "arc")
    lines.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def _parsed(spark: SparkSession, path: str, work, ddl: str) -> DataFrame:
    return arrow_map(_files(spark, path).select("content"), work, ddl)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files: page_id, url, ip, date, payload_bytes, payload_digest, block."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse_arc(gunzip(content.as_py())):
                    head, payload = split_http(block)
                    page = head.get("x-page-id")
                    rows.append(
                        {"page_id": None if page is None else int(page), "url": fields["URL"], "ip": fields["IP-address"],
                         "date": fields["Archive-date"], "payload_bytes": len(payload),
                         "payload_digest": payload_digest(payload), "block": block}
                    )
                    if len(rows) >= 200:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    ddl = "page_id bigint, url string, ip string, date string, payload_bytes bigint, payload_digest string, block binary"
    return _parsed(spark, path, work, ddl)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_payload: int = MIN_PAYLOAD) -> None:
    """ARC files to WARC files. Of equal payloads of at least ``min_payload`` bytes the record
    of the largest page id is the response, the others revisit it; null ids are smallest, and
    rows that repeat the largest id are all responses.

    Only groups of two or more enter the join that tells revisits from responses. Up to a
    counted size they are broadcast, so that payloads are not shuffled; beyond it the join
    shuffles on the digest, and adaptive execution splits its hot groups.
    """
    records = read_arc(spark, arc_path)
    narrow = records.select("page_id", "payload_bytes", "payload_digest").filter(F.col("payload_bytes") >= min_payload)
    groups = narrow.groupBy(F.col("payload_digest").alias("of")).agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n"))
    groups = written(groups.filter("n > 1").drop("n"), "equal-payloads")
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_IDS else groups.hint("merge")
    typed = records.join(
        groups,
        (F.col("payload_digest") == F.col("of")) & (F.col("payload_bytes") >= min_payload), "left",
    ).drop("of")
    is_revisit = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    typed = typed.withColumn("is_revisit", is_revisit)
    # A file for each ARC file, or for each part of the join.
    lines = _text_rows(typed, warc_from, warc_info, "warc")
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to, payload.

    A response's digest is computed anew and must equal its header; a revisit has no payload.
    """
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for headers, block in parse_warc(gunzip(content.as_py())):
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
                    page, refers = head.get("x-page-id"), headers.get("X-Refers-To-Page-Id")
                    rows.append(
                        {"page_id": None if page is None else int(page), "payload_bytes": int(head["content-length"]),
                         "payload_digest": digest, "record_type": kind,
                         "refers_to": None if refers is None else int(refers),
                         "payload": payload if kind == "response" else None}
                    )
                    if len(rows) >= 200:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    ddl = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return _parsed(spark, path, work, ddl)


def archive_pages(pages: DataFrame, version: int = 1) -> DataFrame:
    """Pages written as ARC, converted to WARC, and read back; an empty table gives no records."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, version)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
