"""Legacy web archives: ARC files to WARC records, and back out again.

``read_arc`` parses the version block that opens an ARC file and then URL records by the field names
of that version and their declared lengths: version 1 lines are ``URL IP-address Archive-date
Content-type Archive-length``, version 2 lines put ``Result-code Checksum Location Offset Filename``
before the length. ``convert`` synthesises the WARC side: record ids from the page's number, ISO
dates from 14-digit ones, record types, SHA-256 payload digests, and revisits of equal payloads of
at least 100 bytes. Archives are written as rows of bounded size in the shared folder, so that Spark
writes and reads them like any table.

Edge cases: a null html is an empty payload; null or blank urls become ``urn:page:<id>`` and spaces in
urls are percent-encoded; page ids may be numbers or strings, of which those that aren't numbers come
before numbers; records of null ids have no X-Page-Id and come first among equals; rows
that repeat the smallest id of a payload are all responses; a truncated record or a wrong length
raises ValueError; an empty table gives no archive and an empty result; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinspark.shared import table

REVISIT_BYTES = 100
ARCHIVE_BYTES = 4 << 20  #: an archive is closed when it has this many
FILTER_BITS = 25  #: of a digest; the filter of repeated digests has 2^25 bits, 4 MB
# fixed values of the formats
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write_arc(version: int, pages: list[tuple[object, str | None, bytes]]) -> bytes:
    """An ARC file of (page_id, url, html) with a version block; the page id stands in the address query of no url, but in an HTTP header."""
    fields = V1 if version == 1 else V2
    block = f"{version} 0 twinspark\n{fields}\n".encode()
    out = [b"filedesc://pages.arc 0.0.0.0 20240101000000 text/plain " + (b"" if version == 1 else b"200 - - 0 pages.arc ") + b"%d\n" % len(block), block, b"\n"]
    at = sum(map(len, out))
    for page_id, url, html in pages:
        url = (url or "").strip() or f"urn:page:{page_id}"
        url = "".join(c if not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        named = b"" if page_id is None else b"X-Page-Id: %s\r\n" % str(page_id).encode()
        body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%bContent-Length: %d\r\n\r\n" % (named, len(html)) + html
        second = (page_id if isinstance(page_id, int) else zlib.crc32((page_id or "").encode())) % 86400
        date = f"20240102{second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}"
        more = "" if version == 1 else f"200 {hashlib.md5(html).hexdigest()} - {at} pages.arc "
        out += [f"{url} 0.0.0.0 {date} text/html {more}{len(body)}\n".encode(), body, b"\n"]
        at += sum(map(len, out[-3:]))
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, body) of the URL records after the version block."""
    fields, at = V1.split(" "), 0
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("ARC header line without an end")
        line = data[at:end].decode().split(" ")
        first = at == 0
        try:
            n = int(line[-1])
        except ValueError as e:
            raise ValueError(f"ARC header line without a length: {line}") from e
        body = data[end + 1 : end + 1 + n]
        if len(body) != n or n < 0:
            raise ValueError("ARC record shorter than declared")
        at = end + 1 + n
        if data[at : at + 1] == b"\n":
            at += 1
        if first:
            version, names = body.split(b"\n")[:2]
            fields = names.decode().split(" ")
            if version.split(b" ")[0] not in (b"1", b"2") or fields != (V1 if version[:1] == b"1" else V2).split(" "):
                raise ValueError("unknown ARC version")
            continue
        if len(line) != len(fields):
            raise ValueError(f"ARC header line of {len(line)} fields, not {len(fields)}")
        yield dict(zip(fields, line, strict=True)), body


def http_parts(body: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (lower-case names), header block and payload of a stored response."""
    head, _, payload = body.partition(b"\r\n\r\n")
    lines = [x.decode().partition(":") for x in head.split(b"\r\n")[1:]]
    return {k.lower(): v.strip() for k, _, v in lines}, head + b"\r\n\r\n", payload


def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page' if page_id is None else 'page:' + page_id)}>"


def warc_record(arc: dict[str, str], body: bytes, revisit: bool = False, refers_to: str | None = None) -> bytes:
    """The WARC record of an ARC record; ``refers_to``: the page whose equal payload it revisits, if it does."""
    headers, head, payload = http_parts(body)
    date = arc["Archive-date"]
    block = head if revisit else body
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Target-URI", arc["URL"]),
        ("WARC-Date", f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"),
        ("WARC-Record-ID", record_id(headers.get("x-page-id"))),
        ("WARC-IP-Address", arc["IP-address"]),
        ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest()),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))] + ([("X-Refers-To-Page", refers_to)] if refers_to is not None else [])
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n" + block + b"\r\n\r\n"


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError("not a WARC record")
        lines = [x.decode().partition(": ") for x in data[at:end].split(b"\r\n")[1:]]
        headers = {k: v for k, _, v in lines}
        n = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + n]
        if len(block) != n or data[end + 4 + n : end + 8 + n] != b"\r\n\r\n":
            raise ValueError("WARC record shorter than declared")
        at = end + 8 + n
        yield headers, block


def arcs(pages: DataFrame) -> DataFrame:
    """(arc binary): ``pages`` (page_id, url, html) as ARC files of either version in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1
        for b in batches:
            held, size = [], 0
            for row in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                held.append((row[0], row[1], row[2] or b""))
                size += len(held[-1][2]) + 300
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([write_arc(version, held)], pa.binary())], ["arc"])
                    held, size, version = [], 0, 3 - version
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([write_arc(version, held)], pa.binary())], ["arc"])
                version = 3 - version

    return pages.select("page_id", "url", F.col("html").cast("binary").alias("html")).mapInArrow(run, "arc binary")


def _repeated(digests: DataFrame) -> np.ndarray:
    """A bit for each value of the first ``FILTER_BITS`` bits of the digests: 4 MB, whatever their number."""
    bit = F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - FILTER_BITS)
    parts = digests.groupBy(F.shiftright(bit, 15).alias("part")).agg(F.bitmap_construct_agg(bit.bitwiseAND(32767)).alias("bits"))
    out = np.zeros((1 << FILTER_BITS - 15, 4096), np.uint8)
    for r in parts.collect():
        out[r.part] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _packed(written: Iterator[bytes], most: int) -> Iterator[pa.RecordBatch]:
    """Records as archives, each closed when it has ``most`` bytes."""
    out, size = [], 0
    for record in written:
        out.append(record)
        size += len(record)
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["warc"])
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["warc"])


def convert(archive: DataFrame) -> DataFrame:
    """(arc) to (warc): the records of ARC files as WARC archives, equal payloads as revisits of the smallest page id.

    Digests and ids are grouped first, copies combined before they move. A record whose payload is short or whose digest
    isn't in the filter of repeated ones (4 MB) is written in the task that reads it. The others meet the first page
    of their digest: rows of a page's size, so that the join can be split where a page is very common.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = [(h.get("x-page-id"), hashlib.sha256(p).digest()) for _, body in read_arc(data) for h, _, p in [http_parts(body)] if len(p) >= REVISIT_BYTES]
                pages, digests = zip(*rows, strict=True) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(pages, pa.string()), pa.array(digests, pa.binary())], ["page", "digest"])

    number = F.col("page").try_cast("long")
    firsts = archive.select("arc").mapInArrow(index, "page string, digest binary").groupBy("digest").agg(F.min(F.struct(number.alias("number"), F.col("page").alias("ref"))).alias("first"), F.count("*").alias("times"))
    firsts = table(firsts.where("times > 1").select("digest", "first.ref"), "firsts")
    filter_ = archive.sparkSession.sparkContext.broadcast(_repeated(firsts))

    def told(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None, bytes | None]]:
        """(fields, body, page, digest) of the records of an ARC file; no digest if the payload can't be another's."""
        for arc, body in read_arc(data):
            h, _, p = http_parts(body)
            digest = hashlib.sha256(p).digest() if len(p) >= REVISIT_BYTES else None
            if digest:
                at = int.from_bytes(digest[:4], "big") >> 32 - FILTER_BITS
                digest = digest if filter_.value[at >> 3] >> (at & 7) & 1 else None
            yield arc, body, h.get("x-page-id"), digest

    def straight(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed((warc_record(arc, body) for b in batches for data in b.column(0).to_pylist() for arc, body, _, digest in told(data) if not digest), ARCHIVE_BYTES)

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = [(page, digest, arc["URL"], arc["IP-address"], arc["Archive-date"], body) for arc, body, page, digest in told(data) if digest]
                cols = list(zip(*rows, strict=True)) or [()] * 6
                kinds = [pa.string(), pa.binary(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page", "digest", "url", "ip", "date", "body"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield from _packed((warc_record({"URL": url, "IP-address": ip, "Archive-date": date}, body, revisit, ref) for url, ip, date, body, revisit, ref in rows), ARCHIVE_BYTES)

    rows = archive.select("arc").mapInArrow(take_out, "page string, digest binary, url string, ip string, date string, body binary")
    rows = rows.join(firsts.withColumn("again", F.lit(True)).hint("shuffle_hash"), "digest", "left")
    revisit = F.coalesce("again", F.lit(False)) & ~F.col("page").eqNullSafe(F.col("ref"))
    rows = rows.select("url", "ip", "date", "body", revisit.alias("revisit"), "ref").mapInArrow(write, "warc binary")
    return archive.select("arc").mapInArrow(straight, "warc binary").union(rows)


def records(archive: DataFrame) -> DataFrame:
    """(warc) to a row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, date, record_id."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "date", "record_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                rows = []
                for h, block in read_warc(data):
                    http, _, payload = http_parts(block)
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                    if h["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
                        raise ValueError("payload does not have its digest")
                    rows.append((http.get("x-page-id"), int(http["content-length"]), digest, h["WARC-Type"], h.get("X-Refers-To-Page"), h["WARC-Target-URI"], h["WARC-Date"], h["WARC-Record-ID"]))
                cols = list(zip(*rows, strict=True)) or [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if name == "payload_bytes" else pa.string()) for c, name in zip(cols, names, strict=True)], names)

    return archive.mapInArrow(run, ", ".join(f"{x} {'long' if x == 'payload_bytes' else 'string'}" for x in names))


def op10(spark, sf_dir: str) -> DataFrame:
    from twinspark.llm.common import read

    warcs = table(convert(table(arcs(read(spark, sf_dir, "pages")), "arc")), "warc")
    number = lambda c: F.col(c).cast("long").alias(c)
    return records(warcs).select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first < d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 100
"""
