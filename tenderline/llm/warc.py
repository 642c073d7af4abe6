"""WARC archives: one gzip member for each record, and a reader that salvages what damage has left."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderline.llm.shared import new_path

#: Fixed values of the format.
VERSION = b"WARC/1.1"
MARK = b"WARC/1."
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A gzip member of no bytes, which stands between members where Spark's text writer ends a line.
NOTHING = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
REVISIT_FROM = 1000
STEP = 1 << 16


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit without payload where it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", "".join(c for c in url or "" if c >= " ")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")] if refers_to is not None else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + END


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _members(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256).to_pylist()
                out = [member(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    return run


def write_archives(pages: DataFrame, date: str = "2020-01-01T00:00:00Z") -> str:
    """Writes a record for each row (page_id, url, html) and returns the folder of the archives.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at least REVISIT_FROM bytes
    the one with the largest page_id is the response and the others revisit it (rows that repeat that id are
    responses too, and so are rows with a null id); smaller payloads are all responses. Written by Spark's text
    writer: its commit protocol leaves whole files only, whatever executors are lost, on any store that Spark writes to."""
    folder = new_path(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= REVISIT_FROM)
    several = large.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("k")).where("k > 1").select("digest", "first")
    rows = rows.join(several, "digest", "left").withColumn("refers_to", F.expr("if(page_id <> first, first, null)"))
    members = rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(_members(date), "member binary")
    # The writer puts the bytes of a string as they are, and the line end in the encoding named.
    members.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", NOTHING.decode("latin-1")).text(folder)
    return folder


@dataclass
class Part:
    """A record, or the gap of bytes `offset` to `offset + length` that no record was found in."""

    offset: int
    length: int
    reason: str = ""
    fields: dict[str, str] = field(default_factory=dict)
    payload_bytes: int | None = None
    payload: bytes | None = None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if v}


def parse(data: bytes, at: int) -> Part | str:
    """The record whose version line is at `at`, or what is wrong with it."""
    if not data.startswith(MARK, at):
        return "no version line"
    stop = data.find(END, at)
    if stop < 0:
        return "header has no end"
    fields = _fields(data[at:stop])
    size = fields.get("content-length", "")
    if not size.isdecimal():
        return "no content length"
    begin, end = stop + 4, stop + 4 + int(size)
    if data[end : end + 4] != END:
        return "block has another length"
    part = Part(at, end + 4 - at, "", fields)
    if fields.get("warc-type") in ("response", "revisit"):
        head = data.find(END, begin, end)
        if head < 0:
            return "http header has no end"
        length = _fields(data[begin:head]).get("content-length", "")
        part.payload_bytes = int(length) if length.isdecimal() else None
        if fields["warc-type"] == "response":
            part.payload = data[head + 4 : end]
            if part.payload_bytes not in (None, len(part.payload)):
                return "payload has another length"
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            if digest and digest != hashlib.sha1(part.payload).hexdigest():
                return "payload has another digest"
            part.payload_bytes = len(part.payload)
    return part


def plain_parts(data: bytes) -> Iterator[Part]:
    """Records and gaps of uncompressed bytes: after a failed check, on from the next version line that holds."""
    at = gap = 0
    reason = ""
    while at < len(data):
        found = parse(data, at)
        if isinstance(found, Part):
            if gap < at:
                yield Part(gap, at - gap, reason)
            at = gap = at + found.length
            yield found
            continue
        reason = reason if gap < at else found
        at = data.find(MARK, at + 1)
        if at < 0:
            break
    if gap < len(data):
        yield Part(gap, len(data) - gap, reason)


def unpack(data: memoryview, at: int) -> tuple[bytes, int] | None:
    """Content and packed length of the gzip member at `at`, checksum held; None when it does not hold."""
    engine, out, fed = zlib.decompressobj(31), [], at
    try:
        while not engine.eof and fed < len(data):
            out.append(engine.decompress(data[fed : fed + STEP]))
            fed = min(fed + STEP, len(data))
    except zlib.error:
        return None
    return (b"".join(out), fed - len(engine.unused_data) - at) if engine.eof else None


def parts(data: bytes) -> Iterator[Part]:
    """Records and gaps of an archive of gzip members, version lines, or both. Offsets are those of the archive;
    records of one member share its offset, and a damaged record inside a sound member is a gap at that member."""
    view, at, gap, reason = memoryview(data), 0, 0, ""
    while at < len(data):
        packed = data.startswith(MAGIC, at)
        found = unpack(view, at) if packed else parse(data, at)
        if found is not None and not isinstance(found, str):
            if gap < at:
                yield Part(gap, at - gap, reason)
            if isinstance(found, Part):
                yield found
                at = gap = at + found.length
                continue
            for part in plain_parts(found[0]):
                part.offset, part.length = at, found[1]
                yield part
            at = gap = at + found[1]
            continue
        if gap == at:
            reason = found or "member does not unpack"
        places = [p for p in (data.find(MAGIC, at + 1), data.find(MARK, at + 1)) if p >= 0]
        if not places:
            break
        at = min(places)
    if gap < len(data):
        yield Part(gap, len(data) - gap, reason)


SCHEMA = "path string, offset long, length long, reason string, warc_type string, record_id string, refers_to string, uri string, payload_bytes long, payload_digest string, payload binary"


def _reader(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in SCHEMA.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                path, rows, size = batch.column(0)[i].as_py(), [], 0
                for p in parts(batch.column(1)[i].as_buffer().to_pybytes()):
                    f = p.fields.get
                    digest = (f("warc-payload-digest") or "").removeprefix("sha1:") or None
                    rows.append((path, p.offset, p.length, p.reason or None, f("warc-type"), f("warc-record-id"), f("warc-refers-to"), f("warc-target-uri"), p.payload_bytes, digest, p.payload if with_payload else None))
                    size += len(p.payload or b"") if with_payload else 0
                    if len(rows) >= 4096 or size >= 1 << 24:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives, and one for each gap, which has a `reason` and no type.

    A record stands only if its member's checksum, its lengths and its payload digest hold. After a failed
    check the reader looks for the next gzip member or version line that holds and goes on there; the bytes between
    are logged as a gap (path, offset, length, reason) and quarantined. An empty file has no rows. A task holds one
    archive at a time, besides the batch that Spark reads (spark.sql.files.maxPartitionBytes, or one archive)."""
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_reader(with_payload), SCHEMA)


def page_records(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    number = lambda c: F.regexp_extract(c, r"<urn:x-page:(-?[0-9]+)>", 1).try_cast("long")
    return records.where("warc_type is not null").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to")
    )


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {REVISIT_FROM} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {REVISIT_FROM} AND page_id <> first THEN first END AS refers_to FROM f"""
