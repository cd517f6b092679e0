"""WARC archives: a writer with revisit records, and a splittable reader of gzip-member archives.

The reader never needs an index. A task scans its byte range for the gzip
magic, checks each candidate by decoding the WARC header of the member, and
owns the records that start inside the range; the last one may end beyond it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = b"\x1f\x8b\x08"
#: An empty gzip member; its last byte is NUL.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
MIN_REVISIT = 1000
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 16

RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def with_revisits(pages: DataFrame, payload: Column, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to.

    Among equal payloads of at least ``min_bytes`` the largest page_id is the
    response and the other records revisit it. Ties: rows that repeat the
    largest page_id are responses too; where every page_id is null, all are.
    The largest id is a max aggregate, combined before the shuffle, and only
    payloads that do recur are joined; a hot payload is a skewed join, which
    adaptive execution splits.
    """
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.length("payload") >= min_bytes
    first = (rows.where(large).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("digest").alias("d"), "first"))
    rows = rows.join(first, large & (rows["digest"] == F.col("d")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("first")).alias("refers_to"))


def _member(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One gzip member with one WARC record. A revisit carries no payload."""
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(body)}")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n") + pack.compress(body) + pack.compress(b"\r\n\r\n") + pack.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page_id", "url", "payload", "digest", "record_type", "refers_to")
    for batch in batches:
        out, size = [], 0
        for row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True):
            member = _member(*row)
            if member[-1]:
                member += EMPTY_MEMBER
            out.append(member[:-1])
            size += len(member)
            if size > 32 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write ``with_revisits`` rows as .warc.gz content, one file per task, to any file system Spark can write.

    Spark's text writer puts the bytes; it ends each value with a separator,
    so every member, whose last byte is NUL (the top byte of a length below
    16 MB, else that of an empty member put behind it), leaves that byte to
    the separator. The files are exactly the members in a row, and Spark's
    commit protocol covers retried tasks.
    """
    members = records.mapInArrow(_members, "value binary")
    members.select(F.col("value").cast("string")).write.option("lineSep", "\x00").text(path)


class _Bytes:
    """Reads on from a position of an open file, in blocks."""

    def __init__(self, file, at: int, size: int):
        self.file, self.size = file, size
        self.at, self.data = at, b""

    def more(self) -> bool:
        self.file.seek(self.at + len(self.data))
        block = self.file.read(READ_BYTES)
        self.data += block
        return bool(block)

    def move(self, at: int) -> None:
        self.data = self.data[at - self.at:] if at - self.at < len(self.data) else b""
        self.at = at


def _head(buf: _Bytes) -> bool:
    """Whether the member at the buffer's start is gzip and begins with a WARC record's header."""
    inflate, at, out = zlib.decompressobj(31), 0, b""
    try:
        while len(out) < 5 and not inflate.eof:
            if at >= len(buf.data) and not buf.more():
                return False
            chunk = buf.data[at:at + 512]
            out += inflate.decompress(chunk, HEADER_BYTES)
            at += len(chunk)
    except zlib.error:
        return False
    return out.startswith(b"WARC/")


def _inflate(buf: _Bytes) -> tuple[bytes, int]:
    """The member's content, and the bytes it takes. Raises on a damaged or cut member."""
    inflate, parts, at = zlib.decompressobj(31), [], 0
    while not inflate.eof:
        if at >= len(buf.data) and not buf.more():
            raise EOFError(f"gzip member at {buf.at} is cut short")
        parts.append(inflate.decompress(buf.data[at:]))
        at = len(buf.data)
    return b"".join(parts), at - len(inflate.unused_data)


def _parse(content: bytes) -> dict:
    head, _, body = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = body[:int(fields["Content-Length"])]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    urn = lambda name: None if (x := fields.get(name)) is None or x == "<urn:page:null>" else int(x[10:-1])
    url = fields.get("WARC-Target-URI")
    return {"page_id": urn("WARC-Record-ID"), "url": None if url is None else re.sub("%(0D|0A|25)", lambda m: chr(int(m[1], 16)), url),
            "record_type": kind, "refers_to": urn("WARC-Refers-To"),
            "payload_bytes": int(fields.get("X-Payload-Length", len(payload))), "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def records_in(file, start: int, end: int, size: int) -> Iterator[dict]:
    """The records that start in [start, end) of an open archive of ``size`` bytes."""
    at = start
    buf = _Bytes(file, at, size)
    while at < end:
        found = buf.data.find(MAGIC)
        if found < 0:
            if buf.at + len(buf.data) >= min(end + len(MAGIC) - 1, size):
                return
            buf.move(max(buf.at, buf.at + len(buf.data) - len(MAGIC) + 1))
            at = buf.at
            if not buf.more():
                return
            continue
        at = buf.at + found
        if at >= end:
            return
        buf.move(at)
        if _head(buf):
            content, taken = _inflate(buf)
            yield _parse(content)
            at += taken
        else:
            at += 1
        buf.move(at)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    for batch in batches:
        for row in batch.to_pylist():
            system, path = fs.FileSystem.from_uri(row["path"])
            with system.open_input_file(path) as file:
                out, held = [], 0
                for record in records_in(file, row["start"], row["end"], row["size"]):
                    out.append(record)
                    held += len(record["payload"] or b"") + 200
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the archives under ``path``: RECORD's columns.

    Spark lists the files (names and lengths only); each byte range is one
    row, dealt over the tasks, and each task opens only its own range. A
    damaged member raises; bytes that only look like gzip are passed over. A
    folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "size", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("end"))
    tasks = max(1, spark.sparkContext.defaultParallelism * 2)
    return ranges.repartition(tasks).mapInArrow(_read, RECORD)
