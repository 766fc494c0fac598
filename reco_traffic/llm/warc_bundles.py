"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``frame_bytes``;
a bundle of about ``bundle_bytes`` ends with the seek table of the seekable
format (a skippable frame: sizes and checksum of every frame, then their number
and the magic number). An index maps each record identifier to its bundle, its
frame and its offset inside the frame, so that one record is read by
decompressing one frame. Concatenating a bundle's bytes gives a valid
``.warc.zst`` file. Bundles are rows of a Parquet table, committed by Spark's
own writer, so a lost executor leaves no partial archive.

Of records with equal payloads of at least ``min_payload`` bytes, that with the
smallest page_id is the response and the others revisit it; a revisit carries no
payload. Digests are counted with partial sums and joined as (page_id, digest)
rows; payloads move once, by page.

A null html is an empty payload, a null url becomes ``urn:page:<id>``, a null
page_id is written as such, is never a payload's first record unless all its
copies are null, and revisits otherwise. Rows that repeat a page_id and payload
have one type: all are responses if that id is the smallest. A very long page is
a frame of its own. Empty tables give empty bundles; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reco_traffic.session import scratch_path

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
BUNDLES_PER_FILE = 4


def _b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}/'.encode() + digest).digest()[:16], version=5)}>"


def record(page_id, url: str | None, payload: bytes, digest: bytes, size: int, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit has the response's HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) if url else f"urn:page:{page_id}"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{_b32(digest)}", f"X-Page-ID: {page_id}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0):
    """The record that begins at ``at``: (headers, block, end)."""
    head = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:head].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    end = head + 4 + size
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut short")
    return headers, data[head + 4 : end], end + 4


class Bundle:
    """Collects records into frames; ``done`` appends the seek table."""

    def __init__(self, frame_bytes: int, level: int = 3):
        self.frame_bytes, self.pack = frame_bytes, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames, self.table, self.index, self.part, self.raw, self.size = [], [], [], [], 0, 0

    def add(self, rid: str, data: bytes):
        if self.raw and self.raw + len(data) > self.frame_bytes:
            self.close()
        self.index.append((rid, len(self.frames), self.raw, len(data)))
        self.part.append(data)
        self.raw += len(data)
        self.size += len(data)

    def close(self):
        raw = b"".join(self.part)
        frame = self.pack.compress(raw)
        self.frames.append(frame)
        self.table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.part, self.raw = [], 0

    def done(self) -> bytes:
        if self.part:
            self.close()
        seek = b"".join(self.table) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(seek)) + seek


def seek_table(data: bytes) -> list[tuple[int, int, int, int]]:
    """(offset, compressed size, size, checksum) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or not flags & CHECKSUMS:
        raise ValueError("no seek table")
    begin, out, at = len(data) - 9 - 12 * n, [], 0
    for k in range(n):
        packed, size, check = struct.unpack_from("<III", data, begin + 12 * k)
        out.append((at, packed, size, check))
        at += packed
    if struct.unpack_from("<II", data, at) != (SKIPPABLE, 12 * n + 9):
        raise ValueError("the seek table doesn't fit the frames")
    return out


def frame(data: bytes, entry) -> bytes:
    at, packed, size, check = entry
    raw = zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=size)
    if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
        raise ValueError("a frame is damaged")
    return raw


def typed(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(page_id, url, payload, sha, revisit, refers_to) of every page."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    slim = p.where(F.length("payload") >= min_payload).select("page_id", "sha")
    first = slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    again = slim.join(first, "sha").where("page_id is null or page_id > first").select(F.col("page_id").alias("_p"), F.col("sha").alias("_s"), F.col("first").alias("refers_to")).distinct()
    joined = p.join(again, p["page_id"].eqNullSafe(again["_p"]) & (p["sha"] == again["_s"]), "left")
    return joined.select("page_id", "url", F.when(F.col("_s").isNull(), F.col("payload")).alias("payload"), F.unhex("sha").alias("sha"), F.length("payload").cast("long").alias("size"), F.col("_s").isNotNull().alias("revisit"), "refers_to")


def write_bundles(pages: DataFrame, path: str | None = None, min_payload: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write bundles to ``path`` (else the shared folder) and return the table
    (bundle_id, data, index); index lists record_id, frame, offset, length."""
    entry = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches):
        part, n, bundle = TaskContext.get().partitionId(), 0, Bundle(frame_bytes, level)

        def out():
            index = [dict(zip(("record_id", "frame", "offset", "length"), x)) for x in bundle.index]
            return pa.RecordBatch.from_arrays([pa.array([f"{part:06d}-{n:06d}"]), pa.array([bundle.done()], pa.binary()), pa.array([index], pa.list_(entry))], names=["bundle_id", "data", "index"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, sha, size, revisit, refers = (batch.column(k)[i].as_py() for k in range(7))
                bundle.add(record_id(page, sha), record(page, url, payload or b"", sha, size, refers, revisit, date))
                if bundle.size >= bundle_bytes:
                    yield out()
                    n, bundle = n + 1, Bundle(frame_bytes, level)
        if bundle.index:
            yield out()

    path = path or scratch_path(pages.sparkSession, "warc")
    schema = "bundle_id string, data binary, index array<struct<record_id: string, frame: int, offset: long, length: long>>"
    # few bundles a file: a task that reads them back holds few at once
    typed(pages, min_payload).mapInArrow(run, schema).write.option("maxRecordsPerFile", BUNDLES_PER_FILE).option("compression", "none").parquet(path)
    return pages.sparkSession.read.schema(schema).parquet(path)


_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def _row(headers: dict, block: bytes):
    head = block.index(b"\r\n\r\n") + 4
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(block[:head].split(b"Content-Length: ")[1].split(b"\r\n")[0])
    if headers["WARC-Type"] == "response" and (len(block) - head != size or _b32(hashlib.sha1(block[head:]).digest()) != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    number = lambda x: None if x in (None, "None") else int(x)
    return number(headers["X-Page-ID"]), size, digest, headers["WARC-Type"], number(headers.get("X-Refers-To-Page-ID")), block[head:]


def read_records(bundles: DataFrame, payload: bool = False) -> DataFrame:
    """Every record of every bundle, digests and checksums verified."""
    names = _NAMES + ["payload"] * payload
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_buffer().to_pybytes()
                for e in seek_table(data):
                    raw, at, rows = frame(data, e), 0, []
                    while at < len(raw):
                        headers, block, at = parse(raw, at)
                        rows.append(_row(headers, block))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[: len(names)], kinds)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload
    return bundles.select("data").mapInArrow(run, schema)


def fetch(bundles: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The asked records (record_id), each by one seek: record_id and its bytes."""
    places = bundles.select("bundle_id", F.explode("index").alias("x")).select("bundle_id", "x.*").join(record_ids, "record_id")
    asked = places.groupBy("bundle_id").agg(F.collect_list(F.struct("frame", "offset", "length", "record_id")).alias("want"))  # of one bundle

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_buffer().to_pybytes()
                table, last, raw, rows = seek_table(data), None, b"", []
                for w in sorted(batch.column(1)[i].as_py(), key=lambda w: w["frame"]):
                    if w["frame"] != last:
                        last, raw = w["frame"], frame(data, table[w["frame"]])
                    rows.append((w["record_id"], raw[w["offset"] : w["offset"] + w["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["record_id", "record"])

    return bundles.select("bundle_id", "data").join(asked, "bundle_id").select("data", "want").mapInArrow(run, "record_id string, record binary")


def query(spark, sf_dir: str) -> DataFrame:
    return read_records(write_bundles(spark.read.parquet(f"{sf_dir}/pages.parquet")))


ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, html, octet_length(encode(html))::bigint as payload_bytes, sha1(html) as hex,
        array_to_string([lpad(bin(('0x' || h)::int), 4, '0') for h in string_split(sha1(html), '')], '') as bits from p),
f as (select html, min(page_id) as first from d group by html)
select page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, i * 5 + 1, 5))::int, 1) for i in range(32)], '') as payload_digest,
  case when page_id > first then 'revisit' else 'response' end as record_type,
  case when page_id > first then first end as refers_to
from d join f using (html)
"""
