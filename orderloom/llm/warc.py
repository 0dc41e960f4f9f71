"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about `frame_bytes`; a bundle is a file
of such frames that ends in the seek table of the public seekable format (a skippable frame with
the compressed and full size of each frame, the frame count and a magic number). The index maps
a record identifier to its bundle, frame and offset inside the frame, so one record costs one
ranged read of its frame.

Bundles go to a folder that all executors share, through pyarrow's file systems, under names that
are fresh for each task attempt. Only names in the index, which Spark commits once per task, are
ever read; what a lost attempt has left is never referenced.

Records with equal payloads of at least `least` bytes are stored once: the one with the smallest
page_id is a response, the others are revisits that refer to it.

Defined results: a null or empty html is an empty payload. Rows that repeat the smallest page_id
with the same payload are all responses. A null page_id never stands for others: it is a revisit
if its payload is known under an id, else a response. A null url writes no target. Extra columns
are ignored; an empty table writes no bundle. A record longer than a frame has a frame of its own.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import bounded_batches, scratch, ship, table
from orderloom.session import shared_dir

ship(__name__)

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024  # of compressed data
# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = (
    "record_id string, bundle string, frame int, frame_at long, frame_size long, "
    "record_at long, record_size long"
)
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def warc_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or a revisit without its payload; both state the payload's full length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(url.splitlines()))
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{record_id(refers_to)}>",
        ]
    block = http + (payload if refers_to is None else b"")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        text = fields[name][len("<urn:page:") : -1]
        return int(text) if text else None

    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", packed, full) for packed, full in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, full size) of each frame, from the end of a bundle."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC or flags & 0x80:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    entries, at, out = file.read(8 * count), 0, []
    for i in range(count):
        packed, full = struct.unpack_from("<II", entries, 8 * i)
        out.append((at, packed, full))
        at += packed
    return out


class BundleWriter:
    """Writes records to one bundle after the other; returns the index rows of closed bundles."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int) -> None:
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.folder, self.frame_bytes, self.bundle_bytes = folder, frame_bytes, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.file = None
        self.frame, self.filled = io.BytesIO(), 0
        self.pending, self.rows = [], []

    def add(self, rid: str, record: bytes) -> list[tuple]:
        done = []
        if self.filled and self.filled + len(record) > self.frame_bytes:
            done = self._end_frame()
        self.pending.append((rid, self.filled, len(record)))
        self.frame.write(record)
        self.filled += len(record)
        return done

    def _end_frame(self) -> list[tuple]:
        if self.file is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.fs.create_dir(self.root, recursive=True)
            self.file = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.at, self.frames = 0, []
        packed = self.packer.compress(self.frame.getvalue())
        self.file.write(packed)
        self.rows += [
            (rid, self.name, len(self.frames), self.at, len(packed), at, size)
            for rid, at, size in self.pending
        ]
        self.frames.append((len(packed), self.filled))
        self.at += len(packed)
        self.frame, self.filled, self.pending = io.BytesIO(), 0, []
        return self.close() if self.at >= self.bundle_bytes else []

    def close(self) -> list[tuple]:
        done = self._end_frame() if self.filled else []
        if self.file is not None:
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.file = None
            done, self.rows = done + self.rows, []
        return done


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 4
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
    )


def write_bundles(
    pages: DataFrame,
    folder: str,
    least: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Archive (page_id, url, html); returns the index, to be written once by the caller."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = pages.withColumn("_digest", F.sha1(F.encode("html", "utf-8")))
    first = (
        keyed.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull())
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"))
    )
    joined = keyed.join(first, "_digest", "left").select(
        "page_id",
        "url",
        "html",
        F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first")).alias("_refers"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes)
        for batch in batches:
            done = []
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = html.encode()
                record = warc_record(page_id, url, payload, base32_sha1(payload), refers)
                done += writer.add(record_id(page_id), record)
            if done:
                yield _index_batch(done)
        yield _index_batch(writer.close())

    bounded_batches(pages.sparkSession)
    return joined.mapInArrow(pack, INDEX)


def read_record(folder: str, bundle: str, frame_at: int, frame_size: int, at: int, size: int):
    """One record by its index entry: one ranged read and one frame to decompress."""
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/{bundle}") as file:
        file.seek(frame_at)
        frame = zstandard.ZstdDecompressor().decompress(file.read(frame_size))
    return parse_record(frame[at : at + size])


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the indexed bundles, parsed; payload digests are checked.

    The unit of work is a frame, so a large bundle is read by many tasks.
    """
    frames = index.groupBy("bundle", "frame").agg(
        F.collect_list(F.struct("record_at", "record_size")).alias("records")
    )
    # rows are short but each stands for a frame to read: deal them out by number, not by bytes
    tasks = 2 * index.sparkSession.sparkContext.defaultParallelism
    frames = frames.repartition(max(tasks, -(-frames.count() // 256)), "bundle", "frame")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        opened, file, places = None, None, []
        for batch in batches:
            out = []
            for row in sorted(batch.to_pylist(), key=lambda r: (r["bundle"], r["frame"])):
                if row["bundle"] != opened:
                    if file is not None:
                        file.close()
                    opened = row["bundle"]
                    file = fs.open_input_file(f"{root}/{opened}")
                    places = read_seek_table(file, file.size())
                start, packed, full = places[row["frame"]]
                file.seek(start)
                data = zstandard.ZstdDecompressor().decompress(file.read(packed), full)
                for r in row["records"]:
                    raw = data[r["record_at"] : r["record_at"] + r["record_size"]]
                    out.append(parse_record(raw))
            columns = [pa.array([r[n] for r in out], k) for n, k in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if file is not None:
            file.close()

    return frames.mapInArrow(unpack, RECORD)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    pages = table(spark, sf_dir, "pages")
    index = scratch(write_bundles(pages, folder), "warc-index")
    return read_bundles(index, folder)


OP1_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (SELECT hex, min(page_id) AS head FROM payloads GROUP BY hex),
digits AS (
  SELECT hex, head, list_aggregate(list_transform(range(0, 8), lambda j:
    list_aggregate(list_transform([32768, 1024, 32, 1], lambda d:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (CAST('0x' || substr(hex, CAST(5 * j + 1 AS INTEGER), 5) AS INTEGER) // d) % 32 + 1, 1)),
      'string_agg', '')), 'string_agg', '') AS code
  FROM groups)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  code AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM payloads JOIN digits USING (hex)
"""
