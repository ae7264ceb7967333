"""Web records in seekable Zstandard bundles: WARC files whose records can be read one by one.

A bundle is a run of independent Zstandard frames, each with a few whole records, and a seek table in
a skippable frame at its end (the public seekable format). The index maps a record to its bundle,
frame and place in the frame, so one record costs the table at the end and one frame. Payloads seen
before are `revisit` records that refer to one `response`.

Tasks write bundles under new names and return the index rows; the index table is committed by Spark,
so bundles of failed or repeated attempts are never referred to.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import new_folder, stored, task_count

LEAST_SHARED = 1000
"""Smaller payloads are always written in full."""
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
FRAMES_PER_READ = 16
"""Frames (some 4 MB of records) that are read back together."""
LEVEL = 3

# Magic numbers of the Zstandard seekable format, and the WARC revisit profile.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = {
    "record_id": "string", "page_id": "long", "record_type": "string", "bundle": "string", "frame": "int",
    "frame_start": "long", "frame_bytes": "long", "offset": "long", "length": "long",
}
RECORD = {"page_id": "long", "record_id": "string", "record_type": "string", "refers_to": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "payload": "binary"}
_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{n} {t}" for n, t in fields.items())


def _batch(fields: dict[str, str], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, t in zip(columns, fields.values())], list(fields))


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, reached from a task; plain paths are shared mounts."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Writer:
    """One bundle being written."""

    def __init__(self, uri: str):
        self.uri = uri
        files, path = place(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(path, compression=None)  # frames are compressed already
        self.tool = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Writes a frame; (number, start, bytes)."""
        packed = self.tool.compress(data)
        self.out.write(packed)
        at = len(self.frames), self.size, len(packed)
        self.frames.append((len(packed), len(data)))
        self.size += len(packed)
        return at

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class Reader:
    """A bundle open for reading by frame."""

    def __init__(self, uri: str):
        files, path = place(uri)
        self.file = files.open_input_file(path)
        end = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(8 * n, end - 9 - 8 * n)
        self.starts, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.starts.append((at, packed, plain))
            at += packed
        self.tool = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        start, packed, plain = self.starts[number]
        return self.tool.decompress(self.file.read_at(packed, start), max_output_size=plain) if plain else b""

    def close(self) -> None:
        self.file.close()


def record_name(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}|{digest}'.encode()).digest())}>"


def record_of(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str) -> tuple[str, str, bytes]:
    """(record id, type, bytes) of a page; a revisit has the same HTTP head and no payload."""
    revisit = refers_to is not None
    name = record_name(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return name, "revisit" if revisit else "response", "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[tuple, int]:
    """(row of RECORD, next place) of the record at a place; a payload that differs from its digest is an error."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    block = data[start : start + size]
    if lines[0] != "WARC/1.1" or len(block) != size or data[start + size : start + size + 4] != b"\r\n\r\n":
        raise ValueError(f"broken record at {at}")
    number = lambda key: int(head[key]) if key in head else None
    kind, payload = head["WARC-Type"], block[block.index(b"\r\n\r\n") + 4 :]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != number("X-Payload-Length")):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    row = number("X-Page"), head["WARC-Record-ID"], kind, number("X-Refers-To-Page"), head.get("WARC-Target-URI"), number("X-Payload-Length"), digest, payload if kind == "response" else None
    return row, start + size + 4


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Writes a record per row of `pages` (page_id, url, html; other columns ignored); returns the index.

    Among rows with equal html of at least `least_shared` bytes, the one with the largest page_id is the
    response and the others revisit it; a row without page_id revisits if any row has an id; repeated rows
    with the largest id are responses. NULL html is an empty payload, a NULL url leaves the header out.
    Payloads travel once; only (digest, largest id) of repeated payloads is looked up, in a join whose
    page side adaptive execution splits where one payload is very common. An empty table writes nothing.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    shared = rows.filter(F.col("size") >= least_shared).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("keeper")).filter("n > 1").select("digest", "keeper")
    marked = rows.join(shared, "digest", "left").withColumn("refers_to", F.when(F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")))
    marked = marked.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "size", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, held, rows, size = None, [], [], 0

        def flush() -> list[tuple]:
            number, start, packed = bundle.add(b"".join(held))
            return [(name, page, kind, bundle.uri, number, start, packed, at, length) for name, page, kind, at, length in rows]

        try:
            for batch in batches:
                for page, url, html, n, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if bundle is None:
                        bundle = Writer(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                    name, kind, data = record_of(page, url, (html or "").encode(), n, digest, refers_to, date)
                    rows.append((name, page, kind, size, len(data)))
                    held.append(data)
                    size += len(data)
                    if size >= frame_bytes:
                        yield _batch(INDEX, flush())
                        held, rows, size = [], [], 0
                        if bundle.size >= bundle_bytes:
                            bundle.close()
                            bundle = None
            if bundle is not None and held:
                yield _batch(INDEX, flush())
        finally:
            if bundle is not None:
                bundle.close()

    return stored(marked.mapInArrow(write, ddl(INDEX)), "archive-index")


def read_archives(index: DataFrame, payload: bool = False, frames_per_read: int = FRAMES_PER_READ) -> DataFrame:
    """Every record of the bundles that `index` names, frame by frame; RECORD's columns.

    What is dealt out are runs of `frames_per_read` frames, to a fixed number of tasks: a row is a few
    bytes to the optimizer, which would otherwise bring all of them to one task. Frames are independent,
    so a task reads the parts of a bundle that it was dealt. An empty index gives no records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bundle = Reader(uri)
                for number in range(run * frames_per_read, min(len(bundle.starts), (run + 1) * frames_per_read)):
                    data, at, rows = bundle.frame(number), 0, []
                    while at < len(data):
                        row, at = parsed(data, at)
                        rows.append(row if payload else (*row[:-1], None))
                    yield _batch(RECORD, rows)
                bundle.close()

    runs = index.select("bundle", F.expr(f"frame div {frames_per_read}").alias("run")).distinct()
    return runs.repartition(task_count(index.sparkSession)).mapInArrow(read, ddl(RECORD))


def fetch(wanted: DataFrame) -> DataFrame:
    """The records of the given index rows, reading only their frames; RECORD's columns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, number, bundle, data = None, None, None, b""
        for batch in batches:
            rows = []
            for at_uri, at_frame, offset in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset"))):
                if at_uri != uri:
                    bundle, uri, number = Reader(at_uri), at_uri, None
                if at_frame != number:
                    data, number = bundle.frame(at_frame), at_frame
                rows.append(parsed(data, offset)[0])
            yield _batch(RECORD, rows)

    dealt = wanted.repartition(task_count(wanted.sparkSession), "bundle", "frame")  # a fixed number of tasks, as in read_archives
    return dealt.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, ddl(RECORD))
