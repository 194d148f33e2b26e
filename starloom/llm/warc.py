"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames, so one is read without
those before it. A bundle ends with a skippable frame that holds the seek
table: the compressed and decompressed size of every frame, in the published
seekable format. An index maps each record's identifier to its bundle, frame
and the offset and length within the decompressed frame.

A page whose payload equals that of a page with a larger id is written as a
revisit record that refers to it; its block is the HTTP header alone.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.shared import BROADCAST_BYTES, shared_folder, written

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
# Records are added to a frame up to this many bytes, frames to a bundle up to that many.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 128 * 1024 * 1024
# Payloads of at least so many bytes are written once.
REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3

_URN = "urn:page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 of a payload in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _id(page_id: int | None) -> str:
    return f"<{_URN}{'' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    number = record_id.strip("<>").removeprefix(_URN)
    return int(number) if number else None


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
    date: str = DATE,
) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if url is not None:
        clean = url.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {clean}")
    if revisit:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    """A record as read: its headers and its block, split into HTTP header and payload."""

    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def page_id(self) -> int | None:
        return _page(self.headers["WARC-Record-ID"])

    @property
    def refers_to(self) -> int | None:
        return _page(self.headers["WARC-Refers-To"]) if "WARC-Refers-To" in self.headers else None


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def parse_records(data: bytes) -> Iterator[Record]:
    """The records in a run of decompressed bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        headers = _headers(data[at:end])
        start = end + 4
        block = data[start : start + int(headers["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        yield Record(headers, _headers(http), payload)
        at = start + len(block) + 4


class BundleWriter:
    """Writes records into frames and, when closed, the seek table."""

    def __init__(self, out) -> None:
        self.out, self.frames, self.buffer, self.size = out, [], [], 0
        self.written = 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, record: bytes) -> tuple[int, int]:
        """The frame and the offset in it that ``record`` gets."""
        if self.buffer and self.size + len(record) > FRAME_BYTES:
            self._flush()
        place = len(self.frames), self.size
        self.buffer.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        frame = self.compressor.compress(b"".join(self.buffer))
        self.out.write(frame)
        self.frames.append((len(frame), self.size))
        self.written += len(frame)
        self.buffer, self.size = [], 0

    def close(self) -> None:
        if self.buffer:
            self._flush()
        entries = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        count, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table at the end")
        entries = struct.unpack(f"<{2 * count}I", self._at(size - 9 - 8 * count, 8 * count))
        self.frames, start = [], 0
        for packed, unpacked in zip(entries[::2], entries[1::2]):
            self.frames.append((start, packed, unpacked))
            start += packed

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        start, packed, unpacked = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self._at(start, packed), max_output_size=unpacked)

    def record(self, frame: int, offset: int, length: int) -> Record:
        return next(parse_records(self.frame(frame)[offset : offset + length]))


def _open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


INDEX = (
    "page_id long, record_id string, bundle string, frame int, offset long, length long, "
    "record_type string, refers_to long"
)


def write_archives(
    pages: DataFrame, path: str | None = None, revisit_bytes: int = REVISIT_BYTES, date: str = DATE
) -> tuple[str, DataFrame]:
    """Write a record per row of ``pages``; the folder, and the index of the records in it.

    Of equal payloads of at least ``revisit_bytes`` bytes the one of the largest
    ``page_id`` is the response and the others revisit it (rows that repeat
    that id are responses too). Null ids are the smallest, null html is an
    empty payload, and a null url leaves its header out. A task writes its own
    bundles under names of its attempt, and the index names only those of
    attempts that succeeded. Other columns are not read.
    """
    path = path or shared_folder(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= revisit_bytes
    groups = rows.where(long_enough).groupBy("digest").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("copies")
    )
    repeated = written(groups.where("copies > 1").select("digest", "last"), "repeated")
    small = repeated.count() * 120 <= BROADCAST_BYTES
    joined = rows.join(F.broadcast(repeated) if small else repeated, "digest", "left")
    revisit = long_enough & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    ready = joined.select(
        "page_id", "url", "payload", F.when(revisit, F.col("last")).alias("refers_to"),
        F.coalesce(revisit, F.lit(False)).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system, folder = _open_folder(path)
        system.create_dir(folder, recursive=True)
        writer, number, name = None, 0, ""
        for batch in batches:
            index = []
            for page_id, url, payload, refers_to, again in zip(*[iter(c) for c in batch.columns]):
                if writer is None:
                    name = f"{stem}-{number:03d}.warc.zst"
                    writer = BundleWriter(system.open_output_stream(f"{folder}/{name}", compression=None))
                    number += 1
                page_id, refers_to, again = page_id.as_py(), refers_to.as_py(), again.as_py()
                record = record_bytes(page_id, url.as_py(), payload.as_py(), refers_to, again, date)
                frame, offset = writer.add(record)
                kind = "revisit" if again else "response"
                index.append((page_id, _id(page_id), name, frame, offset, len(record), kind, refers_to))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield _rows(index, schema)
        if writer is not None:
            writer.close()

    schema = T.StructType.fromDDL(INDEX)
    return path, written(ready.mapInArrow(write, schema), "index")


_ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), _ARROW[f.dataType.simpleString()]) for c, f in zip(columns, schema)],
        names=schema.names,
    )


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(path: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, read back frame by frame.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Size and
    digest of a response are taken from its payload as read, those of a revisit
    from its headers, which describe the payload it refers to. A response whose
    payload does not have the digest it was written with is an error.
    """
    schema = T.StructType.fromDDL(READ)
    partitions = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A hash of the name, not the name, which distinct() has dealt out already: the
    # optimizer would drop that repartition and merge the few names into one task.
    bundles = index.select("bundle").distinct().repartition(partitions, F.xxhash64("bundle"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open_folder(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{folder}/{name}") as source:
                    reader = BundleReader(source)
                    for number in range(len(reader.frames)):
                        yield _rows([_described(r) for r in parse_records(reader.frame(number))], schema)

    return bundles.mapInArrow(read, schema)


def _described(record: Record) -> tuple:
    kind = record.headers["WARC-Type"]
    digest = record.headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(record.http["Content-Length"])
    if kind == "response" and (len(record.payload), payload_digest(record.payload)) != (size, digest):
        raise ValueError(f"{record.headers['WARC-Record-ID']} does not have its digest")
    return record.page_id, size, digest, kind, record.refers_to


def fetch_records(path: str, wanted: DataFrame) -> DataFrame:
    """``page_id, html`` of the records in ``wanted``, rows of an index of responses.

    Reads only the frames that hold them.
    """
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _open_folder(path)
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                with system.open_input_file(f"{folder}/{row['bundle']}") as source:
                    record = BundleReader(source).record(row["frame"], row["offset"], row["length"])
                    found.append((record.page_id, record.payload.decode("utf-8", "surrogatepass")))
            yield _rows(found, schema)

    schema = T.StructType.fromDDL("page_id long, html string")
    return wanted.select("bundle", "frame", "offset", "length").mapInArrow(fetch, schema)
