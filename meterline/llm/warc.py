"""WARC archives as seekable Zstandard bundles.

``write_bundles`` writes one WARC record per page. A task groups its records
into independent Zstandard frames, appends them to a bundle file and closes it
with a seek table (a skippable frame that every Zstandard reader ignores; it
lists the frames' compressed and plain sizes). The index maps each record id
to (bundle, frame, offset in the plain frame), so a single record costs one
ranged read and one frame.

Bundles carry a name of their own per task attempt, and only the index says
which belong to the result: a repeated or lost task leaves at most a file
that nobody reads. Files are reached through ``pyarrow.fs``, so the folder may
be any shared store that it knows."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, maybe_broadcast
from meterline.session import scratch_path

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 30
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
# Fixed values of the seekable format: skippable frame of kind E, footer mark.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID, NO_ID = "urn:x-page:", "urn:x-page-none:"


# --- records --------------------------------------------------------------

def record_uri(page_id) -> str:
    return f"<{NO_ID}>" if page_id is None else f"<{ID}{quote(str(page_id), safe='')}>"


def id_of(uri: str | None) -> str | None:
    return unquote(uri[1 + len(ID):-1]) if uri and uri.startswith(f"<{ID}") else None


def make_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:  # control and other unsafe characters must not end a header line
        head.append(f"WARC-Target-URI: {quote(url, safe=SAFE_IN_URL)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


SAFE_IN_URL = "".join(chr(c) for c in range(0x21, 0x7F))


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    begin, size = end + 4, int(head["content-length"])
    return head, data[begin:begin + size], begin + size + 4


def split_http(block: bytes) -> tuple[int, bytes]:
    """The payload's full length, and what the block holds of it."""
    head, _, body = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return length, body


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- seekable bundles -----------------------------------------------------

def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Skippable frame: (compressed, plain) size of each frame, then the footer."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of a bundle's frames."""
    file.seek(size - 9)
    count, flags, mark = struct.unpack("<IBI", file.read(9))
    if mark != SEEKABLE or flags:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    entries = file.read(8 * count)
    out, at = [], 0
    for c, d in struct.iter_unpack("<II", entries):
        out.append((at, c, d))
        at += c
    return out


class Bundle:
    """A bundle being written."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = fs.FileSystem.from_uri(self.uri)
        self.file = store.open_output_stream(path, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, plain: bytes) -> int:
        data = self.compressor.compress(plain)
        self.file.write(data)
        self.frames.append((len(data), len(plain)))
        self.written += len(data)
        return len(self.frames) - 1

    def close(self) -> None:
        self.file.write(seek_table(self.frames))
        self.file.close()


class Bundles:
    """Reads frames of bundles, keeping the last bundle's seek table."""

    def __init__(self):
        self.uri, self.file, self.table = None, None, []

    def frame(self, uri: str, number: int) -> bytes:
        if uri != self.uri:
            self.close()
            store, path = fs.FileSystem.from_uri(uri)
            self.file = store.open_input_file(path)
            self.uri, self.table = uri, read_seek_table(self.file, self.file.size())
        at, size, plain = self.table[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(size), max_output_size=plain)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.uri = self.file = None


# --- Spark jobs -----------------------------------------------------------

def _uri(folder: str) -> str:
    return folder if "://" in folder else ("file://" + folder.removeprefix("file:"))


def write_bundles(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  revisit_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write every row as a record; the index comes back: id, bundle, frame,
    offset, length, one row per record.

    Of equal payloads of at least ``revisit_bytes`` bytes, the row with the
    largest id is a response and the others are revisits that refer to it;
    smaller payloads are all responses. A null payload is empty, a null url has
    no target header, a null id is written without one (and is a revisit where
    any row with an id has its payload). Rows that repeat the largest id are all
    responses. Extra columns are ignored; an empty table writes nothing."""
    spark = pages.sparkSession
    arrow_batches(spark)
    folder = _uri(folder or scratch_path(spark, "llm", "warc"))
    kind = pages.schema[id_col].dataType.simpleString()
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    same = (rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
            .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("digest", "first"))
    spark_path = f"{folder}/equal-payloads"
    same.write.parquet(spark_path)
    same = spark.read.schema(same.schema).parquet(spark_path)
    typed = rows.join(maybe_broadcast(same, same.count(), 64), "digest", "left").select("id", "url", "payload", "digest", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        bundle, held, size, places, id_type = None, [], 0, [], None

        def flush() -> pa.RecordBatch:
            nonlocal bundle, held, size, places
            bundle = bundle or Bundle(folder)
            frame = bundle.add(b"".join(held))
            out = pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in places], id_type), pa.array([bundle.uri] * len(places)), pa.array([frame] * len(places), pa.int32()),
                 pa.array([p[1] for p in places], pa.int64()), pa.array([p[2] for p in places], pa.int64())], ["id", "bundle", "frame", "offset", "length"])
            held, size, places = [], 0, []
            if bundle.written >= bundle_bytes:
                bundle.close()
                bundle = None
            return out

        for batch in batches:
            id_type = batch.column("id").type
            for i, url, body, digest, first in zip(*(batch.column(c) for c in ("id", "url", "payload", "digest", "first")), strict=True):
                page, to, body = i.as_py(), first.as_py(), body.as_py()
                record = make_record(page, url.as_py(), body, base64.b32encode(digest.as_py()).decode(), to, to is not None and to != page)
                places.append((page, size, len(record)))
                held.append(record)
                size += len(record)
                if size >= frame_bytes:
                    yield flush()
        if held:
            yield flush()
        if bundle:
            bundle.close()

    index = typed.mapInArrow(write, f"id {kind}, bundle string, frame int, offset long, length long")
    index.write.parquet(f"{folder}/index")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the bundles in a folder."""
    return spark.read.parquet(f"{_uri(folder)}/index")


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the indexed bundles: id, url, record_type, refers_to,
    payload_bytes, payload_digest and, with ``payloads``, payload (null for
    revisits). Frames are read independently; a response whose payload does not
    have the digest of its header raises."""
    kind = index.schema["id"].dataType.simpleString()
    names = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *["payload"] * payloads]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles = Bundles()
        for batch in batches:
            for uri, frame in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                data, at, rows = bundles.frame(uri, frame), 0, []
                while at < len(data):
                    head, block, at = parse_record(data, at)
                    length, body = split_http(block)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    response = head["warc-type"] == "response"
                    if response and (len(body) != length or base32_sha1(body) != digest):
                        raise ValueError(f"{uri}, frame {frame}: {head['warc-record-id']} is damaged")
                    rows.append((id_of(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], id_of(head.get("warc-refers-to")),
                                 length, digest, *[body if response else None] * payloads))
                columns = list(zip(*rows, strict=True))
                types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)
        bundles.close()

    frames = index.select("bundle", "frame").distinct()
    parts = max(1, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frames = frames.repartition(parts, "bundle", F.floor(F.col("frame") / 16)).sortWithinPartitions("bundle", "frame")
    found = frames.mapInArrow(read, "id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string" + ", payload binary" * payloads)
    return found.withColumn("id", F.col("id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def fetch(index: DataFrame, wanted: DataFrame, id_col: str = "id") -> DataFrame:
    """The records of the wanted ids alone: (id, record), each by one frame and
    its offset in it."""
    kind = index.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundles, last, data = Bundles(), None, b""
        for batch in batches:
            out = []
            for uri, frame, at, n in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if (uri, frame) != last:
                    last, data = (uri, frame), bundles.frame(uri, frame)
                out.append(data[at:at + n])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "record"])
        bundles.close()

    hits = index.join(wanted.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    return hits.sortWithinPartitions("bundle", "frame", "offset").select("id", "bundle", "frame", "offset", "length").mapInArrow(read, f"id {kind}, record binary")
