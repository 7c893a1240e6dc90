"""WARC archives as seekable Zstandard bundles.

A bundle holds independent Zstandard frames of a bounded number of payload bytes and ends in a skippable
frame with the public seek table (magic 0x8F92EAB1): any Zstandard reader reads the bundle as one stream,
and a reader that knows the table opens one frame. The index maps a record's id to its bundle, its frame
and its offset within that frame.

Records of equal payload: the one with the smallest id is the response, the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.shared import scratch_path, written

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 1 << 28
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, bundle string, frame long, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, stored_digest string, record_type string, refers_to long, payload binary"


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI; executors open the shared folder through it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no body."""
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), body and end of the record at an offset of a frame."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at offset {at}")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    stop = end + 4 + int(headers["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at offset {at} is cut")
    return headers, data[end + 4 : stop], stop + 4


class BundleWriter:
    """Writes one bundle; add() tells the frame and the offset within it."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.buffer, self.table, self.written = bytearray(), [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        place = len(self.table), len(self.buffer)
        self.buffer += data
        if len(self.buffer) >= self.frame_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.buffer:
            packed = self.compressor.compress(bytes(self.buffer))
            self.out.write(packed)
            self.table.append((len(packed), len(self.buffer)))
            self.written += len(packed)
            self.buffer.clear()

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.table), 0, SEEKABLE))
        self.out.close()


class BundleReader:
    """Opens single frames of a bundle by its seek table."""

    def __init__(self, source):
        import zstandard

        self.source, self.decompressor = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        source.seek(size - 9 - 8 * frames)
        sizes = list(struct.iter_unpack("<II", source.read(8 * frames)))
        self.frames, at = [], 0
        for packed, raw in sizes:
            self.frames.append((at, packed, raw))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, raw = self.frames[k]
        self.source.seek(at)
        return self.decompressor.decompress(self.source.read(packed), max_output_size=raw)


def decided(pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """(row_id, sha, refers_to) of the rows that revisit another: equal payload of min_bytes or more, and not the smallest id."""
    payload = F.coalesce(F.col(payload_column), F.lit("")).cast("binary")
    keys = pages.select(F.col(id_column).cast("long").alias("row_id"), F.sha2(payload, 256).alias("sha"), F.octet_length(payload).alias("n"))
    keys = keys.where(F.col("n") >= min_bytes)
    groups = keys.groupBy("sha").agg(F.min("row_id").alias("first_id"), F.count("*").alias("size")).where("size > 1")
    return keys.join(groups, "sha").where("not (row_id <=> first_id)").select("row_id", "sha", F.col("first_id").alias("refers_to")).distinct()


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", payload_column: str = "html", url_column: str | None = "url", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes bundles to a shared folder and returns the index: page_id, bundle, frame, offset, length.

    A bundle's name is new for each attempt of a task, so a retried or lost task leaves at most files that no
    index row names. Memory is one frame a task. A null payload counts as empty, a null id is written as an
    empty one, rows that repeat an id each get a record; an empty table gives an empty index. Other columns
    are not read.
    """
    url = F.col(url_column).cast("string") if url_column else F.lit(None).cast("string")
    rows = pages.select(F.col(id_column).cast("long").alias("row_id"), url.alias("url"), F.coalesce(F.col(payload_column), F.lit("")).cast("binary").alias("payload"))
    found = decided(pages, id_column, payload_column, min_bytes).withColumnsRenamed({"row_id": "found_id", "sha": "found_sha"})
    rows = rows.join(found, F.col("row_id").eqNullSafe(F.col("found_id")) & (F.sha2("payload", 256) == F.col("found_sha")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        writer, name = None, ""
        for batch in batches:
            index = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("row_id", "url", "payload", "refers_to")), strict=True):
                if writer is None:
                    name = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                data = record(*row[:3], digest(row[2]), row[3])
                index.append((row[0], name, *writer.add(data), len(data)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["page_id", "bundle", "frame", "offset", "length"]) if index else pa.RecordBatch.from_pylist([], pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())]))
        if writer is not None:
            writer.close()

    index_path = folder + "-index"
    rows.mapInArrow(write, INDEX).write.parquet(index_path)
    return pages.sparkSession.read.schema(INDEX).parquet(index_path)


def read_archives(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Reads every indexed record at its frame-relative offset: a row a record, with the length and digest of what was read.

    Work is dealt by frame, a few MB each, so that no task depends on a bundle's size. A revisit has no body: its length
    and digest are those of the response that it refers to, as read; without that response reading fails. A body that
    doesn't fit its digest fails too.
    """
    places = index.select("bundle", "frame", "offset").repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        opened, reader, held, data = "", None, -1, b""
        for batch in batches:
            out = []
            for bundle, frame, offset in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset")), strict=True):
                if bundle != opened:
                    opened, reader, held = bundle, BundleReader(store.open_input_file(f"{base}/{bundle}")), -1
                if frame != held:
                    held, data = frame, reader.frame(frame)
                head, body, _ = parse(data, offset)
                refers = head.get("warc-refers-to")
                page = head["warc-record-id"][len("<urn:page:") : -1]
                stored = head["warc-payload-digest"].removeprefix("sha1:")
                seen = digest(body) if refers is None else None
                if refers is None and seen != stored:
                    raise ValueError(f"payload of page {page} in {bundle} doesn't match its digest")
                out.append((int(page) if page else None, head["warc-target-uri"], len(body) if refers is None else None, seen, stored, head["warc-type"], int(refers[len("<urn:page:") : -1]) if refers else None, body if with_payload else None))
                if len(out) >= 64:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    records = written(places.mapInArrow(read, RECORD), "records")
    # one response a payload and id: rows that repeat both are one
    responses = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("of_id"), F.col("payload_digest").alias("of_digest")).agg(F.max("payload_bytes").alias("of_bytes"))
    responses = written(responses.where("of_id is not null"), "responses")
    same = (F.col("refers_to") == F.col("of_id")) & (F.col("stored_digest") == F.col("of_digest"))
    revisits = records.where("record_type = 'revisit'").join(responses, same, "left")
    missing = F.raise_error(F.concat(F.lit("revisit without its response: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    told = lambda c: F.coalesce(F.col(f"of_{c}"), missing.cast("long" if c == "bytes" else "string")).alias(f"payload_{c}")
    revisits = revisits.select("page_id", "url", told("bytes"), told("digest"), "stored_digest", "record_type", "refers_to", "payload")
    return records.where("record_type = 'response'").unionByName(revisits)


def fetch(index: DataFrame, folder: str, page_id: int) -> list[tuple[dict[str, str], bytes]]:
    """The records of one page: one frame is read for each, at the frame-relative offset."""
    store, base = filesystem(folder)
    found = []
    for row in index.where(F.col("page_id") == page_id).collect():
        frame = BundleReader(store.open_input_file(f"{base}/{row.bundle}")).frame(row.frame)
        found.append(parse(frame, row.offset)[:2])
    return found


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder and returns what reading them back gives."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
