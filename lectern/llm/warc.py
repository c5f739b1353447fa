"""WARC archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with whole records, and at its end a skippable frame with the sizes of
all frames (the published seekable format). A record is found by its bundle, frame and offset within the decompressed frame,
so one read of the footer and one of the frame suffice. Payloads that occur again are written as revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import place, prepare, store

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Frames that a task fetches.
FRAMES_PER_TASK = 64
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Layout:
    """Sizes of a frame before compression and of a bundle after it; a longer record is a frame of its own."""

    frame_bytes: int = 256 << 10
    bundle_bytes: int = 64 << 20
    level: int = 3
    date: str = "1970-01-01T00:00:00Z"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or a path; executors and driver open the same shared folder through it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(record_id) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def _id(urn: str) -> str | None:
    return urn[len("<urn:page:"):-1] or None


def make_record(record_id, url: str | None, payload: bytes, refers_to, revisit: bool, layout: Layout) -> bytes:
    """One WARC record: the payload behind an HTTP header, or for a revisit the header alone."""
    block = HTTP % len(payload) + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(record_id)}", f"WARC-Date: {layout.date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    lines.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    begin = stop + 4
    end = begin + int(headers["content-length"])
    return headers, data[begin:end], end + 4


class BundleWriter:
    """Writes records into frames, and the seek table when it is closed."""

    def __init__(self, folder: str, layout: Layout):
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"  # another one for each attempt of a task
        files, at = filesystem(folder)
        self.out = files.open_output_stream(f"{at}/{self.name}", compression=None)
        self.layout, self.zstd = layout, zstandard.ZstdCompressor(level=layout.level)
        self.held: list[bytes] = []
        self.size = self.written = 0
        self.entries: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        """(bundle, frame, offset within the frame, length)."""
        if self.held and self.size + len(record) > self.layout.frame_bytes:
            self.flush()
        found = (self.name, len(self.entries), self.size, len(record))
        self.held.append(record)
        self.size += len(record)
        return found

    def flush(self) -> None:
        if self.held:
            frame = self.zstd.compress(b"".join(self.held))
            self.out.write(frame)
            self.entries.append((len(frame), self.size))
            self.written += len(frame)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Reads the seek table, then any frame on its own."""

    def __init__(self, folder: str, name: str):
        files, at = filesystem(folder)
        self.file = files.open_input_file(f"{at}/{name}")
        size = self.file.size()
        n, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        width = ENTRY.size + 4 * (flags >> 7)
        table = self.file.read_at(n * width, size - FOOTER.size - n * width)
        self.frames, offset = [], 0
        for k in range(n):
            packed, plain = ENTRY.unpack_from(table, k * width)
            self.frames.append((offset, packed, plain))
            offset += packed

    def frame(self, k: int) -> bytes:
        offset, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, offset), max_output_size=plain)


INDEX = "record_id string, bundle string, frame int, offset bigint, length bigint"


def write_archives(pages: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Writes (id, url, payload, revisit, refers_to) rows; the index, with the places of all records, is stored and returned.

    A lost task writes its bundles anew under other names; the index lists those of finished tasks only.
    """
    files, at = filesystem(folder)
    files.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            rows = []
            for record_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or BundleWriter(folder, layout)
                rows.append((None if record_id is None else str(record_id),
                             *writer.add(make_record(record_id, url, payload, refers_to, revisit, layout))))
                if writer.written >= layout.bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                ["record_id", "bundle", "frame", "offset", "length"])
        if writer:
            writer.close()

    return store(pages.mapInArrow(run, INDEX), "warc-index")


RECORDS = "record_id string, record_type string, url string, payload_bytes bigint, payload_digest string, refers_to string, payload binary"


def _row(headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = headers["warc-type"] == "revisit"
    length = int(head.rpartition(b"Content-Length: ")[2])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {headers['warc-record-id']}")
    return (_id(headers["warc-record-id"]), headers["warc-type"], headers.get("warc-target-uri"), length, digest,
            _id(headers["warc-refers-to"]) if revisit else None, None if revisit else payload)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    names = [part.split()[0] for part in RECORDS.split(", ")]
    width = len(names) if payloads else len(names) - 1
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(width)], names[:width])


def _schema(payloads: bool) -> str:
    return RECORDS if payloads else RECORDS.rpartition(", ")[0]


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the bundles that the index names, frame by frame. Payloads are checked against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                bundle = BundleReader(folder, name)
                for k in range(len(bundle.frames)):
                    data, at, rows = bundle.frame(k), 0, []
                    while at < len(data):
                        headers, block, at = parse_record(data, at)
                        rows.append(_row(headers, block))
                    yield _batch(rows, payloads)

    bundles = store(index.select("bundle").distinct(), "bundles")
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(run, _schema(payloads))


def fetch(index: DataFrame, ids: DataFrame, folder: str, id_col: str = "record_id", payloads: bool = True) -> DataFrame:
    """The records with the given ids: only their frames are read, each once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = bundle = k = data = None
        for batch in batches:
            for wanted, frame, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if wanted != name:
                    name, bundle, k = wanted, BundleReader(folder, wanted), None
                if frame != k:
                    k, data = frame, bundle.frame(frame)
                headers, block, _ = parse_record(data, offset)
                yield _batch([_row(headers, block)], payloads)

    wanted = index.join(ids.select(F.col(id_col).cast("string").alias("record_id")).distinct(), "record_id", "left_semi")
    placed = store(wanted.select("bundle", "frame", "offset"), "wanted")
    frames = max(1, placed.select("bundle", "frame").distinct().count() // FRAMES_PER_TASK)
    placed = placed.repartition(frames, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return placed.mapInArrow(run, _schema(payloads))


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(id, url, payload, revisit, refers_to): of equal payloads the one with the largest id is the response.

    Only ids and digests are grouped; what comes back to the payloads is the list of revisits, keyed by id and digest.
    """
    full = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    digests = full.where(F.octet_length("payload") >= least_bytes).select("id", F.sha1("payload").alias("digest"))
    repeated = digests.groupBy("digest").agg(F.max("id").alias("last"), F.count("*").alias("n")).where("n > 1")
    revisits = digests.join(repeated, "digest").where("not id <=> last").select(
        F.col("id").alias("again"), F.col("digest").alias("same"), F.col("last").alias("refers_to")).distinct()
    revisits = store(revisits, "revisits")
    return full.join(revisits, (F.col("id").eqNullSafe(F.col("again"))) & (F.sha1("payload") == F.col("same")), "left").select(
        "id", "url", "payload", F.col("same").isNotNull().alias("revisit"), "refers_to")


def archive(pages: DataFrame, folder: str | None = None, layout: Layout = Layout(), id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", least_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes the pages and returns the index and the folder (a new one in the shared folder unless given).

    A null payload is empty. Rows with the same id and payload are written alike, each as a record. A null id is smaller
    than any other; payloads that only rows with a null id have are all responses. Other columns aren't read.
    """
    spark = prepare(pages.sparkSession)
    folder = folder or place(spark, "warc")
    return write_archives(mark_revisits(pages, id_col, url_col, payload_col, least_bytes), folder, layout), folder


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of every row, from the archives."""
    index, folder = archive(pages, None, Layout(), id_col, url_col, payload_col)
    kind = pages.schema[id_col].dataType
    return read_archives(index, folder, payloads=False).select(
        F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def check_sql() -> str:
    """The same rows in SQL; base 32 is spelled from the hexadecimal digest, 20 bits at a time."""
    letters = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(sha1(body), {5 * g + 1}, 5) AS BIGINT) >> {15 - 5 * k}) & 31 AS INTEGER), 1)"
        for g in range(8) for k in range(4))
    return f"""
    WITH full_pages AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    marked AS (SELECT page_id, body, max(page_id) OVER (PARTITION BY body) AS last FROM full_pages)
    SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {letters} AS payload_digest,
           CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> last THEN last END AS refers_to
    FROM marked"""
