"""WARC records in seekable Zstandard bundles.

A bundle is one file of at most about ``BUNDLE`` bytes of records. The records are grouped into frames that are
compressed each on its own, so any frame can be decompressed without the others. Two skippable frames follow, which
Zstandard readers pass over: the record map, and the seek table of the public seekable format, with compressed and
decompressed size of every frame before it and a fixed footer. The record map gives each record's identifier, frame,
offset within the decompressed frame and length.

Bundles are written by Spark's own file writer, one per file and committed once, to any file system that Spark reaches.
It ends each file with a separator; here that is the last four bytes of the footer, its magic number. A row larger than
the bound makes a bundle of its own.

Pages of equal payload have one response record, that of the smallest page id; the others are revisit records, which
refer to it and carry no payload. Payloads are compared by SHA-1, as web archives do.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.storage import fresh_path, map_arrow, stored

FRAME = 1 << 18
BUNDLE = 16 << 20
LEVEL = 3
MIN_BYTES = 0
# Fixed values of the Zstandard and seekable formats.
SKIPPABLE_MAP = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
# Fixed value of the WARC format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MAP_ROW = struct.Struct("<qIIIB")
_NO_ID = -(1 << 63)
_HEADER = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: five hex digits make four letters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_record_types(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html) -> page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Revisits have no payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    first = stored(rows.where(F.octet_length("payload") >= min_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "first_id"),
        "first_pages")
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", F.when(~later, F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        F.when(later, "revisit").otherwise("response").alias("record_type"),
        F.when(later, F.col("first_id")).alias("refers_to"))


def _record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, kind: str,
            first: int | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    lines += [f"X-Payload-Length: {size}", "Content-Type: text/html"]
    body = payload or b""
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


class _Bundle:
    def __init__(self, frame: int) -> None:
        self.frame = frame
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.map: list[bytes] = []
        self.open = bytearray()
        self.bytes = 0

    def add(self, page: int | None, record: bytes) -> None:
        if self.open and len(self.open) + len(record) > self.frame:
            self.close_frame()
        self.map.append(_MAP_ROW.pack(_NO_ID if page is None else page, len(self.sizes), len(self.open), len(record),
                                      page is None))
        self.open += record
        self.bytes += len(record)

    def close_frame(self) -> None:
        frame = self.compressor.compress(bytes(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), len(self.open)))
        self.open = bytearray()

    def content(self) -> bytes:
        """The bundle without the last four bytes, which the writer adds."""
        if self.open:
            self.close_frame()
        rows = b"".join(self.map)
        record_map = struct.pack("<II", SKIPPABLE_MAP, len(rows)) + rows
        sizes = [*self.sizes, (len(record_map), 0)]
        table = b"".join(struct.pack("<II", *pair) for pair in sizes)
        footer = struct.pack("<IB", len(sizes), 0)
        return (b"".join(self.frames) + record_map + struct.pack("<II", SKIPPABLE_TABLE, len(table) + len(footer) + 4)
                + table + footer)


def _bundles(batches: Iterator[pa.RecordBatch], frame: int, most: int) -> Iterator[pa.RecordBatch]:
    bundle = _Bundle(frame)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bundle.content()], pa.binary())], ["content"])

    for batch in batches:
        for values in zip(*(batch.column(c) for c in
                            ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")),
                          strict=True):
            page, *rest = (v.as_py() for v in values)
            record = _record(page, *rest)
            if bundle.map and bundle.bytes + len(record) > most:
                yield row()
                bundle = _Bundle(frame)
            bundle.add(page, record)
    if bundle.map:
        yield row()


def write_bundles(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES, frame: int = FRAME,
                  bundle: int = BUNDLE) -> str:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the folder of the bundles.

    A NULL html is an empty payload, and empty payloads are equal to each other; a NULL url leaves the target out; control
    characters and blanks of a url are percent-encoded. A NULL page_id is written as an empty identifier and counts as
    the largest. Rows that repeat the smallest page_id of a payload are responses each. Other columns are not used.
    """
    path = path or fresh_path(pages.sparkSession, "warc")
    (map_arrow(with_record_types(pages, min_bytes), lambda it: _bundles(it, frame, bundle), "content binary")
     .select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("encoding", "ISO-8859-1").option("lineSep", FOOTER_MAGIC.to_bytes(4, "little").decode("latin-1")).text(path))
    return path


def _layout(content: memoryview) -> tuple[list[tuple[int, int]], list[tuple]]:
    """(offset, compressed size) of the frames, and the rows of the record map, read from the end of a bundle."""
    if len(content) < 17 or struct.unpack_from("<I", content, len(content) - 4)[0] != FOOTER_MAGIC:
        raise ValueError("not a bundle: its footer is missing")
    count, _ = struct.unpack_from("<IB", content, len(content) - 9)
    table = len(content) - 9 - 8 * count
    if struct.unpack_from("<I", content, table - 8)[0] != SKIPPABLE_TABLE:
        raise ValueError("not a bundle: its seek table is missing")
    sizes = [struct.unpack_from("<II", content, table + 8 * k) for k in range(count)]
    places, at = [], 0
    for size, _ in sizes:
        places.append((at, size))
        at += size
    map_at, map_size = places.pop()
    rows = [_MAP_ROW.unpack_from(content, k) for k in range(map_at + 8, map_at + map_size, _MAP_ROW.size)]
    return places, [(None if empty else page, frame, offset, length) for page, frame, offset, length, empty in rows]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select(
        "path", "content")


def record_map(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, path, frame, frame_offset, frame_size, offset, length) per record."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "path", "frame", "frame_offset", "frame_size", "offset", "length"]
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                places, entries = _layout(memoryview(content.as_buffer()))
                columns = zip(*[(page, name, frame, *places[frame], offset, length)
                                for page, frame, offset, length in entries], strict=True)
                types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return map_arrow(
        _files(spark, path), rows, "page_id long, path string, frame int, frame_offset long, frame_size long, offset long, length long")


def _parsed(record: bytes) -> tuple:
    end = record.index(b"\r\n\r\n") + 4
    fields = {k.decode(): v.decode() for k, v in _HEADER.findall(record[:end])}
    length = int(fields["Content-Length"])
    if record[end + length:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")

    def page(value: str | None) -> int | None:
        number = (value or "")[len("<urn:page:"):-1]
        return int(number) if number else None

    return (page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), int(fields["X-Payload-Length"]),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], page(fields.get("WARC-Refers-To")),
            record[end:end + length])


_RECORD_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
_RECORD_DDL = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, payload binary")


def read_records(spark: SparkSession, path: str, page_ids: list[int] | None = None,
                 with_payload: bool = True) -> DataFrame:
    """The records of the bundles, or those of a few pages: then only frames that hold one are decompressed.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if wanted, payload.
    """
    wanted = None if page_ids is None else set(page_ids)
    types = _RECORD_TYPES if with_payload else _RECORD_TYPES[:-1]
    ddl = _RECORD_DDL if with_payload else _RECORD_DDL.rpartition(",")[0]
    names = [part.split()[0] for part in ddl.split(",")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column("content"):
                bundle = memoryview(content.as_buffer())
                places, entries = _layout(bundle)
                by_frame: dict[int, list[tuple[int, int]]] = {}
                for page, frame, offset, length in entries:
                    if wanted is None or page in wanted:
                        by_frame.setdefault(frame, []).append((offset, length))
                for frame, spans in by_frame.items():
                    at, size = places[frame]
                    plain = reader.decompress(bundle[at:at + size])
                    records = [_parsed(plain[offset:offset + length]) for offset, length in spans]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in records], kind) for k, kind in enumerate(types)], names)

    return map_arrow(_files(spark, path), rows, ddl)


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages and reads the archives back: one row per page, without payloads."""
    return read_records(pages.sparkSession, write_bundles(pages), with_payload=False)
