import base64
import hashlib
import io
import os
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from footfall.llm import warc


SMALL = {"frame": 2_000, "bundle": 20_000}


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def wanted(pages):
    rows = pages.select("page_id", "html").collect()
    first = {}
    for r in sorted((r for r in rows if r.page_id is not None), key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    out = []
    for r in rows:
        least = first.get(r.html or "")
        later = least is not None and r.page_id != least
        out.append((r.page_id, len((r.html or "").encode()), digest(r.html), "revisit" if later else "response",
                    least if later else None))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    pages = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 100_000).where("page_id % 3 = 0"))
    assert found(warc.archived(pages)) == wanted(pages)
    assert found(warc.read_records(spark, warc.write_bundles(pages, **SMALL))) == wanted(pages)


def test_payloads_and_lookups(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    path = warc.write_bundles(pages, str(tmp_path / "warc"), **SMALL)
    by_id = {r.page_id: r for r in pages.collect()}
    for r in warc.read_records(spark, path).where("record_type = 'response'").collect():
        assert bytes(r.payload).decode() == by_id[r.page_id].html
    some = sorted(by_id)[3:40:9]
    assert sorted(r.page_id for r in warc.read_records(spark, path, some).collect()) == some
    assert warc.record_map(spark, path).count() == len(by_id)


def test_format(spark, sf, tmp_path):
    """Any Zstandard reader gets the records; the seek table and the record map lead to each one."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    path = warc.write_bundles(pages, str(tmp_path / "warc"), **SMALL)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 3
    records = {}
    for name in files:
        with open(name, "rb") as file:
            raw = file.read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        assert plain.startswith(b"WARC/1.1\r\n") and plain.endswith(b"\r\n\r\n")
        count, = struct.unpack_from("<I", raw, len(raw) - 9)
        table = [struct.unpack_from("<II", raw, len(raw) - 9 - 8 * (count - k)) for k in range(count)]
        assert sum(size for _, size in table) == len(plain)
        records[os.path.basename(name)] = raw
    for row in warc.record_map(spark, path).collect():
        raw = records[os.path.basename(row.path)]
        frame = zstandard.ZstdDecompressor().decompress(raw[row.frame_offset:row.frame_offset + row.frame_size])
        record = frame[row.offset:row.offset + row.length]
        assert f"WARC-Record-ID: <urn:page:{row.page_id}>\r\n".encode() in record


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, None), (2, "http://a/b c\r\nX: y", ""), (3, "u", "p" * 100_000), (4, "ü", "p" * 100_000), (4, "ü", "q"),
            (4, "ü", "q"), (None, "n", "q"), (None, None, "only"), (6, "v", "é\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' AS payload", "1 AS record_type", "2 AS first_id")
    assert found(warc.archived(pages)) == wanted(pages)
    path = warc.write_bundles(pages, str(tmp_path / "warc"))
    urls = {r.page_id: r.url for r in warc.read_records(spark, path).collect()}
    assert urls[1] is None and urls[2] == "http://a/b%20c%0D%0AX:%20y" and urls[4] == "ü"
    assert warc.archived(pages.where("false")).count() == 0
    large = warc.read_records(spark, warc.write_bundles(pages, min_bytes=10)).where("record_type = 'revisit'").collect()
    assert [r.page_id for r in large] == [4]


def test_torn_bundle_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    path = warc.write_bundles(pages, str(tmp_path / "warc"))
    name, = (f for f in (os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")) if os.path.getsize(f))
    with open(name, "rb") as file:
        raw = file.read()
    os.makedirs(tmp_path / "torn")
    with open(tmp_path / "torn" / "part-0", "wb") as file:
        file.write(raw[:-1])
    with pytest.raises(Exception, match="footer is missing"):
        warc.read_records(spark, str(tmp_path / "torn")).count()
