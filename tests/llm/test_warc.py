import base64
import hashlib
import struct
from collections import Counter

import zstandard

from lectern.llm import warc

ROWS = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, None), (4, "http://d/\r\nX: y", ""), (5, "http://e/", "é" * 1000),
    (6, "http://f/", "long " * 200_000), (6, "http://f/", "long " * 200_000), (7, "http://g/", "WARC/1.1\r\n\r\nno record\r\n\r\n"), (None, "http://h/", "<p>one</p>"),
    (None, "http://i/", "only here"),
]


def frame(spark):
    return spark.createDataFrame([(*r, 1, "x") for r in ROWS], "page_id bigint, url string, html string, id int, digest string").repartition(3)


def wanted():
    out = Counter()
    for page, _, body in ROWS:
        body = (body or "").encode()
        last = max((p for p, _, b in ROWS if p is not None and (b or "").encode() == body), default=None)
        revisit = page != last
        out[page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", last if revisit else None] += 1
    return out


def test_round_trip(spark):
    got = Counter(map(tuple, warc.round_trip(frame(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))
    assert got == wanted()
    assert warc.round_trip(frame(spark).limit(0)).collect() == []


def test_records_by_id(spark, tmp_path):
    index, folder = warc.archive(frame(spark), f"file://{tmp_path}/w", warc.Layout(frame_bytes=2000, bundle_bytes=4000))
    assert index.count() == len(ROWS) and index.select("bundle").distinct().count() > 1
    ids = spark.createDataFrame([(5,), (7,), (99,), (None,)], "record_id bigint")
    got = {r.record_id: bytes(r.payload).decode() for r in warc.fetch(index, ids, folder).collect()}
    assert got == {"5": "é" * 1000, "7": ROWS[7][2]}
    everything = warc.read_archives(index, folder).collect()
    assert sorted(len(r.payload) for r in everything if r.payload is not None) == sorted(
        len((b or "").encode()) for p, _, b in ROWS if not (b == "<p>one</p>" and p != 2) and not (p == 3))


def test_bundles_are_plain_zstandard(spark, tmp_path):
    """Any reader decompresses a bundle from its start; the seek table is a skippable frame."""
    index, folder = warc.archive(frame(spark), str(tmp_path / "w"), warc.Layout(frame_bytes=500))
    for path in (tmp_path / "w").glob("*.zst"):
        data = path.read_bytes()
        assert struct.unpack("<I", data[-4:])[0] == warc.SEEKABLE
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        at, n = 0, 0
        while at < len(plain):
            headers, _, at = warc.parse_record(plain, at)
            assert headers["warc-type"] in ("response", "revisit") and "x" not in headers
            n += 1
        assert n == index.where(index.bundle == path.name).count()
