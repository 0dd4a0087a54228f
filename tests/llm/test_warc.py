"""WARC archives: exact round trips, segments, revisits, broken input."""

import base64
import hashlib

import check_oracle
import pytest
from reelweave.llm import warc
from reelweave.session import fresh_folder


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **options):
    path = fresh_folder(spark, "warc")
    warc.write_archives(rows, path, **options)
    return path, warc.read_archives(spark, path)


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert check_oracle.compare(spark, check_oracle.connect(folder), folder, "op6_warc_archives") == ""


def test_segments_give_back_every_payload(spark):
    texts = ["", "é" * 5000, "x" * 100_000, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n", "漢字" * 9000, "y"]
    rows = spark.createDataFrame([(k, f"http://x/{k}", t) for k, t in enumerate(texts)], "page_id BIGINT, url STRING, html STRING")
    for options in ({}, {"segment_bytes": 700, "records_per_file": 11}, {"segment_bytes": 64}):
        _, records = round_trip(spark, rows, **options)
        found = {r.record_id.split(":")[2]: r for r in records.collect()}
        assert len(found) == len(texts) and all(r.complete for r in found.values())
        assert all(bytes(found[str(k)].payload) == t.encode() for k, t in enumerate(texts))
        assert all(found[str(k)].declared_digest == digest(t) and found[str(k)].target_uri == f"http://x/{k}" for k, t in enumerate(texts))


def test_revisits_and_odd_rows(spark, values):
    rows = spark.createDataFrame(
        [(1, "u", "same", "x"), (9, "u v\r\nEvil: 1", "same", "x"), (4, None, "same", "x"), (2, "u", None, "x"), (3, "u", "", "x"), (None, "u", "same", "x"),
         (7, "a", "twice", "x"), (7, "a", "twice", "x"), (7, "b", "twice", "x"), (8, "z", "s" * 3000, "x"), (8, "z", "s" * 3000, "x")],
        "page_id BIGINT, url STRING, html STRING, digest STRING",
    )
    _, records = round_trip(spark, rows, segment_bytes=500)
    assert values(warc.page_digests(records)) == sorted(
        [
            (1, 4, digest("same"), "revisit", 9), (9, 4, digest("same"), "response", None), (4, 4, digest("same"), "revisit", 9),
            (2, 0, digest(""), "revisit", 3), (3, 0, digest(""), "response", None), (None, 4, digest("same"), "revisit", 9),
            (7, 5, digest("twice"), "revisit", 7), (7, 5, digest("twice"), "revisit", 7), (7, 5, digest("twice"), "response", None),
            (8, 3000, digest("s" * 3000), "response", None), (8, 3000, digest("s" * 3000), "response", None),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    _, records = round_trip(spark, rows, min_bytes=5)
    found = values(warc.page_digests(records))
    assert [r[3] for r in found if r[1] == 4] == ["response"] * 4 and [r[3] for r in found if r[1] == 0] == ["response"] * 2
    path, records = round_trip(spark, rows.limit(0))
    assert records.count() == 0


def test_incomplete_segments_are_marked(spark):
    rows = spark.createDataFrame([(1, "u", "z" * 5000), (2, "v", "ok")], "page_id BIGINT, url STRING, html STRING")
    path, _ = round_trip(spark, rows, segment_bytes=1000)
    archive = b"".join(
        warc.unzipped(r.content) for r in spark.read.format("binaryFile").load(path).select("content").collect()
    )
    records = [warc.record({k: v for k, v in h.items() if k != "content-length"}, b) for h, b in warc.cut_records(archive)]
    assert len(records) == 7
    for lost in (0, 2, 5):
        folder = fresh_folder(spark, "warc")
        kept = [r for k, r in enumerate(sorted(records, key=lambda r: b"urn:page:2" in r)) if k != lost]
        lines = spark.createDataFrame([(r.decode(),) for r in kept], "value STRING").coalesce(1)
        lines.write.option("lineSep", "\r\n\r\n").text(folder)
        found = {r.record_id.split(":")[2]: (r.complete, r.payload) for r in warc.read_archives(spark, folder).collect()}
        assert found["1"] == (False, None) and found["2"][0]


def test_framing():
    assert warc.dechunked(warc.chunked(b"a" * 20_000)) == b"a" * 20_000
    assert warc.dechunked(b"5;ext=1\r\nhello\r\n0\r\nTrailer: x\r\n\r\n") == b"hello"
    for broken in (b"", b"5\r\nhell", b"zz\r\n", b"5\r\nhelloXX0\r\n\r\n"):
        assert warc.dechunked(broken) is None
    with pytest.raises(ValueError):
        list(warc.cut_records(b"no record"))
