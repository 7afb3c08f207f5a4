import base64
import gzip
import hashlib
import io

import pytest

from foldlake.llm import common, warc


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    long = "é<p>" * 60_000
    rows = [(1, "u", "a"), (2, "u\nx%", "a"), (3, None, None), (4, "u", ""), (5, "u", long), (6, "u", long), (7, "u", "single"), (6, "u", long), (None, "u", "a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS sha", "'x' AS keeper", "'x' AS payload")
    out = warc.read(spark, warc.write(df, common.work_path(spark, "warc")))
    got = sorted(map(tuple, out.collect()), key=str)
    largest = {"a": 2, "": 4, long: 6, "single": 7}
    want = []
    for page, _, text in rows:
        keeper = largest[text or ""]
        want.append((page, len((text or "").encode()), sha(text), "response" if page == keeper else "revisit", None if page == keeper else keeper))
    assert got == sorted(want, key=str)
    assert warc.read(spark, warc.write(df.limit(0), common.work_path(spark, "warc"))).count() == 0


def test_threshold_and_segments(spark):
    df = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbbbbbb" * 40), (4, "u", "bbbbbbbb" * 40)], "page_id long, url string, html string")
    out = warc.read(spark, warc.write(df, common.work_path(spark, "warc"), revisit_bytes=10, segment=50)).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in out} == {(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)}


def test_broken_archives(spark):
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc" == warc.unchunked(warc.chunked(b"abc", 2))
    records = warc.records(1, "u", b"x" * 500, 1, segment=100)
    assert len(list(warc.parse(io.BytesIO(gzip.decompress(gzip.compress(b"".join(records))))))) == len(records) > 3
    fields = [(f.get("warc-segment-origin-id", f["warc-record-id"]), int(f["warc-segment-number"]), None, None, b) for f, b in warc.parse(io.BytesIO(b"".join(records[:-1])))]
    df = spark.createDataFrame(fields, "origin string, number int, total long, sha string, block binary")
    with pytest.raises(Exception, match="missing"):
        warc.reassemble(df).collect()
