import gzip
import zlib

import pytest
from pyspark.sql import functions as F

from ferrocar.llm import common, warc
from tests.conftest import SMALL
from tests.llm.sql import difference

PAGES = "page_id long, url string, html string"


def test_given_pages_match_sql(spark):
    assert difference(spark, SMALL, "op5_warc") is None


def test_streams_become_members_that_stand_alone(spark, tmp_path):
    rows = [(i, f"http://a/{i}", "x" * i) for i in range(50)]
    folder = f"file://{tmp_path}"
    warc.write_streams(warc.with_originals(spark.createDataFrame(rows, PAGES).coalesce(1)), f"{folder}/streams")
    stream = bytes(common.read_binary(spark, f"{folder}/streams").first().content)
    one = zlib.decompressobj(31)
    assert one.decompress(stream) == gzip.decompress(stream) and one.eof
    warc.normalise(spark, f"{folder}/streams", f"{folder}/normalised")
    archive = bytes(common.read_binary(spark, f"{folder}/normalised/kind=archive").first().content)
    assert gzip.decompress(archive) == gzip.decompress(stream)
    entries = warc.members(bytes(common.read_binary(spark, f"{folder}/normalised/kind=index").first().content))
    assert len(entries) == 50 and entries[0][0] == 0 and all(sum(a) == b[0] for a, b in zip(entries, entries[1:]))
    one = gzip.decompress(archive[entries[7][0] : sum(entries[7])])
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n" + b"x" * 7 + b"\r\n\r\n")


def test_odd_pages(spark):
    rows = [(5, "u", "same"), (3, "a\r\nb", "same"), (3, "u", "same"), (None, "u", "same"), (7, None, None), (8, "u", ""), (9, "u", "é" * 3_000_000), (10, "u", "\r\n\r\n\x00")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("sha", F.lit("clash")).withColumn("first", F.lit(1))
    got = warc.archived(pages).collect()
    said = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in got)
    want = [(0, 4, "revisit", 3), (3, 4, "response", None), (3, 4, "response", None), (5, 4, "revisit", 3), (7, 0, "response", None), (8, 0, "revisit", 7), (9, 6_000_000, "response", None), (10, 5, "response", None)]
    assert said == want
    assert {r.url for r in got if r.page_id == 3} == {"a%0D%0Ab", "u"}
    assert warc.archived(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.archived(pages, smallest=1).where("page_id IN (7, 8)").collect()} == {"response"}


def test_cut_streams_are_errors():
    whole = gzip.compress(b"abc" * 1000) + gzip.compress(b"")
    assert b"".join(warc.inflated(whole)) == b"abc" * 1000
    with pytest.raises((ValueError, zlib.error)):
        list(warc.inflated(whole[:-25]))
    with pytest.raises(ValueError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))
