"""WARC archives: exact round trip, revisits, coalesced reads."""

import gzip
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.llm.warc import ranges, read_records, sha1_base32, write_archives

SCHEMA = "page_id long, url string, html string, sha1 int, row string"
PAGES = [
    (1, "http://a/1", "<p>same</p>", 1, "x"),
    (2, "http://a/2", "<p>same</p>", 1, None),
    (3, None, "<p>other \U0001f600 é</p>\r\n\r\nWARC/1.1\r\n", 1, "x"),
    (4, "http://a/4 with\r\nbreak", None, 1, "x"),
    (5, "http://a/5", "", None, "x"),
    (6, "http://a/6", "y" * 300_000, 1, "x"),
    (6, "http://a/6", "y" * 300_000, 1, "x"),
    (None, "http://a/0", "<p>same</p>", 1, "x"),
    (None, None, "alone", 1, "x"),
]


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/warc"


def test_round_trip(spark, folder):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    index = write_archives(pages, folder)
    found = read_records(index, folder).collect()
    assert len(found) == len(PAGES) == index.count()
    for r in found:
        html = next(p[2] for p in PAGES if p[0] == r["page_id"] and (p[0] is not None or p[1] == r["url"])) or ""
        data = html.encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == sha1_base32(data)
        if r["record_type"] == "response":
            assert r["payload"] == data and r["refers_to"] is None
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"] or 0) for r in found)
    assert kinds == [
        ("1", "revisit", 2),
        ("2", "response", 0),
        ("3", "response", 0),
        ("4", "revisit", 5),
        ("5", "response", 0),
        ("6", "response", 0),
        ("6", "revisit", 6),
        ("None", "response", 0),
        ("None", "revisit", 2),
    ]


def test_index_names_exact_members(spark, folder, tmp_path):
    index = write_archives(spark.createDataFrame(PAGES, SCHEMA), folder, archive_bytes=200).collect()
    assert len({r["archive"] for r in index}) > 1
    for r in index:
        data = (tmp_path / "warc" / r["archive"]).read_bytes()[r["offset"] : r["offset"] + r["length"]]
        raw = gzip.decompress(data)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    for name in {r["archive"] for r in index}:
        whole = gzip.decompress((tmp_path / "warc" / name).read_bytes())
        assert whole.count(b"WARC-Type: ") == sum(r["archive"] == name for r in index)


def test_selected_records_and_least_payload(spark, folder):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    index = write_archives(pages, folder, least_bytes=1000)
    chosen = index.where(F.col("page_id").isin(1, 3))
    found = read_records(chosen, folder, gap=0).collect()
    assert sorted(r["page_id"] for r in found) == [1, 3]
    assert read_records(index, folder).where("record_type = 'revisit'").count() == 1
    assert read_records(write_archives(pages.limit(0), folder), folder).count() == 0


def test_damaged_archive_fails(spark, folder, tmp_path):
    index = write_archives(spark.createDataFrame(PAGES[:1], SCHEMA), folder)
    name = index.first()["archive"]
    path = tmp_path / "warc" / name
    raw = gzip.decompress(path.read_bytes()).replace(b"same", b"sham")
    data = gzip.compress(raw, 6, mtime=0)
    path.write_bytes(data)
    damaged = index.withColumn("length", F.lit(len(data)).cast("long"))
    with pytest.raises(Exception, match="payload and digest differ"):
        read_records(damaged, folder).collect()


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 30)), max_size=30))
def test_ranges_cover_each_record_once(steps):
    offsets, lengths, at = [], [], 0
    for gap, length in steps:
        offsets.append(at + gap)
        lengths.append(length)
        at += gap + length
    found = ranges(offsets, lengths, gap=10, most=60)
    assert [i for a, b in found for i in range(a, b + 1)] == list(range(len(steps)))
    for a, b in found:
        assert a == b or offsets[b] + lengths[b] - offsets[a] <= 60
        assert all(offsets[i + 1] - offsets[i] - lengths[i] <= 10 for i in range(a, b))


def test_digest_form():
    assert sha1_base32(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert hashlib.sha1(b"").hexdigest().startswith("da39")
