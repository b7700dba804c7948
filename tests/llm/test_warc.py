import gzip
import hashlib
import random
from collections import Counter

import pytest

from tests.conftest import MEDIUM
from txnrisk.llm import warc
from txnrisk.llm.warc import build_index, file_system, lookup, read_records, round_trip, write_archives

SCHEMA = "page_id long, url string, html string"


def plain(pages):
    """The expected rows of (id, url, html) pages."""
    firsts = {}
    for page, _, html in pages:
        if page is not None:
            firsts[html or ""] = min(page, firsts.get(html or "", page))
    rows = []
    for page, _, html in pages:
        payload = (html or "").encode()
        first = firsts.get(html or "") if len(payload) >= 100 else None
        revisit = first is not None and page != first
        digest = hashlib.sha256(payload).hexdigest()
        rows.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return Counter(rows)


def rows_of(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.fixture(scope="module")
def odd_pages():
    rnd = random.Random(2)
    long = "<p>" + "long page " * 200_000
    bodies = ["x" * 99, "x" * 100, "é" * 49 + "x", "é" * 50, long, "WARC/1.1\r\n\r\n" * 20, "\x00\r\n" * 60, "same " * 40]
    urls = ["http://A.Example.com/p?q#f", "https://a.example.com/P", "no scheme", "", None, "http://", "http://é.de/ü x\n",
            "http://u@h.org:80/", "http://x.org/" + "long/" * 2000, "a://b://c/d"]
    pages = [(i, rnd.choice(urls), rnd.choice(bodies)) for i in range(300)]
    pages += [(5000 - i, f"http://h{i % 7}.org/{i}", "hot " * 30) for i in range(400)]
    pages += [(9000, None, None), (9001, "http://e.org/", ""), (None, "http://n.org/", "same " * 40), (None, None, "only nulls " * 20)]
    pages += [(None, None, "only nulls " * 20), (7, "http://tie.org/", "tie " * 50), (7, "http://tie.org/", "tie " * 50), (8, None, "tie " * 50)]
    return pages


def test_against_plain_rows(spark, odd_pages, monkeypatch):
    monkeypatch.setattr(warc, "HOT_SHARE", 4)
    frame = spark.createDataFrame(odd_pages, SCHEMA).repartition(3)
    assert rows_of(round_trip(frame)) == plain(odd_pages)


def test_small_blocks_parts_and_archives(spark, odd_pages, monkeypatch):
    """Keys that run over many blocks and parts, archives and reads of a few records."""
    for name, value in (("BLOCK_CAPTURES", 3), ("PART_CAPTURES", 20), ("ARCHIVE_BYTES", 3000), ("GROUP_QUERIES", 10)):
        monkeypatch.setattr(warc, name, value)
    for name, value in (("BLOCK_QUERIES", 2), ("READ_BYTES", 1000), ("READ_GROUP_BYTES", 2000), ("BOUND_BYTES", 9)):
        monkeypatch.setattr(warc, name, value)
    frame = spark.createDataFrame(odd_pages, SCHEMA).repartition(3)
    captures = write_archives(frame)
    assert captures.select("file").distinct().count() > 10
    index = build_index(captures)
    assert index.directory.select("part").distinct().count() > 10
    found = read_records(lookup(index, frame)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    expected = Counter(tuple(str(v) if i in (0, 4) and v is not None else v for i, v in enumerate(row)) for row in plain(odd_pages).elements())
    assert rows_of(found) == expected


def test_lookup_of_some_urls(spark, odd_pages):
    frame = spark.createDataFrame(odd_pages, SCHEMA).repartition(2)
    index = build_index(write_archives(frame))
    asked = ["http://h3.org/3", "no scheme", None, "http://nobody.org/", "http://a.example.com/p?q#f"]
    found = read_records(lookup(index, spark.createDataFrame([(u,) for u in asked], "url string")), with_payload=True)
    expected = Counter((None if p is None else str(p), u) for p, u, _ in odd_pages if u in asked)
    rows = found.collect()
    assert Counter((row.page_id, row.url) for row in rows) == expected
    html = {str(p): h or "" for p, _, h in odd_pages if p is not None}
    assert all(bytes(row.payload).decode() == html[row.page_id] for row in rows if row.record_type == "response" and row.page_id)


def test_archives_are_warc(spark, odd_pages):
    """Every archive is a series of gzip members with one record each, at the places that were returned."""
    captures = write_archives(spark.createDataFrame(odd_pages, SCHEMA))
    for row in captures.collect():
        system, path = file_system(row.file)
        with system.open_input_file(path) as file:
            raw = gzip.decompress(file.read_at(row.length, row.offset))
        assert raw.startswith(b"WARC/1.1\r\nWARC-Type: re") and raw.endswith(b"\r\n\r\n")
    ends = captures.groupBy("file").agg({"length": "sum"}).collect()
    for file, total in ends:
        system, path = file_system(file)
        assert system.get_file_info(path).size == total


def test_damage_is_noticed(spark):
    raw = warc._record("1", "http://x.org/", hashlib.sha256(b"abc").hexdigest(), 3, None, b"abc", "2024-01-01T00:00:00Z")
    assert warc.Record.parse(raw).payload == b"abc"
    with pytest.raises(ValueError):
        warc.Record.parse(raw.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.Record.parse(raw[:-1])


def test_keys(spark):
    urls = ["http://WWW.Example.com/A?b#c", "https://example.com", "x://é.org:80/", "plain", "", None, "a://b://c/d", "http:///p"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    keys = [row[0] for row in frame.select(warc.reversed_host_key(frame.url)).collect()]
    assert keys == ["com,example,www)/A?b#c", "com,example)", "org:80,é)/", "plain", "", "", "b:)//c/d", ")/p"]


def test_given_pages_other_columns_and_empty_table(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    given = [tuple(row) for row in pages.select("page_id", "url", "html").collect()]
    clash = pages.selectExpr("*", "'a' AS row", "'b' AS digest", "'c' AS key", "1 AS part", "2 AS payload_bytes", "'d' AS first")
    assert rows_of(round_trip(clash)) == plain(given)
    assert round_trip(pages.limit(0)).collect() == []
