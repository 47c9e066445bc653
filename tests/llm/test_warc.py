"""WARC archives, index runs, the loser tree and capture histories."""

import hashlib
import heapq
import random
from base64 import b32encode

import pytest
from corpus import with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm.warc_index import LoserTree, base32_of_hex, capture_histories, order_of, records, url_key, write_archives

PAGES = [
    (1, "http://b.example.com/x", "<p>one</p>"),
    (2, "http://a.example.com/", "<p>two</p>\r\n\r\nWARC/1.0\r\n"),
    (3, "http://a.example.com/", "<p>one</p>"),
    (4, "http://www.A.example.com:80/#top", ""),
    (5, None, None),
    (6, "http://x/line\r\nbreak", "é" * 70_000),
    (7, "http://a.example.com/?b=2&a=1", "<p>one</p>"),
    (7, "http://a.example.com/?a=1&b=2", "<p>one</p>"),
    (None, "http://c.example.com/", "<p>one</p>"),
    (None, "http://c.example.com/", "alone"),
]
SCHEMA = "page_id long, url string, html string"


def digest(text):
    return b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 20)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(LoserTree([iter(r) for r in runs], key=lambda x: x)) == list(heapq.merge(*runs))


def test_base32(spark):
    rows = [(x,) for x in ("", "a", "é", "x" * 99)]
    got = spark.createDataFrame(rows, "t string").select("t", base32_of_hex(F.sha1(F.col("t").cast("binary"))).alias("d")).collect()
    assert all(r.d == digest(r.t) for r in got)


def test_histories(spark):
    pages = with_clashes(spark, PAGES, SCHEMA)
    captured = F.timestamp_seconds(F.lit(1_700_000_000) - F.coalesce("page_id", F.lit(0)))
    got = capture_histories(pages, captured=captured).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in PAGES:
        of = first.get(html or "")
        again = of is not None and of != i
        want.append((i, len((html or "").encode()), digest(html), "revisit" if again else "response", of if again else None))
    key = lambda r: tuple(str(x) for x in r)
    found = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    ordered = sorted(got, key=lambda r: (r.slice, r.place))
    keys = [order_of((r.url_key, r.captured, r.id)) for r in ordered]
    assert keys == sorted(keys)
    assert {r.url_key for r in got if r.id in (2, 3, 4)} == {"com,example,a)/"}


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", ""), (2, "u", ""), (3, "u", "long"), (4, "u", "long")], SCHEMA)
    assert {r.id: r.record_type for r in capture_histories(pages, min_bytes=1).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert capture_histories(pages.limit(0)).collect() == []


def test_archives_are_plain_warc(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"http://h/{i}", "x" * i) for i in range(50)], "id long, url string, payload string")
    write_archives(rows.withColumn("captured", F.lit(0).cast("timestamp")), str(tmp_path / "w"))
    found = [r for f in (tmp_path / "w").glob("*.gz") for r in records(f.read_bytes())]
    assert sorted(int(f["Content-Length"]) for f, _ in found) == list(range(50))
    assert all(f["WARC-Type"] == "response" and len(b) == int(f["Content-Length"]) for f, b in found)
    packed = next((tmp_path / "w").glob("*.gz")).read_bytes()
    with pytest.raises(ValueError):
        list(records(packed[: len(packed) // 2]))


def test_order_survives_many_runs(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.randrange(5)}.org/{rng.randrange(3)}", str(rng.randrange(40))) for i in range(300)]
    got = capture_histories(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    ordered = sorted(got, key=lambda r: (r.slice, r.place))
    assert [(r.url_key, r.id) for r in ordered] == sorted((url_key(u), i) for i, u, _ in rows)
    assert len({r.slice for r in got}) > 1


def test_url_keys():
    assert url_key("HTTPS://www.Example.COM:443/A/?b=1&a=2#x") == "com,example)/a?a=2&b=1"
    assert url_key("http://[bad") == "http://[bad" and url_key(None) == ""
