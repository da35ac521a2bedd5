from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from waymeter.llm import revisits as R

SCHEMA = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, key string, fields int"


@pytest.mark.parametrize(("url", "want"), [
    ("HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#top", "example.com/a?a=1&b=2"), ("https://u@h.org", "h.org/"), ("h.org:8080/x", "h.org:8080/x"),
    ("http:///x", None), (None, None), ("", None), ("https://h.org/?", "h.org/"),
])
def test_canonical_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(R.canonical_url(F.col("u"))).first()[0] == want


def resolved(spark, rows):
    rows = [(*r, None, 0) for r in rows]
    return {r.record_id: r for r in R.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_validators_and_merged_headers(spark):
    kept = {"ETag": '"a"', "Content-Type": "text/html", "Date": "1", "Last-Modified": "m"}
    got = resolved(spark, [
        (1, "http://h/x", 10, "response", 200, kept),
        (2, "http://h/x", 11, "response", 404, {"ETag": '"b"'}),
        (3, "https://h/x#f", 12, "revisit", 304, {"etag": 'W/"a"', "date": "2", "Content-Length": "0"}),
        (4, "http://h/x", 12, "revisit", 304, {"etag": '"b"'}),
        (5, "http://h/x", 12, "revisit", 304, {"last-modified": "m", "Expires": "9"}),
        (6, "http://h/x", 12, "revisit", 304, {}),
        (7, "http://h/x", 10, "revisit", 304, {"etag": '"a"'}),
        (8, None, 12, "revisit", 304, None),
        (9, "http://h/x", None, "revisit", 304, {"etag": '"a"'}),
    ])
    assert {k: r.outcome for k, r in got.items()} == {3: "resolved", 4: "changed", 5: "resolved", 6: "unchecked", 7: "no_original", 8: "no_original", 9: "no_original"}
    assert [tuple(h) for h in got[3].headers] == [("content-type", "text/html"), ("date", "2"), ("etag", 'W/"a"'), ("last-modified", "m")]
    assert ("expires", "9") in [tuple(h) for h in got[5].headers] and got[4].headers is None


def test_as_of_join_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        url = "http://hot/" if rng.random() < 0.5 else f"http://h{rng.randint(0, 9)}/"
        kind = "revisit" if k % 2 else "response"
        rows.append((k, url, rng.choice([5, rng.randint(0, 300)]), kind, 200 if rng.random() < 0.8 else 500, {"ETag": "t"}))
    got = resolved(spark, rows + rows[:20])
    for i, url, ts, kind, _, _ in rows:
        if kind == "revisit":
            before = [(r[2], r[0]) for r in rows if r[3] == "response" and r[4] == 200 and r[1] == url and r[2] < ts]
            assert got[i].original_id == (max(before)[1] if before else None)


def test_empty_tables(spark):
    assert resolved(spark, []) == {}
    assert resolved(spark, [(1, "http://h/", 1, "response", 200, {})]) == {}
    assert resolved(spark, [(2, "http://h/", 1, "revisit", 304, {})])[2].outcome == "no_original"


def test_derived_records_need_the_latest_of_several(spark, given):
    records = R.records_of(given("pages").select("page_id", "url", "html"))
    pages = given("pages").count()
    assert records.count() == 6 * pages and records.where(F.col("url") == R.FRONT).count() == 2 * pages
    found = R.resolve(records)
    assert found.count() == 3 * pages
    kinds = {r.outcome: r["count"] for r in found.groupBy("outcome").count().collect()}
    assert set(kinds) == {R.RESOLVED, R.CHANGED, R.UNCHECKED, R.MISSING}
