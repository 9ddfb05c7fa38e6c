from __future__ import annotations

import random

from pyspark.sql import functions as F

from tabforge.llm import warc_revisits as wr

SCHEMA = "record_id string, uri string, date long, type string, status int, headers map<string,string>, digest string"


def response(i, uri, date, status=200, digest=None, **headers):
    return (i, uri, date, "response", status, {k.replace("_", "-"): v for k, v in headers.items()}, digest)


def revisit(i, uri, date, digest=None, **headers):
    return (i, uri, date, "revisit", 304, {k.replace("_", "-"): v for k, v in headers.items()}, digest)


def resolve(spark, records, **options):
    return {r["record_id"]: r for r in wr.resolve_revisits(spark.createDataFrame(records, SCHEMA), **options).collect()}


def test_canonical_uris(spark):
    pairs = {
        "HTTP://WWW.Example.com:80/a?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2",
        "https://example.com": "example.com/",
        "https://example.com/?ref=z": "example.com/",
        "https://Example.com:8443/A/b?referral=1": "example.com:8443/A/b?referral=1",
        "not a uri#x": "not a uri",
        "": "",
    }
    found = spark.createDataFrame(list(pairs.items()), "u string, e string").withColumn("c", wr.canonical_uri("u")).collect()
    assert [r["c"] for r in found] == [r["e"] for r in found]


def test_outcomes_and_merged_fields(spark):
    rows = [
        response("r1", "http://a.org/x", 10, ETag='"1"', Content_Type="text/html", Cache_Control="a", Content_Length="5"),
        response("r2", "http://a.org/x", 20, ETag='"2"', Last_Modified="mon", X="1"),
        response("bad", "http://a.org/x", 25, status=500, ETag='"2"'),
        revisit("before", "http://a.org/x", 10, ETag='"1"'),
        revisit("first", "https://www.a.org/x#y", 11, etag='W/"1"', Cache_Control="b", Content_Type="text/plain", Connection="close", Date="d"),
        revisit("second", "http://a.org/x?utm_id=7", 30, ETag='"2"'),
        revisit("other", "http://a.org/x", 31, ETag='"9"'),
        revisit("dated", "http://a.org/x", 32, Last_Modified="mon"),
        revisit("bare", "http://a.org/x", 33),
        revisit("nowhere", "http://b.org/", 33, ETag='"2"'),
        revisit("lost", None, 33, ETag='"2"'),
        revisit("timeless", "http://a.org/x", None, ETag='"2"'),
        response("null", None, 1, ETag='"2"'),
    ]
    found = resolve(spark, rows)
    assert {k: (r["outcome"], r["refers_to"]) for k, r in found.items()} == {
        "before": ("missing", None),
        "first": ("resolved", "r1"),
        "second": ("resolved", "r2"),
        "other": ("mismatch", None),
        "dated": ("resolved", "r2"),
        "bare": ("unchecked", "r2"),
        "nowhere": ("missing", None),
        "lost": ("missing", None),
        "timeless": ("missing", None),
    }
    assert found["first"]["merged"] == {"etag": 'W/"1"', "content-type": "text/html", "cache-control": "b", "content-length": "5", "date": "d"}
    assert found["first"]["refers_to_date"] == 10


def test_digests_and_field_names(spark):
    rows = [
        response("r", "http://a.org/", 1, digest="d1", ETag='"1"'),
        revisit("same", "http://a.org/", 2, digest="d1"),
        revisit("other", "http://a.org/", 3, digest="d2", ETag='"1"'),
        ("twice", "http://a.org/", 4, "revisit", 304, {"ETag": '"0"', "etag": '"1"'}, None),
        ("none", "http://a.org/", 5, "revisit", 304, None, None),
    ]
    assert {k: r["outcome"] for k, r in resolve(spark, rows).items()} == {"same": "resolved", "other": "mismatch", "twice": "resolved", "none": "unchecked"}


def test_hot_uri_over_many_ranges_against_brute_force(spark):
    rng, rows = random.Random(4), []
    for i in range(900):
        uri = "http://hot.org/" if rng.random() < 0.5 else f"http://s{rng.randrange(40)}.org/"
        date = rng.randrange(300) if rng.random() < 0.9 else 150
        rows.append((response if rng.random() < 0.4 else revisit)(f"{i:04d}", uri, date, ETag=f'"{rng.randrange(3)}"'))
    found = resolve(spark, rows, rows=40)
    for i, uri, date, kind, _, headers, _ in rows:
        if kind == "revisit":
            earlier = max(((r[2], r[0], r[5]["ETag"]) for r in rows if r[3] == "response" and r[1] == uri and r[2] < date), default=None)
            expected = "missing" if earlier is None else "resolved" if earlier[2] == headers["ETag"] else "mismatch"
            assert (found[i]["outcome"], found[i]["refers_to"]) == (expected, earlier[1] if expected == "resolved" else None)


def test_timestamps_repeats_empty_and_clashing(spark):
    rows = [response("r", "http://a.org/", 1, ETag='"1"'), *[revisit("v", "http://a.org/", 9, ETag='"1"')] * 3]
    records = spark.createDataFrame(rows, SCHEMA).withColumn("date", F.timestamp_seconds("date"))
    found = wr.resolve_revisits(records.selectExpr("*", "1 AS key", "2 AS OUTCOME", "3 AS target", "4 AS own")).collect()
    assert [r["outcome"] for r in found] == ["resolved"] * 3 and found[0]["target"] == 3
    assert wr.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
