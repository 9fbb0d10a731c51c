import random

import pytest
from obstar.llm import warc
from pyspark.sql import functions as F

SCHEMA = (
    "record_id long, url string, time long, is_revisit boolean, etag string, last_modified string, "
    "digest string, headers map<string,string>, own string, part string, carried string, response string"
)


def records(spark, *rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def resolved(df):
    return {r["record_id"]: (r["response_id"], r["resolution"], r["headers"]) for r in warc.resolve(df).collect()}


@pytest.mark.parametrize(
    "url, key",
    [
        ("HTTP://WWW.Example.com:80/A/b/?utm_source=x&b=2&a=1#top", "example.com/A/b?a=1&b=2"),
        ("https://example.com", "example.com"),
        ("https://example.com/?ref=x", "example.com"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, key):
    df = spark.createDataFrame([(url,)], "url string").select(warc.canonical_url(F.col("url")).alias("k"))
    assert df.first()["k"] == key


def test_validators_headers_and_edge_cases(spark):
    full = {"ETag": '"a"', "Content-Type": "text/html", "Date": "1", "content-type": "text/plain"}
    answer = {"DATE": "9", "Content-Type": "x", "Expires": "10", "Set-Cookie": "c", "Vary": None}
    df = records(
        spark,
        (1, "http://e.com/a", 10, False, '"a"', "m", "d", full),
        (2, "https://www.e.com/a/", 20, True, 'W/"a"', None, None, answer),
        (3, "http://e.com/a", 10, True, '"a"', None, None, None),  # at the same time: not earlier
        (4, "http://e.com/a", 30, True, '"b"', "m", "d", answer),  # the tag decides
        (5, "http://e.com/a", 30, True, None, "m", None, None),
        (6, "http://e.com/a", 30, True, None, None, "d", None),
        (7, "http://e.com/a", 30, True, None, None, None, None),
        (8, "http://e.com/other", 30, True, '"a"', "m", "d", None),
        (9, None, 30, True, '"a"', "m", "d", None),
        (10, "http://e.com/a", None, True, '"a"', "m", "d", None),
        (11, "http://e.com/a", 40, False, '"n"', None, None, None),
        (12, "http://e.com/a", 40, False, '"o"', None, None, None),
        (13, "http://e.com/a", 50, True, '"o"', None, None, {"Age": "3"}),
    )
    merged = {"etag": '"a"', "content-type": "text/plain", "date": "9", "expires": "10"}
    kept = {"etag": '"a"', "content-type": "text/plain", "date": "1"}
    none = (None, warc.MISSING, None)
    assert resolved(df) == {
        2: (1, warc.RESOLVED, merged),
        3: none,
        4: (1, warc.CHANGED, None),
        5: (1, warc.RESOLVED, kept),
        6: (1, warc.RESOLVED, kept),
        7: (1, warc.CHANGED, None),
        8: none,
        9: none,
        10: none,
        13: (12, warc.RESOLVED, {"age": "3"}),
    }
    assert resolved(records(spark)) == {}


def test_hot_url_over_many_partitions(spark):
    draw = random.Random(4)
    rows, want, last = [], {}, None
    for at in range(2000):
        revisit = draw.random() < 0.97
        url = "http://hot.com/" if draw.random() < 0.8 else f"http://cold.com/{at % 7}"
        rows.append((at, url, at, revisit, '"t"', None, None, None))
    latest = {}
    for record, url, _, revisit, *_ in rows:
        if revisit:
            want[record] = latest.get(url)
        else:
            latest[url] = record
    assert last is None
    df = records(spark, *draw.sample(rows, len(rows)))
    repeated = df.unionByName(df.where("record_id = 5"))
    found = warc.resolve(repeated).collect()
    assert len(found) == len(want) + (5 in want)
    assert {r["record_id"]: r["response_id"] for r in found} == want


def test_captures_make_the_join_choose(spark):
    """At least a third of the answers stand for what another page's visit brought."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = warc.resolve(warc.captures(pages))
    counts = found.groupBy("resolution").count().collect()
    assert {r["resolution"] for r in counts} == {warc.RESOLVED, warc.CHANGED, warc.MISSING}
    total = sum(r["count"] for r in counts)
    others = found.where((F.col("resolution") == warc.RESOLVED) & (F.floor(F.col("record_id") / 8) != F.floor(F.col("response_id") / 8)))
    assert others.count() * 3 >= total
    # a page's own answer is never without a response
    assert found.where((F.col("record_id") % 8 == 1) & (F.col("resolution") == warc.MISSING)).count() == 0
    keys = warc.captures(pages).select(warc.canonical_url(F.col("url")).alias("k"))
    assert keys.where("k like 'www.%'").count() == 0
