"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit record says that a page had not changed; its content is that of the latest
earlier full response of the same canonical URL. The as-of join finds that response, the
validators tell whether it is the one the server meant (entity tags, compared weakly;
without a tag on both sides the modification dates; without those the payload digests),
and the headers that a not-modified answer may bring replace those of the response.

The join is one sorted pass. Records, without payloads, are range-partitioned by (URL,
time), so a URL with a third of all records spans many partitions. In each, the latest
response before each revisit is a window over its own rows; what a partition needs from
those before it is one response per URL that spans several, found from each partition's
last response by a window over partitions. No URL is ever whole in one task.

Canonical URLs: scheme, `www.`, default port, fragment, tracking parameters and trailing
slash go; the host is in lower case; parameters are sorted.

Defined results: a revisit with a null URL or time has no response; a response at the
same time is not earlier; of responses at one time the one with the largest record id is
latest; rows that repeat a record are resolved each; null headers count as none, names
that differ only by case count as one, the last of them by spelling; empty tables give an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obstar.llm.common import let, prepare
from obstar.session import materialize

# Headers a not-modified answer may update, and parameters that only track.
PERMITTED = "age cache-control content-location date etag expires last-modified vary".split()
TRACKING = "^(utm_[a-z]*|gclid|fbclid|ref)(=.*)?$"

RESOLVED, CHANGED, MISSING = "resolved", "validator_mismatch", "no_earlier_response"
_FIELDS = ["record_id", "etag", "last_modified", "digest", "headers"]


def canonical_url(url: Column) -> Column:
    """Host in lower case, path and sorted parameters, without what does not tell pages apart."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_replace(bare, "\\?.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(place, "^[^/]*", 0)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "/.*$", 0), "/+$", "")
    given = F.split(F.regexp_extract(bare, "\\?(.*)$", 1), "&", -1)
    parameters = F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&")))
    return F.concat(host, path, F.coalesce(query, F.lit("")))


def lowered(headers: Column) -> Column:
    """Headers by lower-case name; of names that differ by case, the last by spelling."""
    none = F.create_map().cast("map<string,string>")
    entries = F.transform(
        F.array_sort(F.map_entries(F.coalesce(headers, none))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )

    def last(found: Column, names: Column) -> Column:
        return F.filter(
            found,
            lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), e["key"]),
        )

    def once(found: Column, names: Column) -> Column:
        different = F.size(F.array_distinct(names)) == F.size(names)
        return F.map_from_entries(F.when(different, found).otherwise(last(found, names)))

    # bound by lambdas, so that each part is worked out once a row
    return let(entries, lambda found: let(F.transform(found, lambda e: e["key"]), lambda names: once(found, names)))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers with those the revisit may replace."""
    update = F.map_filter(lowered(revisit), lambda k, v: k.isin(PERMITTED) & v.isNotNull())

    def merged(new: Column, names: Column) -> Column:
        kept = F.map_filter(lowered(response), lambda k, v: ~F.array_contains(names, k))
        return F.map_concat(kept, new)

    return let(update, lambda new: let(F.map_keys(new), lambda names: merged(new, names)))


def same_content(revisit: dict[str, Column], response: Column) -> Column:
    """Whether the validators say that the response is what the revisit stands for."""

    def weak(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    tags = weak(revisit["etag"]) == weak(response["etag"])
    dates = revisit["last_modified"] == response["last_modified"]
    digests = revisit["digest"] == response["digest"]
    return F.coalesce(tags, dates, digests, F.lit(False))


def latest_earlier(records: DataFrame) -> DataFrame:
    """Every revisit with `response`, the latest earlier full response of its URL, or null.

    `records` has record_id, url_key, time, is_revisit, etag, last_modified, digest, headers.
    """
    response = F.when(~F.col("is_revisit"), F.struct(*_FIELDS))
    order = ["url_key", "time", F.desc("is_revisit"), "record_id"]
    ranged = records.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = materialize(ranged, "records", records.sparkSession)

    # at equal times revisits come first: what comes before them is earlier
    before = (
        Window.partitionBy("url_key", "part")
        .orderBy("time", F.desc("is_revisit"), "record_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = placed.withColumn("own", F.last(response, ignorenulls=True).over(before)).where("is_revisit")

    at_end = placed.groupBy("url_key", "part").agg(
        F.max(F.when(~F.col("is_revisit"), F.struct("time", "record_id"))).alias("at"),
        F.max_by(response, F.when(~F.col("is_revisit"), F.struct("time", "record_id"))).alias("last"),
    )
    earlier = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        at_end.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
        .where(F.col("carried").isNotNull())
        .select(F.col("url_key").alias("_key"), F.col("part").alias("_part"), "carried")
    )
    same = (F.col("url_key") == F.col("_key")) & (F.col("part") == F.col("_part"))
    return own.join(carried, same, "left").select(
        *records.columns, F.coalesce("own", "carried").alias("response")
    )


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url_key, response_id, resolution, headers) of every revisit.

    `records` has record_id, url, time, is_revisit, etag, last_modified, digest and headers.
    """
    prepare(records.sparkSession)
    keyed = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "time", "is_revisit", *_FIELDS[1:])
    usable = F.col("url_key").isNotNull() & F.col("time").isNotNull()
    keyed = materialize(keyed, "captures", records.sparkSession)
    joined = latest_earlier(keyed.where(usable))
    lost = keyed.where(F.col("is_revisit") & ~usable)
    nothing = F.lit(None).cast(joined.schema["response"].dataType)
    every = joined.unionByName(lost.withColumn("response", nothing))

    found = F.col("response").isNotNull()
    valid = same_content({c: F.col(c) for c in _FIELDS}, F.col("response"))
    state = F.when(~found, MISSING).when(valid, RESOLVED).otherwise(CHANGED)
    return every.withColumn("resolution", state).select(
        "record_id",
        "url_key",
        F.col("response.record_id").alias("response_id"),
        "resolution",
        F.when(
            F.col("resolution") == RESOLVED, merged_headers(F.col("response.headers"), F.col("headers"))
        ).alias("headers"),
    )


def _headers(**values: Column) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k.replace("_", "-")), v)])


def _response(rows: DataFrame) -> DataFrame:
    """Full responses of (record_id, url, time, tag, modified, digest)."""
    return rows.select(
        "record_id",
        "url",
        "time",
        F.lit(False).alias("is_revisit"),
        F.col("tag").alias("etag"),
        F.col("modified").alias("last_modified"),
        "digest",
        _headers(
            Content_Type=F.lit("text/html"),
            Content_Length=F.lit("1000"),
            ETag=F.col("tag"),
            Date=F.col("modified"),
            Cache_Control=F.lit("max-age=60"),
        ).alias("headers"),
    )


def _answer(rows: DataFrame) -> DataFrame:
    """Not-modified answers of (record_id, url, time, tag, modified)."""
    at = F.col("time").cast("string")
    return rows.select(
        "record_id",
        "url",
        "time",
        F.lit(True).alias("is_revisit"),
        F.concat(F.lit("W/"), F.col("tag")).alias("etag"),
        F.col("modified").alias("last_modified"),
        F.lit(None).cast("string").alias("digest"),
        _headers(
            Content_Length=F.lit("0"), Date=at, Expires=at, Set_Cookie=F.lit("id=1"), Vary=F.lit("accept")
        ).alias("headers"),
    )


def captures(pages: DataFrame, epoch: int = 1000, visits: int = 5) -> DataFrame:
    """Archive records of the pages and of the front pages of their hosts.

    A page has a full response and, an hour later, a not-modified answer by a URL written
    another way; where the server had changed the page meanwhile (by the first digit of the
    digest) its tag is another one, and where it sends no tag (the next digits) only a date.

    With each page the front page of its host is visited `visits` times. The front pages
    change every `epoch` pages. By a digit of the digest a visit is a full response or a
    not-modified answer; the answer has the tag of the front page as it is, or as it was an
    epoch ago, or only its date. So a host has many responses and answers in turn, some
    answers before any response, and an answer mostly stands for the response that another
    page's visit brought.
    """
    digest = F.md5(F.col("html").cast("binary"))
    held = pages.select("page_id", "url", digest.alias("digest"), (F.col("page_id") * 60).alias("time"))

    def tag(value: Column | str) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def digit(place: Column | int) -> Column:
        return F.substring("digest", place, 1)

    own = held.withColumn("modified", F.col("time").cast("string"))
    full = own.select(
        (F.col("page_id") * 8).alias("record_id"), "url", "time", tag(F.col("digest")).alias("tag"), "modified", "digest"
    )
    first = digit(1)
    told = F.when(first.isin("0", "1", "2", "3"), tag(F.lit("changed"))).when(
        ~first.isin("4", "5"), tag(F.col("digest"))
    )
    other_url = F.regexp_replace(F.regexp_replace("url", "^http://(www\\.)?", "HTTPS://www."), "#.*$", "#again")
    answer = own.select(
        (F.col("page_id") * 8 + 1).alias("record_id"),
        other_url.alias("url"),
        (F.col("time") + 3600).alias("time"),
        told.alias("tag"),
        "modified",
    )

    host = F.regexp_extract("url", "^[a-z]+://(www\\.)?([^/?#]*)", 2)
    visited = held.withColumn("visit", F.explode(F.sequence(F.lit(0), F.lit(visits - 1)))).select(
        (F.col("page_id") * 8 + 2 + F.col("visit")).alias("record_id"),
        (F.col("time") + 30 + F.col("visit") * 1800).alias("time"),
        host.alias("host"),
        F.expr(f"page_id div {epoch}").alias("now"),
        digit(F.col("visit") + 2).alias("kind"),
        digit(F.col("visit") + 12).alias("told"),
    )
    brings = F.col("kind").isin(*"01234567")
    version = F.when(F.col("told").isin(*"0123"), F.col("now") - 1).otherwise(F.col("now"))
    front = tag(F.concat(F.lit("front-"), F.col("now").cast("string")))
    fronts = visited.where(brings).select(
        "record_id",
        F.concat(F.lit("http://"), "host", F.lit("/")).alias("url"),
        "time",
        front.alias("tag"),
        F.col("now").cast("string").alias("modified"),
        F.md5(F.col("now").cast("string")).alias("digest"),
    )
    answers = visited.where(~brings).select(
        "record_id",
        F.concat(F.lit("HTTPS://WWW."), "host", F.lit(":443/?utm_source=feed")).alias("url"),
        "time",
        F.when(~F.col("told").isin("4", "5"), tag(F.concat(F.lit("front-"), version.cast("string")))).alias("tag"),
        F.col("now").cast("string").alias("modified"),
    )
    return _response(full.unionByName(fronts)).unionByName(_answer(answer.unionByName(answers)))


def headers_text(headers: Column) -> Column:
    """Headers as sorted lines."""
    lines = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(F.array_sort(lines), "\n")
