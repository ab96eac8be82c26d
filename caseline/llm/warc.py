"""Not-modified revisits resolved to responses: an as-of join by canonical URL.

A revisit with the profile "server not modified" carries no body. It stands for the latest earlier full
response of the same canonical URL, if their validators agree: the entity tags by weak comparison, or,
without both, the modification dates. The resolved capture has the body of the response and its
headers, updated by those that a not-modified answer is permitted to change.

The join carries the last response forward in time. Times are cut into slices; inside a slice of one
URL a window does so, and across slices a window over one row per URL and slice, so that a URL with a
large share of the captures is spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseline.llm.common import whole

#: Header fields that a 304 answer may send to update the stored response, in lower case.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that track visits and name no resource.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid"
SLICES = 256


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www.`` or default port, path without a final slash, query
    without tracking parameters and in order, no fragment. Null stays null."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www\\.|:(80|443)$", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(bare, "^[^/?]*", ""), "\\?.*$", "")
    path = F.regexp_replace(path, "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def weak_tag(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def validators_agree(stored: Column, given: Column) -> Column:
    """Entity tags decide if both have one, else modification dates if both have one, else nothing agrees."""
    a, b = weak_tag(stored["etag"]), weak_tag(given["etag"])
    x, y = stored["last-modified"], given["last-modified"]
    return F.when(a.isNotNull() & b.isNotNull(), a == b).when(x.isNotNull() & y.isNotNull(), F.trim(x) == F.trim(y)).otherwise(False)


def lower_names(headers: Column) -> Column:
    """Field names in lower case; the last of equal names stays. Null is no headers."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>")))


def merged_headers(stored: Column, given: Column) -> Column:
    """The stored fields, with the permitted fields of the not-modified answer in their place."""
    allowed = F.map_filter(given, lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    rest = F.map_filter(stored, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.map_concat(rest, allowed)


def resolve(captures: DataFrame, slices: int = SLICES) -> DataFrame:
    """Every revisit of ``captures`` with the response that it stands for.

    ``captures`` has record_id, url, at (timestamp), kind ("response" or "revisit"), status (int),
    headers (map) and digest (of the body). Full responses are those of kind "response" and status 200.
    Columns: record_id, canonical, at, outcome ("resolved", "changed" if the validators disagree,
    "missing" without an earlier response), response_id, response_at, digest and headers of the resolved
    capture; the last four are null unless resolved, and headers are then those of the revisit alone.

    Earlier means a smaller (at, record_id); a response at the same time counts if its id is smaller.
    Null urls or times resolve to nothing and are missing. Records repeated in full stay repeated.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows = captures.select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical"),
        "at",
        "kind",
        ((F.col("kind") == "response") & (F.col("status") == 200)).alias("full"),
        lower_names(F.col("headers")).alias("headers"),
        "digest",
    ).where(F.col("kind").isin("response", "revisit"))
    dated = rows.where(F.col("at").isNotNull() & F.col("canonical").isNotNull())
    cuts = dated.agg(F.percentile_approx("at", [i / slices for i in range(1, slices)], 10 * slices)).first()[0] or []
    cuts = sorted(set(cuts))
    tiled = dated.withColumn("slice", F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<timestamp>"), lambda c: c < F.col("at"))))
    held = F.when(F.col("full"), F.struct("at", "record_id", "headers", "digest"))
    inside = Window.partitionBy("canonical", "slice").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    ends = tiled.where("full").groupBy("canonical", "slice").agg(F.max(F.struct("at", "record_id")).alias("key"))
    slot = tiled.select("canonical", "slice").distinct().join(ends, ["canonical", "slice"], "left")
    before = Window.partitionBy("canonical").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slot = slot.select("canonical", "slice", F.last("key", ignorenulls=True).over(before).alias("carried"))
    carried = (
        slot.where(F.col("carried").isNotNull())
        .join(tiled.where("full").select("canonical", F.struct("at", "record_id").alias("carried"), F.struct("at", "record_id", "headers", "digest").alias("old")), ["canonical", "carried"])
        .groupBy("canonical", "slice").agg(F.first("old").alias("old"))
    )
    near = tiled.withColumn("near", F.last(held, ignorenulls=True).over(inside)).where(F.col("kind") == "revisit")
    found = near.join(carried, ["canonical", "slice"], "left").withColumn("stored", F.coalesce("near", "old"))
    lost = rows.where((F.col("kind") == "revisit") & (F.col("at").isNull() | F.col("canonical").isNull()))
    every = found.select("record_id", "canonical", "at", "headers", "stored").unionByName(
        lost.select("record_id", "canonical", "at", "headers").withColumn("stored", F.lit(None).cast(found.schema["stored"].dataType))
    )
    agree = validators_agree(F.col("stored.headers"), F.col("headers"))
    every = every.withColumn("outcome", F.when(F.col("stored").isNull(), "missing").when(agree, "resolved").otherwise("changed"))
    good = F.col("outcome") == "resolved"
    return every.select(
        "record_id",
        "canonical",
        "at",
        "outcome",
        F.when(good, F.col("stored.record_id")).alias("response_id"),
        F.when(good, F.col("stored.at")).alias("response_at"),
        F.when(good, F.col("stored.digest")).alias("digest"),
        F.when(good, merged_headers(F.col("stored.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl history of ``pages`` (page_id, url, html): each page fetched, then visited again twice.

    The first visit sends the page's tag, weakly; the second, later one has another tag where the text
    has an even length. Response ids are 3 * page_id, revisit ids follow.
    """
    body = whole(F.col("html"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    tag = F.concat(F.lit('"'), F.md5(body), F.lit('"'))
    pairs = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    day = F.col("page_id").cast("string")
    full = F.struct(
        (3 * F.col("page_id")).alias("record_id"), at.alias("at"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        pairs("ETag", tag, "Content-Length", F.octet_length(body).cast("string"), "Date", day).alias("headers"),
        F.md5(body).alias("digest"),
    )
    again = F.struct(
        (3 * F.col("page_id") + 1).alias("record_id"), (at + F.expr("interval 1 hour")).alias("at"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        pairs("ETag", F.concat(F.lit("W/"), tag), "Content-Length", F.lit("0"), "Date", F.concat(day, F.lit("+1"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    later = F.struct(
        (3 * F.col("page_id") + 2).alias("record_id"), (at + F.expr("interval 1 day")).alias("at"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        pairs("ETag", F.when(F.char_length(body) % 2 == 0, F.lit('"new"')).otherwise(tag), "Date", F.concat(day, F.lit("+2"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return pages.select("url", F.explode(F.array(full, again, later)).alias("r")).select("url", "r.*")
