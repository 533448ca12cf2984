"""Not-modified revisits of a web archive resolved to the response they confirm (operator 4).

A revisit has no payload of its own. It is joined, as of its time, to the latest earlier full response of the same
canonical URL; where the validators agree it gets that response's payload and headers, the permitted headers of the
revisit put over the stored ones. Only ids, times, validators and digests of contents are sorted; payloads are moved once,
to where the revisits that they answer are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.session import stage

#: The fields that a 304 answer may carry to update a stored response.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
SLICE_ROWS = 100_000


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path and query; no scheme, fragment, ``utm_`` parameter,
    trailing slash or empty query."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), r"(?i)^https?://(www\.)?", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.substring(bare, F.length(host) + 1, F.length(bare))
    rest = F.regexp_replace(F.regexp_replace(rest, "([?&])(utm_[a-z]+=[^&]*&?)+", "$1"), "[?&]+$", "")
    return F.concat(F.regexp_replace(F.lower(host), ":(80|443)$", ""), F.regexp_replace(rest, "/+$", ""))


def _tag(etag: Column) -> Column:
    """Weak comparison: the mark of a weak validator does not count."""
    return F.regexp_replace(etag, "^W/", "")


def _content() -> Column:
    return F.xxhash64("payload", F.to_json(F.array_sort(F.map_entries("headers"))))


def _latest_full(rows: DataFrame) -> DataFrame:
    """``rows`` and ``full``, the latest full response of their URL before their time; of several of one time that of the
    largest id, then validators and content.

    Time is cut into slices of about SLICE_ROWS rows. Inside a slice the last full response is a window's; the last one
    of earlier slices is carried over from one row per URL and slice. So the captures of one URL are many tasks' work.
    """
    count = rows.count()
    slices = -(-count // SLICE_ROWS)
    number = F.lit(0)
    if slices > 1:
        cuts = rows.agg(F.percentile_approx("time", [i / slices for i in range(1, slices)]).alias("cuts")).first()["cuts"]
        number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("time")))
    rows = rows.withColumn("slice", number)
    full = F.when(F.col("kind") == "response", F.struct("time", "id", "etag", "last_modified", "digest", "content"))
    # Revisits stand before the responses of their own time, so that what comes before them is earlier.
    order = ["time", F.desc("kind"), "id", "etag", "last_modified", "digest", "content"]
    inside = Window.partitionBy("key", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("key", "slice").agg(F.max(full).alias("head"))
    heads = heads.select("key", "slice", F.last("head", ignorenulls=True).over(earlier).alias("carried"))
    seen = rows.withColumn("own", F.last(full, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    return seen.join(heads, ["key", "slice"], "left").withColumn("full", F.coalesce("own", "carried")).drop("slice", "own", "carried")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """One row per revisit: id, key, time, status, source_id, headers, payload.

    ``captures``: id, url, time (long), kind (``response`` or ``revisit``), etag, last_modified, digest, headers (a map
    with lower-case names), payload. Status: ``resolved``; ``no_url`` (null url); ``no_earlier_response``;
    ``no_validator``; ``mismatch``. The first validator that both sides have decides: etag by weak comparison, then
    last_modified, then digest. What is not resolved has null source, payload and its own headers. A null time counts
    as earliest, other kinds are passed over, repeated revisits give repeated rows. A response at the very time of a
    revisit is not earlier. Responses may share an id: the one at the latest time counts, then that of the greatest
    validators and content digest; copies alike in all of that are one.
    """
    known = captures.where(F.col("kind").isin("response", "revisit"))
    rows = known.select("id", canonical_url(F.col("url")).alias("key"), "time", "kind", "etag", "last_modified", "digest", F.when(F.col("kind") == "revisit", F.col("headers")).alias("headers"), F.when(F.col("kind") == "response", _content()).alias("content"))
    rows = stage(rows, "captures")
    found = _latest_full(rows.where(F.col("key").isNotNull()))
    same, both = F.lit(None).cast("boolean"), []
    for name, clean in (("etag", _tag), ("last_modified", lambda c: c), ("digest", lambda c: c)):
        both.append(clean(F.col(name)) == clean(F.col(f"full.{name}")))
    same = F.coalesce(*both)
    status = F.when(F.col("full").isNull(), "no_earlier_response").when(same.isNull(), "no_validator").when(same, "resolved").otherwise("mismatch")
    found = found.withColumn("status", status).select(
        "id", "key", "time", "status", F.when(F.col("status") == "resolved", F.col("full")).alias("full"), F.col("headers").alias("own")
    )
    none = rows.where(F.col("key").isNull() & (F.col("kind") == "revisit"))
    none = none.select("id", "key", "time", F.lit("no_url").alias("status"), F.lit(None).cast(found.schema["full"].dataType).alias("full"), F.col("headers").alias("own"))
    name = F.xxhash64("full.id", "full.time", "full.content")  # tells apart the contents that share an id
    found = found.unionByName(none).withColumn("source", F.when(F.col("full").isNotNull(), name))
    sources = known.where("kind = 'response'").select(F.xxhash64("id", "time", _content()).alias("source"), F.col("headers").alias("stored"), "payload")
    # One shuffle by source serves both steps, so payloads are moved once.
    sources = sources.dropDuplicates(["source"])
    held = found.join(sources, "source", "left").withColumn("source_id", F.col("full.id"))
    own = F.coalesce("own", F.create_map().cast("map<string,string>"))
    permitted = F.map_filter(own, lambda name, _: name.isin(PERMITTED))
    stored = F.map_filter("stored", lambda name, _: ~F.map_contains_key(permitted, name))
    headers = F.when(F.col("status") == "resolved", F.map_concat(F.coalesce(stored, F.create_map().cast("map<string,string>")), permitted)).otherwise(own)
    return held.select("id", "key", "time", "status", "source_id", headers.alias("headers"), "payload")
