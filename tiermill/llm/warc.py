"""Not-modified revisits of a web archive resolved to the full response they stand for.

A revisit record (status 304) has headers but no payload. It is joined, as of its time, to
the latest earlier full response of the same canonical URL, its validators are checked
against that response, and the headers a 304 may change are merged into the stored ones.

The as-of join is two window functions instead of a range join. Time is cut into slices by
quantiles of the records' times. Inside a slice of one URL a window finds the latest
response before each record; across slices only the last response of each slice is carried,
one row per URL and slice. So a URL with a third of all records is spread over all slices,
and no window holds more than a slice of it or one row per slice.

Defined results: records without a URL share the null key and resolve among themselves; a
record without a time is before all others; equal times are ordered by record id;
a repeated revisit row gives a repeated result, a repeated response changes nothing. Null headers are no headers. Revisits without an
earlier response have status ``no_response``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Headers that a 304 response may replace in the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that say where a visitor came from, not what is shown.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` or ``m.``, default port, fragment, tracking parameters and a closing slash removed; host in lower case."""
    bare = F.regexp_replace(F.trim(url), "^(?i)https?://", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    rest = F.substring(bare, F.length(host) + 1, F.length(bare))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^(www|m)\\.", "")
    rest = F.regexp_replace(rest, f"([?&])(?:{TRACKING})=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&+", "&"), "\\?&", "?")
    rest = F.regexp_replace(rest, "[?&]+$", "")
    return F.concat(host, F.regexp_replace(rest, "/+$", ""))


def _time_slices(records: DataFrame, time: str, slices: int) -> Column:
    """Slice number of a time; the cuts are at most ``slices`` numbers."""
    if slices < 2:
        return F.lit(0)
    found = records.select(F.col(time).cast("double").alias("t")).approxQuantile(
        ["t"], [i / slices for i in range(1, slices)], 0.001
    )[0]
    cuts = F.array(*[F.lit(c) for c in sorted(set(found))]) if found else F.array().cast("array<double>")
    return F.size(F.filter(cuts, lambda c: c <= F.coalesce(F.col(time).cast("double"), F.lit(float("-inf")))))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers with the permitted ones of the 304 put in; names in lower case."""
    changes = F.map_filter(fresh, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(changes), k))
    return F.map_concat(kept, changes)


def _lower_names(headers: Column) -> Column:
    """Names in lower case; of one name in two spellings the last in byte order counts."""
    entries = F.sort_array(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: F.array_position(F.slice(names, i + 2, F.size(names)), F.lower(e["key"])) == 0)
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]), e["value"])))


def check_validators(stored: Column, fresh: Column, stored_digest: Column, fresh_digest: Column) -> Column:
    """``match``, ``mismatch`` or ``unchecked``: entity tags by weak comparison, else last-modified, else payload digest."""

    def tag(headers: Column) -> Column:
        return F.regexp_replace(headers["etag"], "^W/", "")

    def judged(a: Column, b: Column) -> Column:
        return F.when(a == b, F.lit("match")).otherwise(F.lit("mismatch"))

    both = [
        (tag(stored), tag(fresh)),
        (stored["last-modified"], fresh["last-modified"]),
        (stored_digest, fresh_digest),
    ]
    result = F.lit("unchecked")
    for a, b in reversed(both):
        result = F.when(a.isNotNull() & b.isNotNull(), judged(a, b)).otherwise(result)
    return result


def resolve_revisits(records: DataFrame, slices: int | None = None) -> DataFrame:
    """One row per revisit record.

    ``records`` has ``record_id``, ``url``, ``fetched_at``, ``status`` (304 for a revisit, 200
    for a full response, others are ignored), ``headers`` (map) and ``digest``. The result has
    ``record_id``, ``canonical_url``, ``fetched_at``, ``response_id``, ``response_at``,
    ``digest`` of the payload, ``resolution`` and merged ``headers`` (null unless resolved).
    """
    slices = slices or int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = records.filter(F.col("status").isin(200, 304)).select(
        canonical_url(F.col("url")).alias("key"),
        F.struct("fetched_at", "record_id").alias("at"),
        (F.col("status") == 304).alias("revisit"),
        _lower_names(F.col("headers")).alias("headers"),
        "digest",
        _time_slices(records, "fetched_at", min(slices, 1000)).alias("slice"),
    )
    full = F.struct("at", "headers", "digest")
    before = Window.partitionBy("key", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(~F.col("revisit"), full), ignorenulls=True).over(before)
    inside = seen.withColumn("found", found).filter("revisit")

    present = seen.groupBy("key", "slice").agg(F.max_by(full, F.when(~F.col("revisit"), F.col("at"))).alias("closing"))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = present.select(
        F.col("key").alias("k"),
        F.col("slice").alias("s"),
        F.last("closing", ignorenulls=True).over(earlier).alias("carried"),
    ).filter("carried is not null")

    joined = inside.join(carried, F.col("key").eqNullSafe(F.col("k")) & (F.col("slice") == F.col("s")), "left")
    response = F.coalesce("found", "carried")
    joined = joined.withColumn("response", response)
    validity = check_validators(F.col("response.headers"), F.col("headers"), F.col("response.digest"), F.col("digest"))
    resolution = F.when(F.col("response").isNull(), "no_response").otherwise(validity)
    usable = F.col("resolution").isin("match", "unchecked")
    return joined.withColumn("resolution", resolution).select(
        F.col("at.record_id").alias("record_id"),
        F.col("key").alias("canonical_url"),
        F.col("at.fetched_at").alias("fetched_at"),
        F.col("response.at.record_id").alias("response_id"),
        F.col("response.at.fetched_at").alias("response_at"),
        F.when(usable, F.col("response.digest")).alias("digest"),
        "resolution",
        F.when(usable, merged_headers(F.col("response.headers"), F.col("headers"))).alias("headers"),
    )
