"""WARC: resolution of not-modified revisits.

A revisit (status 304) takes its content from the latest earlier full response (status 200) of the same canonical URL. Earlier
is by (ts, record_id). Its validators are checked: where both have an ETag the opaque tags must be equal (weak comparison);
else, where both have Last-Modified, these must be; else there is nothing to check and the match is unchecked. The response's
headers are merged with those headers of the revisit that a 304 may update (RFC 9110, 15.4.5); names are lower-cased.

A URL's key is its canonical host and path (see urlfilter) and its query, which names the resource; scheme and fragment don't count.

As-of join by two levels: captures are cut into ranges of (key, ts, record_id) of about equal size, so a URL with a third of all
captures, even of one day, is spread over its ranges. Inside a range a window finds the latest response, and from range to range
only each range's last response of a URL is carried. Headers and payloads stay behind: numbers of rows travel, and a base's
headers are fetched by its number. The narrow rows are written once, as ranges must not change between their uses.

Null or host-less URLs, null times and null ids resolve to nothing (`no_base`). Of responses with equal (ts, record_id) the one of
greater digest counts, then that of greater headers' hash. Repeated revisits are answered each. Rows that are neither kind are
passed over, and columns beyond the six aren't looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored
from .urlfilter import canonical, host, path

#: Header fields that a not-modified answer may update. Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def _lowered(headers: Column) -> Column:
    """Names in lower case; of names that then are equal, the first in the alphabet counts."""
    pairs = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.coalesce(F.map_from_arrays(names, F.transform(names, lambda n: F.filter(pairs, lambda e: e["key"] == n)[0]["value"])), F.expr("cast(map() as map<string,string>)"))


def _opaque(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def key_of(url: Column) -> Column:
    """Null without host."""
    rest = F.regexp_replace(F.substr(url, F.locate("://", url) + 3), "#.*$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.+)$", 1)
    return F.concat(canonical(host(url), path(url)), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def resolve(records: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row for each revisit of records (record_id, url, ts in seconds, status, digest, headers map): record_id, base_id, base_digest, outcome, headers.

    outcome: resolved, unchecked, stale (validators differ; headers are the revisit's own) or no_base. ranges: by default as many
    as shuffle partitions.
    """
    spark = records.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowered = _lowered(F.col("headers"))
    kept = records.where("status in (200, 304)").select("record_id", "ts", "status", "digest", lowered.alias("h"), key_of(F.col("url")).alias("u"))
    kept = stored(kept.withColumns({"_row": F.monotonically_increasing_id(), "_hash": F.xxhash64(F.to_json(F.array_sort(F.map_entries("h"))))}), "captures")
    rows = kept.where("u is not null and ts is not null and record_id is not null").select("u", "ts", "record_id", "status", F.coalesce("digest", F.lit("")).alias("_d"), "_hash", "_row")
    # responses come after revisits of the same instant and id, so that they aren't earlier
    order = ["ts", "record_id", F.col("status").desc(), "_d", "_hash", "_row"]
    rows = stored(rows.repartitionByRange(ranges, "u", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    rows = rows.withColumn("_full", F.when(F.col("status") == 200, F.col("_row")))
    last = rows.groupBy("u", "_range").agg(F.max_by("_full", F.when(F.col("status") == 200, F.struct("ts", "record_id", "_d", "_hash", "_row"))).alias("_last"))
    carried = last.withColumn("_carry", F.last("_last", True).over(Window.partitionBy("u").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))).where("_carry is not null").select("u", "_range", "_carry")
    inside = Window.partitionBy("u", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("_near", F.last("_full", True).over(inside)).where("status = 304").select("u", "_range", "_row", "_near")
    found = near.join(carried, ["u", "_range"], "left").select("_row", F.coalesce("_near", "_carry").alias("_base")).where("_base is not null")
    base = kept.where("status = 200").select(F.col("_row").alias("_base"), F.struct("record_id", "digest", F.map_entries("h").alias("h")).alias("base"))
    found = kept.where("status = 304").select("_row", "record_id", "h").join(found.join(base, "_base").select("_row", "base"), "_row", "left")
    old = F.map_from_entries("base.h")
    tags, dates = (old["etag"], F.col("h")["etag"]), (old["last-modified"], F.col("h")["last-modified"])
    both = lambda p: p[0].isNotNull() & p[1].isNotNull()
    outcome = (
        F.when(F.col("base").isNull(), "no_base")
        .when(both(tags), F.when(_opaque(tags[0]) == _opaque(tags[1]), "resolved").otherwise("stale"))
        .when(both(dates), F.when(dates[0] == dates[1], "resolved").otherwise("stale"))
        .otherwise("unchecked")
    )
    news = F.map_filter("h", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(news), k)), news)
    out = found.withColumn("outcome", outcome)
    taken = F.col("outcome").isin("resolved", "unchecked")
    return out.select("record_id", F.when(taken, F.col("base.record_id")).alias("base_id"), F.when(taken, F.col("base.digest")).alias("base_digest"), "outcome", F.when(taken, merged).otherwise(F.col("h")).alias("headers"))
