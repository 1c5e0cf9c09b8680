"""Not-modified revisits of WARC captures resolved to full responses; DataFrame functions only.

A revisit (a capture that only says "not modified") stands for the latest
earlier full response of the same canonical URL.  It is resolved if the
validators agree: the entity tag where both captures have one, else the
last-modified date where both have one, else nothing speaks against it.  The
resolved capture has the response's payload and headers, with those headers
replaced that a not-modified answer may change.

The as-of join runs on distinct (URL, second) pairs, first within an hour of a
URL and then over its hours, so that no task holds more than 3,600 pairs of an
hour or the hours of one URL, however many captures a URL has.

Records: record_id, url, ts (seconds), type ("response" or "revisit"), headers
(map of lower-case names).  Defined results: records without id, url or ts take
no part as responses; revisits without url or ts stay unresolved
("no_response"); a response in the revisit's own second is not earlier; of
several responses in one second the greatest record_id counts; null headers are
empty; repeated revisits are resolved each; repeated response ids count once;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Headers that describe the stored payload; a not-modified answer does not change them (fixed values).
KEPT = ("content-length", "content-encoding", "content-type", "content-range", "content-md5", "transfer-encoding", "trailer")
HOUR = 3600


def canonical(url: Column) -> Column:
    """Lower-case scheme and host, without default port, fragment, user and trailing dot; an empty path is "/"."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?(\[[^\]/?]*\]|[^/?:]*)", 1), r"\.$", ""))
    port = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?(?:\[[^\]/?]*\]|[^/?:]*):([0-9]*)", 1)
    rest = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$", 1)
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.when(rest == "", F.lit("/")).when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)
    return F.when(scheme == "", bare).otherwise(F.concat(scheme, F.lit("://"), host, F.when(usual, F.lit("")).otherwise(F.concat(F.lit(":"), port)), path))


def earlier_responses(records: DataFrame) -> DataFrame:
    """key, ts, response_id: for every (canonical URL, second) of a revisit the latest earlier response."""
    known = records.filter("key IS NOT NULL AND ts IS NOT NULL")
    is_response = (F.col("type") == "response") & F.col("record_id").isNotNull()
    seconds = known.groupBy("key", "ts").agg(F.max(F.when(is_response, F.col("record_id"))).alias("id"), F.max(F.col("type") == "revisit").alias("asked"))
    seconds = seconds.withColumn("hour", F.floor(F.col("ts") / HOUR))
    seen = F.when(F.col("id").isNotNull(), F.col("id"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = seconds.withColumn("in_hour", F.last(seen, ignorenulls=True).over(before(Window.partitionBy("key", "hour").orderBy("ts"))))
    hours = seconds.groupBy("key", "hour").agg(F.max(F.when(F.col("id").isNotNull(), F.struct("ts", "id"))).alias("last"))
    hours = hours.select("key", "hour", F.last("last.id", ignorenulls=True).over(before(Window.partitionBy("key").orderBy("hour"))).alias("in_past"))
    found = within.filter("asked").join(hours, ["key", "hour"])
    return found.select("key", "ts", F.coalesce("in_hour", "in_past").alias("response_id"))


def resolve(records: DataFrame) -> DataFrame:
    """record_id, url, ts, response_id, status ("resolved", "no_response", "mismatch") and merged headers of every revisit."""
    empty = F.create_map().cast("map<string,string>")
    records = records.select("record_id", "url", "ts", "type", F.coalesce("headers", empty).alias("headers")).withColumn("key", canonical(F.col("url")))
    earlier = earlier_responses(records)
    # revisits that meet nothing have keys of their own in both joins, which spread them over the tasks
    revisits = records.filter("type = 'revisit'").withColumn("alone", -1 - F.monotonically_increasing_id())
    known = F.col("key").isNotNull() & F.col("ts").isNotNull()
    revisits = revisits.withColumn("place", F.when(known, F.col("key")).otherwise(F.concat(F.lit(" "), F.col("alone"))))  # no URL begins with a blank
    matched = revisits.join(earlier.withColumnRenamed("key", "place"), ["place", "ts"], "left")
    responses = records.filter("type = 'response' AND record_id IS NOT NULL").groupBy(F.col("record_id").alias("response_id")).agg(F.min(F.map_entries("headers")).alias("entries"))
    spread = F.coalesce("response_id", "alone")
    old = responses.select(F.col("response_id").alias("old_id"), F.map_from_entries("entries").alias("old"))
    matched = matched.withColumn("wanted", spread).join(old, (F.col("wanted") == F.col("old_id")) & F.col("response_id").isNotNull(), "left")
    same = lambda name: F.col("headers")[name] == F.col("old")[name]
    agrees = F.coalesce(same("etag"), same("last-modified"), F.lit(True))
    status = F.when(F.col("response_id").isNull(), F.lit("no_response")).when(agrees, F.lit("resolved")).otherwise(F.lit("mismatch"))
    changed = F.map_filter("headers", lambda k, _: ~k.isin(*KEPT))
    kept = F.map_filter("old", lambda k, _: ~F.array_contains(F.map_keys(changed), k))
    merged = F.when(status == "resolved", F.map_concat(kept, changed)).otherwise(F.col("headers"))
    return matched.select("record_id", "url", "ts", F.when(status == "resolved", F.col("response_id")).alias("response_id"), status.alias("status"), merged.alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """Captures made by rule from the pages: one response a page, and one revisit that writes the URL otherwise."""
    p = F.col("page_id").cast("long")
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    server = lambda tag, day, kind: F.create_map(F.lit("etag"), tag, F.lit("last-modified"), day.cast("string"), F.lit("content-type"), F.lit(kind), F.lit("date"), p.cast("string"))
    response = pages.select(
        (p * 2).alias("record_id"), "url", (p % 5000 * 60).alias("ts"), F.lit("response").alias("type"), server(digest, p % 9, "text/html").alias("headers")
    )
    tag = F.when(p % 7 == 0, F.lit("stale")).when(p % 7 == 1, F.lit(None).cast("string")).otherwise(digest)
    spelled = F.concat(F.upper(F.regexp_extract("url", "^[a-z]*://[^/]*", 0)), F.regexp_replace("url", "^[a-z]*://[^/]*", ""), F.when(p % 2 == 0, F.lit("#part")).otherwise(F.lit("")))
    revisit = pages.select(
        (p * 2 + 1).alias("record_id"), spelled.alias("url"), (p % 5000 * 60 + F.when(p % 11 == 0, F.lit(-30)).otherwise(p % 8000)).alias("ts"), F.lit("revisit").alias("type"),
        server(tag, p % 9 + F.when(p % 14 == 1, F.lit(1)).otherwise(F.lit(0)), "text/plain").alias("headers"),
    )
    return response.unionByName(revisit)
