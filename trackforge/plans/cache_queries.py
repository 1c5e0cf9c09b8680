"""Queries of caching, throttling and retrying over the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackforge.operators.common import shared_folder
from trackforge.plans.text_queries import Query
from trackforge.sources.catalog import view, with_views
from trackforge.streaming import cache, state

AS_OF = "2024-01-20 00:00:00"
EVENTS_A_BUCKET = 4096
KIND = {"purchase": "recording", "signup": "artist", "view": "release", "click": "cover_art", "error": "not_found"}


def _seconds(c: str):
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "events")
    kind = F.create_map(*(F.lit(x) for pair in KIND.items() for x in pair))[F.col("event_type")]
    return e.select("user_id", "event_type", _seconds("ts").alias("written_at"), F.col("event_id").alias("data"), cache.ttl_of(kind).alias("ttl"))


def cache_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _writes(spark, sf_dir).select(F.col("data").alias("event_id"), "ttl")


def cache_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.unix_timestamp(F.lit(AS_OF).cast("timestamp"))
    return cache.live_entries(_writes(spark, sf_dir), as_of, ["user_id", "event_type"])


_TTL = "CASE event_type WHEN 'purchase' THEN 86400 WHEN 'signup' THEN 604800 WHEN 'error' THEN 300 ELSE 86400 END"
LIVE_SQL = f"""
SELECT user_id, event_type, data, CAST(written_at + ttl AS BIGINT) AS expires FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY written_at DESC, data DESC) AS rn FROM (
    SELECT user_id, event_type, event_id AS data, CAST(floor(epoch(ts)) AS BIGINT) AS written_at, {_TTL} AS ttl FROM events) WHERE written_at <= epoch(TIMESTAMP '{AS_OF}'))
WHERE rn = 1 AND written_at + ttl > epoch(TIMESTAMP '{AS_OF}')"""


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every event, what its user's views had cached an hour later (a miss is null)."""
    w = _writes(spark, sf_dir)
    asked = w.select(F.col("data").alias("ask_id"), "user_id", (F.col("written_at") + 3600).alias("asked_at"))
    return cache.lookup_as_of(asked, w.filter("event_type = 'view'").withColumn("ttl", F.lit(7200)), ["user_id"]).select("ask_id", "user_id", "data")


LOOKUP_SQL = """
WITH w AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events),
v AS (SELECT user_id, t, max(event_id) AS event_id FROM w WHERE event_type = 'view' GROUP BY user_id, t),
asked AS (SELECT event_id, user_id, t + 3600 AS t FROM w)
SELECT a.event_id AS ask_id, a.user_id, CASE WHEN v.t + 7200 > a.t THEN v.event_id END AS data
FROM asked a ASOF LEFT JOIN v ON v.user_id = a.user_id AND a.t >= v.t"""


def cache_lookup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stream of look-ups and writes with keyed state, replayed from files in any order."""
    w = _writes(spark, sf_dir)
    asked = w.select(F.col("data").alias("ask_id"), "user_id", (F.col("written_at") + 3600).alias("asked_at"))
    events = state.cache_events(asked, w.filter("event_type = 'view'").withColumn("ttl", F.lit(7200)), F.col("user_id"))
    end = events.agg(F.max("at").alias("at"), F.count("*").alias("n")).first()
    latest = spark.range(1).select(F.lit("").alias("key"), (F.lit(end.at).cast("long") + 86400 * 30).alias("at"), F.lit(0).cast("long").alias("ttl"))
    folder = f"{shared_folder(spark)}/cache-stream-{uuid.uuid4()}"
    events.unionByName(latest, allowMissingColumns=True).write.parquet(f"{folder}/in")  # the last event lets the watermark pass all others
    buckets = max(64, end.n // EVENTS_A_BUCKET)
    stream = state.stream_lookups(spark.readStream.schema(state.EVENT).parquet(f"{folder}/in"), buckets=buckets)
    with state.with_rocks(spark):
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(state.ANSWER).parquet(f"{folder}/out").select("ask_id", F.col("key").cast("long").alias("user_id"), "data")


def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = view(spark, sf_dir, "request")
    ids = F.when(F.col("request_id") % 4 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array().cast("array<string>"))
    key = cache.search_key(F.col("title"), F.col("artist"), F.col("album"), F.col("year"), F.col("request_id") % 3 == 0, ids)
    return q.select("request_id", key.alias("cache_key"))


KEY_SQL = """
SELECT request_id, 'search_recording:title:' || lower(title) || CASE WHEN request_id % 4 = 0 THEN ':arid:a,b' ELSE ':artist:' || lower(artist) END || coalesce(':album:' || lower(album), '')
  || CASE WHEN request_id % 3 = 0 THEN ':strict:1' ELSE '' END || coalesce(':year:' || year, '') || ':limit:100' AS cache_key FROM request"""


def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of all other look-ups, the last as it goes to a cache that files by three parts."""
    q = view(spark, sf_dir, "request")
    n, title, artist, album = F.col("request_id"), F.col("title"), F.col("artist"), F.col("album")
    uuid, none = F.md5(n.cast("string")), F.lit(None).cast("string")
    groups = F.when(n % 2 == 0, F.array(F.array(F.lit("d"), F.lit("c")), F.array(F.lit("e"))))
    three = cache.three_part_key(F.lit("catalog"), cache.image_list_key(uuid))
    return q.select(
        "request_id",
        cache.search_key(title, artist, album, F.lit(0), F.lit(False), F.array().cast("array<string>"), 100, 200, groups).alias("recordings"),
        cache.artist_search_key(artist).alias("artists"),
        cache.release_search_key(album, artist, F.when(n % 3 == 1, uuid), F.when(n % 3 == 2, n.cast("string")), ["media", "labels"], 25, 50).alias("releases"),
        cache.group_search_key(album, artist, F.when(n % 2 == 0, uuid), F.lit("Album")).alias("release_groups"),
        cache.browse_key(uuid, ["release-groups", "labels"], 100, None, ["official", "bootleg"]).alias("browsed"),
        cache.entity_key("artist", uuid, ["tags"]).alias("artist"), cache.entity_key("release", uuid).alias("release"), cache.entity_key("release_group", none).alias("no_id"),
        three["provider"].alias("provider"), three["artist_name"].alias("artist_name"), three["endpoint"].alias("endpoint"),
    )


KEYS_SQL = """
SELECT request_id,
  'search_recording:title:' || lower(title) || CASE WHEN request_id % 2 = 0 THEN ':arid_groups:c|d;e' ELSE ':artist:' || lower(artist) END || coalesce(':album:' || lower(album), '') || ':limit:100:offset:200' AS recordings,
  'search_artist:' || lower(artist) || ':limit:100' AS artists,
  'search_release' || coalesce(':title:' || lower(album), '') || ':artist:' || lower(artist) || CASE request_id % 3 WHEN 1 THEN ':rgid:' || md5(CAST(request_id AS VARCHAR)) WHEN 2 THEN ':barcode:' || request_id ELSE '' END
    || ':inc:labels+media:limit:25:offset:50' AS releases,
  'search_release_group' || coalesce(':title:' || lower(album), '') || CASE WHEN request_id % 2 = 0 THEN ':arid:' || md5(CAST(request_id AS VARCHAR)) ELSE ':artist:' || lower(artist) END || ':type:album:limit:100' AS release_groups,
  'browse_releases:recording:' || md5(CAST(request_id AS VARCHAR)) || ':inc:labels+release-groups:limit:100:status:bootleg|official' AS browsed,
  'get_artist:' || md5(CAST(request_id AS VARCHAR)) || ':tags' AS artist, 'get_release:' || md5(CAST(request_id AS VARCHAR)) || ':' AS release, 'get_release_group:' AS no_id,
  'catalog' AS provider, '' AS artist_name, 'get_image_list:release:' || md5(CAST(request_id AS VARCHAR)) AS endpoint
FROM request"""


def last_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user's latest response with limit headers had said, at every event."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = view(spark, sf_dir, "events").select("event_id", "user_id", _seconds("ts").alias("at"), F.when(k % 7 != 6, k % 4).alias("remaining"), F.when(k % 5 != 4, k * 1000).alias("reset"))
    return cache.last_quota(e, ["user_id"], "at", "event_id").select("event_id", F.col("quota.remaining").alias("remaining"), F.col("quota.reset").alias("reset"))


QUOTA_SQL = """
WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
s AS (SELECT *, max(CASE WHEN k % 7 <> 6 AND k % 5 <> 4 THEN n END) OVER (PARTITION BY user_id ORDER BY n) AS said FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM e))
SELECT s.event_id, o.k % 4 AS remaining, o.k * 1000 AS reset FROM s LEFT JOIN s o ON o.user_id = s.user_id AND o.n = s.said"""


def throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each user's requests may start if they must be six hours apart."""
    e = view(spark, sf_dir, "events").select("event_id", "user_id", _seconds("ts").alias("arrived"))
    return cache.throttled(e, 6 * 3600, ["user_id"], "arrived", "event_id").select("event_id", "arrived", "start")


THROTTLE_SQL = """
WITH RECURSIVE a AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS arrived, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) AS n FROM events),
s AS (SELECT event_id, user_id, arrived, n, arrived AS start FROM a WHERE n = 1
  UNION ALL SELECT a.event_id, a.user_id, a.arrived, a.n, greatest(a.arrived, s.start + 21600) FROM s JOIN a ON a.user_id = s.user_id AND a.n = s.n + 1)
SELECT event_id, arrived, start FROM s"""


def adaptive_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waits in milliseconds for quotas made of the events' numbers."""
    k = F.get_json_object("props", "$.k").cast("int")
    wait = cache.adaptive_interval(F.when(k % 7 != 6, k % 4), k * 1000, F.lit(500), F.lit(60000))
    return view(spark, sf_dir, "events").select("event_id", F.floor(wait["wait"]).alias("wait_ms"), wait["refused"].alias("refused"))


ADAPTIVE_SQL = """
WITH q AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
w AS (SELECT event_id, k, CASE WHEN k % 7 = 6 THEN 0.0 WHEN k % 4 > 0 THEN k * 1000.0 / (k % 4) ELSE k * 1000.0 END AS served FROM q)
SELECT event_id, CAST(floor(greatest(500, least(served, 60000))) AS BIGINT) AS wait_ms, k % 7 <> 6 AND k % 4 = 0 AND k > 60 AS refused FROM w"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    names = ["200", "429", "502", "503", "504", "500", "404", "timeout", "connect", "other"]
    outcome = F.element_at(F.array(*(F.lit(x) for x in names)), (n % 10 + 1).cast("int"))
    return view(spark, sf_dir, "events").select("event_id", outcome.alias("outcome"), F.floor(n / 10).cast("int").alias("tens"))


def retry_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cache.retry_decision(F.col("outcome"), F.col("tens") % 5, F.col("tens") % 2)
    i = cache.retry_decision(F.col("outcome"), F.col("tens") % 5, F.col("tens") % 2, cache.RetrySettings(timeout_retries=1), image=True)
    return _outcomes(spark, sf_dir).select("event_id", d["action"].alias("action"), F.floor(d["wait"] * 10).alias("wait_tenths"), i["action"].alias("image_action"))


RETRY_SQL = """
WITH o AS (SELECT event_id, event_id % 10 AS k, CAST(floor(event_id / 10) AS INTEGER) % 5 AS n, CAST(floor(event_id / 10) AS INTEGER) % 2 AS t FROM events)
SELECT event_id,
  CASE WHEN k IN (1, 2, 3, 4, 8) AND n < 3 THEN 'retry' WHEN k = 1 THEN 'RateLimitError' WHEN k IN (2, 3, 4) THEN 'ServerBusyError' WHEN k IN (7, 8) THEN 'NetworkError' WHEN k = 9 THEN 'TransportError' ELSE 'return' END AS action,
  CAST(CASE WHEN k IN (1, 2, 3, 4, 8) AND n < 3 THEN 10 ELSE 0 END AS BIGINT) AS wait_tenths,
  CASE WHEN k IN (3, 8) AND n < 3 OR k = 7 AND t < 1 THEN 'retry' WHEN k = 3 THEN 'ServerBusyError' WHEN k IN (7, 8) THEN 'NetworkError' WHEN k = 9 THEN 'TransportError' WHEN k = 0 THEN 'return' ELSE 'ResponseError' END AS image_action
FROM o"""


def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each final action follows, and how many responses came."""
    d = cache.retry_decision(F.col("outcome"), F.lit(3), F.lit(0))
    answered = F.col("outcome").rlike("^[0-9]+$").cast("long")
    return _outcomes(spark, sf_dir).groupBy(d["action"].alias("action")).agg(F.count("*").alias("n"), F.sum(answered).alias("responses"))


ERRORS_SQL = """
SELECT CASE WHEN k = 1 THEN 'RateLimitError' WHEN k IN (2, 3, 4) THEN 'ServerBusyError' WHEN k IN (7, 8) THEN 'NetworkError' WHEN k = 9 THEN 'TransportError' ELSE 'return' END AS action,
  count(*) AS n, CAST(sum(CASE WHEN k < 7 THEN 1 ELSE 0 END) AS BIGINT) AS responses
FROM (SELECT event_id % 10 AS k FROM events) GROUP BY 1"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (cache_ttl, cache_live, cache_lookup, cache_lookup_stream, cache_key, cache_keys, last_quota, throttle, adaptive_interval, retry_decision, error_classes)}


def sql() -> dict[str, str]:
    return {
        "cache_ttl": f"SELECT event_id, {_TTL} AS ttl FROM events",
        "cache_live": LIVE_SQL,
        "cache_lookup": LOOKUP_SQL,
        "cache_lookup_stream": LOOKUP_SQL,
        "cache_key": with_views(KEY_SQL, "request"),
        "cache_keys": with_views(KEYS_SQL, "request"),
        "last_quota": QUOTA_SQL,
        "throttle": THROTTLE_SQL,
        "adaptive_interval": ADAPTIVE_SQL,
        "retry_decision": RETRY_SQL,
        "error_classes": ERRORS_SQL,
    }
