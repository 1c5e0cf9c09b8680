"""Caching, throttling and retrying as functions of tables and streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# Seconds that an answer of a kind stays fresh.
TTL_SECONDS = {"recording": 86400, "artist": 604800, "release": 86400, "cover_art": 86400, "not_found": 300}


@dataclass(frozen=True)
class RetrySettings:
    max_retries: int = 3
    wait: float = 1.0
    timeout_retries: int = 0
    timeout_wait: float = 2.0


def ttl_of(kind: Column, ttl: dict[str, int] | None = None) -> Column:
    out = F.lit(None).cast("int")
    for name, seconds in (ttl or TTL_SECONDS).items():
        out = F.when(kind == name, F.lit(seconds)).otherwise(out)
    return out


def live_entries(writes: DataFrame, as_of: Column, keys: list[str]) -> DataFrame:
    """keys, data, expires: of each key the last write (by written_at, then data) if it has not expired."""
    last = writes.filter(F.col("written_at") <= as_of).groupBy(*keys).agg(F.max(F.struct("written_at", "data", "ttl")).alias("w"))
    expires = F.col("w.written_at") + F.col("w.ttl")
    return last.select(*keys, F.col("w.data").alias("data"), expires.alias("expires")).filter(F.col("expires") > as_of)


def lookup_as_of(asked: DataFrame, writes: DataFrame, keys: list[str]) -> DataFrame:
    """asked (with its columns ask_id, asked_at and keys) with the data that was cached and fresh then, or null."""
    both = asked.select("ask_id", *keys, F.col("asked_at").alias("at"), F.lit(1).alias("side"), F.lit(None).cast("bigint").alias("data"), F.lit(None).cast("bigint").alias("expires"))
    both = both.unionByName(writes.select(F.lit(None).cast("bigint").alias("ask_id"), *keys, F.col("written_at").alias("at"), F.lit(0).alias("side"), "data", (F.col("written_at") + F.col("ttl")).alias("expires")))
    before = Window.partitionBy(*keys).orderBy("at", "side", "data").rowsBetween(Window.unboundedPreceding, 0)
    entry = F.last(F.when(F.col("side") == 0, F.struct("data", "expires")), ignorenulls=True).over(before)
    return both.withColumn("entry", entry).filter("side = 1").select("ask_id", *keys, F.when(F.col("entry.expires") > F.col("at"), F.col("entry.data")).alias("data"))


def _part(name: str, c: Column) -> Column:
    return F.when(c != "", F.concat(F.lit(f"{name}:"), F.lower(c)))


def _tail(limit: int | None, offset: int | None) -> list[Column]:
    return [F.lit(f"{name}:{n}") for name, n in (("limit", limit), ("offset", offset)) if n is not None]


def _included(includes: list[str] | None) -> list[Column]:
    return [F.lit("inc:" + "+".join(sorted(includes)))] if includes else []


def search_key(title: Column, artist: Column, album: Column, year: Column, strict: Column, ids: Column, limit: int = 100, offset: int | None = None, groups: Column | None = None) -> Column:
    """The cache key of a recording search: groups of ids beat ids, ids beat the name."""
    who = F.when(F.size(ids) > 0, F.concat(F.lit("arid:"), F.array_join(F.array_sort(ids), ","))).otherwise(_part("artist", artist))
    if groups is not None:
        listed = F.array_join(F.transform(groups, lambda g: F.array_join(F.array_sort(g), "|")), ";")
        who = F.when(F.size(groups) > 0, F.concat(F.lit("arid_groups:"), listed)).otherwise(who)
    when = F.when(year != 0, F.concat(F.lit("year:"), year.cast("string")))
    return F.concat_ws(":", F.lit("search_recording"), F.concat(F.lit("title:"), F.lower(title)), who, _part("album", album), F.when(strict, F.lit("strict:1")), when, *_tail(limit, offset))


def artist_search_key(name: Column, limit: int = 100) -> Column:
    """The cache key of an artist search; the name is the one that is searched for."""
    return F.concat_ws(":", F.lit("search_artist"), F.lower(name), *_tail(limit, None))


def release_search_key(title: Column, artist: Column, group_id: Column, barcode: Column, includes: list[str] | None = None, limit: int = 100, offset: int | None = None) -> Column:
    exact = lambda name, c: F.when(c != "", F.concat(F.lit(f"{name}:"), c))
    return F.concat_ws(":", F.lit("search_release"), _part("title", title), _part("artist", artist), exact("rgid", group_id), exact("barcode", barcode), *_included(includes), *_tail(limit, offset))


def group_search_key(title: Column, artist: Column, artist_id: Column, kind: Column, limit: int = 100, offset: int | None = None) -> Column:
    who = F.when(artist_id != "", F.concat(F.lit("arid:"), artist_id)).otherwise(_part("artist", artist))
    return F.concat_ws(":", F.lit("search_release_group"), _part("title", title), who, _part("type", kind), *_tail(limit, offset))


def browse_key(recording: Column, includes: list[str] | None = None, limit: int | None = None, offset: int | None = None, statuses: list[str] | None = None) -> Column:
    status = [F.lit("status:" + "|".join(sorted(statuses)))] if statuses else []
    return F.concat_ws(":", F.lit("browse_releases"), F.concat(F.lit("recording:"), recording), *_included(includes), *_tail(limit, offset), *status)


def entity_key(kind: str, id_: Column, includes: list[str] | None = None) -> Column:
    """The cache key of a look-up by id; ids of artists and recordings come trimmed and in lower case."""
    return F.concat_ws(":", F.lit(f"get_{kind}"), id_, F.lit("+".join(sorted(includes or []))))


def image_list_key(id_: Column, entity: str = "release") -> Column:
    return F.concat_ws(":", F.lit("get_image_list"), F.lit(entity), id_)


def three_part_key(provider: Column, key: Column) -> Column:
    """The key for a cache that files by provider, artist and endpoint: the artist stays empty, the address has no place."""
    return F.struct(provider.alias("provider"), F.lit("").alias("artist_name"), key.alias("endpoint"))


def last_quota(responses: DataFrame, by: list[str], at: str, tie: str) -> DataFrame:
    """Adds quota (remaining, reset), what the latest response so far that stated both has said."""
    so_far = Window.partitionBy(*by).orderBy(at, tie).rowsBetween(Window.unboundedPreceding, 0)
    stated = F.when(F.col("remaining").isNotNull() & F.col("reset").isNotNull(), F.struct("remaining", "reset"))
    return responses.withColumn("quota", F.last(stated, ignorenulls=True).over(so_far))


def throttled(requests: DataFrame, interval: int, by: list[str], at: str, tie: str) -> DataFrame:
    """Adds start: when each request may go, at least ``interval`` after the one before it.

    With a_j the arrivals, start_i = i * interval + max over j <= i of (a_j - j * interval):
    a running maximum instead of a walk.
    """
    w = Window.partitionBy(*by).orderBy(at, tie)
    place = F.row_number().over(w) * F.lit(interval)
    return requests.withColumn("place", place).withColumn("start", F.col("place") + F.max(F.col(at) - F.col("place")).over(w)).drop("place")


def adaptive_interval(remaining: Column, reset_in: Column, floor: Column, cap: Column | None) -> Column:
    """struct(wait, refused): the interval that a server's quota asks for; all in one unit, cap null: none."""
    served = F.when(remaining.isNull() | reset_in.isNull(), F.lit(0.0)).when(remaining > 0, F.greatest(reset_in, F.lit(0)) / remaining).otherwise(F.greatest(reset_in, F.lit(0)).cast("double"))
    if cap is None:
        return F.struct(F.greatest(floor, served).alias("wait"), F.lit(False).alias("refused"))
    over = cap.isNotNull() & (served > cap)
    refused = over & (remaining == 0) & (reset_in > F.greatest(cap, floor))
    return F.struct(F.greatest(floor, F.when(over, cap).otherwise(served)).alias("wait"), F.coalesce(refused, F.lit(False)).alias("refused"))


def retry_decision(outcome: Column, retries: Column, timeouts: Column, settings: RetrySettings = RetrySettings(), image: bool = False) -> Column:
    """struct(action, wait): what follows an outcome ("200", "503", "timeout", "connect", "other") after so many retries."""
    transient = outcome.isin("503") if image else outcome.isin("429", "502", "503", "504")
    again = lambda n, most, wait: F.when(n < most, F.struct(F.lit("retry").alias("action"), F.lit(wait).alias("wait")))
    end = lambda name: F.struct(F.lit(name).alias("action"), F.lit(0.0).alias("wait"))
    busy = F.when(outcome == "429", end("RateLimitError")).otherwise(end("ServerBusyError"))
    odd = end("ResponseError") if image else end("return")
    return (
        F.when(transient, F.coalesce(again(retries, settings.max_retries, settings.wait), busy))
        .when(outcome == "timeout", F.coalesce(again(timeouts, settings.timeout_retries, settings.timeout_wait), end("NetworkError")))
        .when(outcome == "connect", F.coalesce(again(retries, settings.max_retries, settings.wait), end("NetworkError")))
        .when(outcome == "200", end("return"))
        .when(outcome.rlike("^[0-9]+$"), odd)
        .otherwise(end("TransportError"))
    )


def stream_live_entries(writes: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """The streaming form: writes (keys, written_time, data, ttl) to the entries of each hour that are fresh at its end.

    The watermark bounds the state: a closed hour is dropped.
    """
    hour = F.window("written_time", "1 hour")
    last = writes.withWatermark("written_time", late).groupBy(hour, *keys).agg(F.max(F.struct("written_time", "data", "ttl")).alias("w"))
    return last.select("window", *keys, F.col("w.data").alias("data"), F.timestamp_add("SECOND", F.col("w.ttl"), F.col("w.written_time")).alias("expires")).filter("expires > window.end")
