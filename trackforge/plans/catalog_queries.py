"""Queries over the catalog: look-ups, choices, resolution and enrichment."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackforge.functions import matching, nested
from trackforge.functions.text import plain
from trackforge.operators import artists as who, collaboration, enrich as completing, lookup, ranking
from trackforge.operators.common import materialized
from trackforge.plans import cascade
from trackforge.plans.text_queries import Query, s_norm, s_plain, s_points, s_tight, s_title_key, s_year, variations_sql
from trackforge.sources import documents
from trackforge.sources.catalog import numbered_releases, release_names, view, with_views


def _views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, n) for n in names]


def best_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    releases, recordings, requests = _views(spark, sf_dir, "track_release", "recording", "request")
    hints = requests.select(F.col("request_id").alias("rec_id"), F.col("album").alias("wanted"), "year")
    hinted = releases.join(hints, "rec_id").join(recordings.select("rec_id", F.col("title").alias("recording_title")), "rec_id")
    best = ranking.best_under_hints(hinted, F.col("wanted"), F.col("year"), F.col("recording_title"))
    return best.select("rec_id", F.col("title").alias("album"), "release_id", "date", "score10")


def _step(x: str, *steps: tuple[int, int]) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {b} THEN {p}" for b, p in steps) + " ELSE 0 END"


BEST_RELEASE_SQL = rf"""
, scored AS (
  SELECT t.*, CAST(10 * (
      CASE WHEN q.album IS NULL THEN 0 WHEN {s_title_key('t.title')} = {s_title_key('q.album')} THEN 100
        WHEN contains({s_title_key('t.title')}, {s_title_key('q.album')}) OR contains({s_title_key('q.album')}, {s_title_key('t.title')}) THEN 50 ELSE 0 END
      + {_step(f"abs({s_year('t.date')} - q.year)", (0, 75), (1, 40), (5, 20))}
      + {s_points('primary_type', 'secondary_type')}
      - CASE WHEN regexp_matches(t.title, '(?i)\b(?:vol\.?|volume|hits|best\s+of|essential|anthology|collection|classics)\b') AND secondary_type <> 'Compilation' THEN 10 ELSE 0 END
      - CASE WHEN {s_year('t.date')} > {s_year('t.first_date')} + 1 THEN 10 ELSE 0 END
      + CASE WHEN primary_type = 'Album' AND {s_norm('t.title')} = {s_norm('r.title')} THEN 20 ELSE 0 END
      + CASE WHEN packaging IN ('Jewel Case', 'Digipak') THEN 5 WHEN packaging = 'None' THEN 1 ELSE 0 END)
      + CASE WHEN q.album IS NULL AND q.year IS NULL THEN coalesce(2100 - {s_year('t.date')}, 0) ELSE 0 END AS BIGINT) AS score10
  FROM track_release t JOIN recording r USING (rec_id) JOIN request q ON q.request_id = t.rec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY CASE status WHEN 'Official' THEN 0 ELSE 1 END, score10 DESC, pos) AS rn FROM scored)
SELECT rec_id, title AS album, release_id, date, score10 FROM ranked WHERE rn = 1"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_id with its credits as nested documents."""
    credits, artists = _views(spark, sf_dir, "credit", "artist")
    item = F.struct("pos", F.struct("name", "joinphrase", F.struct(F.col("artist_id").cast("string").alias("id")).alias("artist")).alias("c"))
    return credits.join(artists, "artist_id").groupBy("rec_id").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["c"]).alias("credits"))


def credit_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("credits")
    return _named(spark, sf_dir).select("rec_id", F.array_join(nested.credit_ids(c), "|").alias("ids"), nested.credit_string(c).alias("artist"))


CREDIT_SQL = """
SELECT rec_id, string_agg(CAST(artist_id AS VARCHAR), '|' ORDER BY pos) AS ids, string_agg(name || joinphrase, '' ORDER BY pos) AS artist
FROM credit JOIN artist USING (artist_id) GROUP BY rec_id"""


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_id with kinds of its releases and their counts, in order of name."""
    counted = view(spark, sf_dir, "track_release").groupBy("rec_id", F.col("primary_type").alias("name")).agg(F.count("*").cast("int").alias("count"))
    return counted.groupBy("rec_id").agg(F.sort_array(F.collect_list(F.struct("name", "count"))).alias("kinds"))


def genre_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds(spark, sf_dir).select("rec_id", F.array_join(nested.genre_names(F.col("kinds")), "|").alias("genres"), F.array_join(nested.tag_names(F.col("kinds")), "|").alias("tags"))


GENRE_SQL = """
, counted AS (SELECT rec_id, primary_type AS name, count(*) AS n FROM track_release GROUP BY rec_id, primary_type)
SELECT rec_id, string_agg(name, '|' ORDER BY n DESC, name) AS genres, string_agg(name, '|' ORDER BY name) AS tags FROM counted GROUP BY rec_id"""


def primary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = F.struct("pos", F.struct(F.col("label_type").alias("type"), F.col("label").alias("name")).alias("label"))
    listed = view(spark, sf_dir, "track_release").groupBy("rec_id").agg(F.sort_array(F.collect_list(info)).alias("info"))
    return listed.select("rec_id", nested.first_label(F.col("info")).alias("label"))


PRIMARY_LABEL_SQL = "SELECT rec_id, arg_min(label, pos) FILTER (label_type IS NOT NULL) AS label FROM track_release GROUP BY rec_id"


def url_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.struct(
        "pos", F.when(F.col("pos") % 5 == 0, F.lit("artist")).otherwise(F.lit("url")).alias("target_type"), F.col("primary_type").alias("type"),
        F.struct(F.concat(F.lit("http://x/"), F.col("release_id").cast("string")).alias("resource")).alias("url"),
    )
    listed = view(spark, sf_dir, "track_release").groupBy("rec_id").agg(F.sort_array(F.collect_list(link)).alias("relations"))
    return listed.select("rec_id", F.explode(nested.link_map(F.col("relations"))).alias("type", "resource"))


URL_SQL = "SELECT rec_id, primary_type AS type, 'http://x/' || arg_min(release_id, pos) AS resource FROM track_release WHERE pos % 5 <> 0 GROUP BY rec_id, primary_type"


def artist_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "artist")
    search = F.concat(F.lit("act "), F.col("artist_id").cast("string"))
    return a.select("artist_id", matching.name_matches(F.col("name"), F.when(F.col("artist_id") % 2 == 0, F.array("alias")), search, F.lit("dj 4")).alias("matched"))


ARTIST_MATCH_SQL = f"""
SELECT artist_id, {s_plain('name')} IN ('act ' || artist_id, 'dj 4') OR (artist_id % 2 = 0 AND {s_plain('alias')} IN ('act ' || artist_id, 'dj 4')) AS matched FROM artist"""


def recording_artist_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "request").select(F.col("request_id").alias("rec_id"), "artist")
    c = F.col("credits")
    matched = matching.credits_match(F.col("artist"), F.transform(c, lambda x: x["name"]), F.try_element_at(c, F.lit(1))["joinphrase"])
    return requests.join(_named(spark, sf_dir), "rec_id").select("rec_id", matched.alias("matched"))


RECORDING_ARTIST_SQL = rf"""
, c AS (SELECT rec_id, count(*) AS n, arg_min(name, pos) AS first_name, arg_min(joinphrase, pos) AS first_join, list({s_tight('name')} ORDER BY pos) AS names FROM credit JOIN artist USING (artist_id) GROUP BY rec_id),
m AS (SELECT c.*, {s_tight('q.artist')} AS wanted, coalesce({s_tight(r"regexp_replace(first_name, '(?i)^(?:the|a|an)\s+', '')")}, '') = coalesce({s_tight(r"regexp_replace(q.artist, '(?i)^(?:the|a|an)\s+', '')")}, '') AS equal
  FROM c JOIN request q ON q.request_id = c.rec_id)
SELECT rec_id, CASE WHEN n = 1 THEN equal ELSE len(list_filter(names, lambda x: NOT contains(wanted, x))) = 0 OR (equal AND contains(first_join, 'feat')) END AS matched FROM m"""


def variant_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "recording")
    return r.select("rec_id", matching.has_marker(F.col("disambiguation")).alias("marked"), matching.shares_marker(F.col("title"), F.col("disambiguation")).alias("shared"))


VARIANT_SQL = r"""SELECT rec_id, regexp_matches(disambiguation, '\b(live|karaoke|acoustic|demo)\b') AS marked, disambiguation = 'live' AND regexp_matches(title, '(?i)\blive\b') AS shared FROM recording"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``release_titles`` of the releases of the catalog."""
    return ranking.numbered_release_titles(numbered_releases(spark, sf_dir), release_names(spark, sf_dir))


def _pairs(spark: SparkSession, sf_dir: str, titles: DataFrame) -> DataFrame:
    """Every recording with the request of its own id."""
    recordings, requests = view(spark, sf_dir, "recording", track_release=titles), view(spark, sf_dir, "request", track_release=titles)
    return recordings.join(requests.select(F.col("request_id").alias("rec_id"), F.col("title").alias("asked"), "album", "year"), "rec_id")


def score_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = materialized(_titles(spark, sf_dir))  # the first dates of recordings are read from it too
    n = view(spark, sf_dir, "credit").groupBy("rec_id").agg(F.count("*").alias("n_credits"))
    own = ranking.recording_points(F.col("asked"), F.col("year"), F.when(F.col("isrc").isNotNull(), 1).otherwise(0), F.col("n_credits"), F.col("length"), F.col("disambiguation"), F.col("first_date"))
    pairs = materialized(_pairs(spark, sf_dir, titles).join(n, "rec_id").select("rec_id", "album", "year", own.alias("own")))
    summary = ranking.release_summary(pairs, titles, ["rec_id"])
    return pairs.join(summary, "rec_id").select("rec_id", (F.col("own") + F.col("release_points")).cast("long").alias("score"))


SCORE_SQL = rf"""
, ctx AS (
  SELECT t.rec_id, max(CASE WHEN q.album IS NULL THEN 0 WHEN {s_norm('t.title')} = {s_norm('q.album')} THEN 100
      WHEN contains({s_norm('t.title')}, {s_norm('q.album')}) OR contains({s_norm('q.album')}, {s_norm('t.title')}) THEN 50 ELSE 0 END + {_step(f"abs({s_year('t.date')} - q.year)", (0, 75), (1, 40), (5, 20))})
    + sum({s_points('primary_type', 'secondary_type')}) + sum(CASE WHEN {s_year('t.date')} < 2000 THEN 15 WHEN {s_year('t.date')} < 2010 THEN 10 ELSE 5 END) AS points
  FROM track_release t JOIN request q ON q.request_id = t.rec_id GROUP BY t.rec_id),
n AS (SELECT rec_id, count(*) AS n FROM credit GROUP BY rec_id)
SELECT r.rec_id, CAST(CASE WHEN r.isrc IS NULL THEN 0 ELSE 50 END + (2100 - CAST(substr(first_date, 1, 4) AS INTEGER)) * 10
  + {_step("abs(CAST(substr(first_date, 1, 4) AS INTEGER) - q.year)", (0, 500), (1, 300), (2, 150), (5, 50))}
  + CASE WHEN length IS NULL THEN 0 ELSE 5 END + 5 * n.n
  + CASE WHEN disambiguation = '' THEN 0 WHEN disambiguation = '1995 remaster' OR (disambiguation = 'live' AND regexp_matches(q.title, '(?i)\blive\b')) THEN 10 ELSE -50 END + points AS BIGINT) AS score
FROM recording r JOIN request q ON q.request_id = r.rec_id JOIN ctx USING (rec_id) JOIN n USING (rec_id)"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request with the recordings of its title's key that share its first artist: what a search would give."""
    requests, recordings, credits = _views(spark, sf_dir, "request", "recording", "credit")
    own = credits.filter("pos = 0").select(F.col("rec_id").alias("request_id"), "artist_id")
    by = credits.select("rec_id", "artist_id")
    asked = requests.select("request_id", F.col("title").alias("asked"), "album", "year", F.explode(F.array(plain(F.regexp_replace("title", "^03-", "")))).alias("title_key"))
    filed = lookup.title_index(recordings).join(by, "rec_id")  # title and artist are one key: a frequent title alone joins nothing
    return asked.join(own, "request_id").join(filed, ["title_key", "artist_id"]).join(recordings, "rec_id")


def select_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, keys = materialized(_candidates(spark, sf_dir)), ["request_id", "rec_id"]
    summary = ranking.release_summary(hits, _titles(spark, sf_dir), keys)
    own = ranking.recording_points(F.col("asked"), F.col("year"), F.when(F.col("isrc").isNotNull(), 1).otherwise(0), F.lit(1), F.col("length"), F.col("disambiguation"), F.col("first_date"))
    ready = hits.join(summary, keys).select(
        *keys, "asked", "title", F.col("rec_id").alias("place"), (own + F.col("release_points")).alias("score"), F.lit(0).alias("days"), F.col("isrc").isNotNull().alias("has_isrc"), F.col("plain_ok").alias("qualifies"), "various"
    )
    return ranking.select_recordings(ready, ["request_id"])


SELECT_SQL = rf"""
, forms AS (SELECT DISTINCT rec_id, title_key FROM (SELECT rec_id, unnest([{s_plain('title')},
    CASE WHEN regexp_matches(title, '^\s*(.*)\s+[\(\[].*[\)\]]$') THEN {s_plain(r"regexp_extract(title, '^\s*(.*)\s+[\(\[].*[\)\]]$', 1)")} END,
    {s_plain(r"regexp_replace(regexp_replace(title, ' [\(\[](?:Radio Edit|Remastered)[\)\]]', ''), ' - Single Version$', '')")}]) AS title_key FROM recording) WHERE title_key IS NOT NULL),
asked AS (SELECT request_id, q.title AS asked, album, year, artist_id, {s_plain("regexp_replace(q.title, '^03-', '')")} AS title_key FROM request q JOIN credit c ON c.rec_id = q.request_id AND c.pos = 0),
hits AS (SELECT a.*, r.rec_id, r.title, r.isrc, r.length, r.disambiguation, r.first_date FROM asked a JOIN forms f USING (title_key) JOIN credit c ON c.rec_id = f.rec_id AND c.artist_id = a.artist_id JOIN recording r ON r.rec_id = f.rec_id),
rel AS (SELECT rec_id, title, {s_norm('title')} AS release_key, {s_year('date')} AS released, {s_points('primary_type', 'secondary_type')} AS points, secondary_type IN ('Compilation', 'Live') AS other_kind, various FROM track_release),
summed AS (
  SELECT request_id, h.rec_id, max(CASE WHEN album IS NULL THEN 0 WHEN release_key = {s_norm('album')} THEN 100 WHEN contains(release_key, {s_norm('album')}) OR contains({s_norm('album')}, release_key) THEN 50 ELSE 0 END
      + {_step("abs(released - year)", (0, 75), (1, 40), (5, 20))}) + sum(points) + sum(CASE WHEN released < 2000 THEN 15 WHEN released < 2010 THEN 10 WHEN released < 2020 THEN 5 ELSE 0 END) AS points,
    bool_or((album IS NULL OR release_key = {s_norm('album')}) AND NOT various AND NOT other_kind) AS qualifies, bool_or((album IS NULL OR release_key = {s_norm('album')}) AND various) AS va
  FROM hits h JOIN rel USING (rec_id) GROUP BY request_id, h.rec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY exact DESC, score DESC, rec_id) AS rk, bool_or(exact) OVER (PARTITION BY request_id) AS any_exact FROM (
    SELECT h.request_id, h.rec_id, asked, isrc IS NOT NULL AS has_isrc, qualifies, va, coalesce({s_tight('asked')} = {s_tight('title')}, FALSE) AS exact,
      CASE WHEN isrc IS NULL THEN 0 ELSE 50 END + (2100 - CAST(substr(first_date, 1, 4) AS INTEGER)) * 10 + {_step("abs(CAST(substr(first_date, 1, 4) AS INTEGER) - year)", (0, 500), (1, 300), (2, 150), (5, 50))}
      + CASE WHEN length IS NULL THEN 0 ELSE 5 END + 5
      + CASE WHEN disambiguation = '' THEN 0 WHEN disambiguation = '1995 remaster' OR (disambiguation = 'live' AND regexp_matches(asked, '(?i)\blive\b')) THEN 10 ELSE -50 END + points AS score
    FROM hits h JOIN summed s ON s.request_id = h.request_id AND s.rec_id = h.rec_id)),
kept AS (SELECT * FROM ranked WHERE any_exact OR NOT regexp_matches(asked, '^\s*(.*)\s+[\(\[].*[\)\]]$')),
firsts AS (
  SELECT request_id, min(rk) FILTER (qualifies) AS w, min(rk) FILTER (exact AND has_isrc AND NOT qualifies) AS f, min(rk) FILTER (va) AS v FROM kept GROUP BY request_id),
answer AS (
  SELECT x.request_id, CASE WHEN w IS NOT NULL THEN CASE WHEN f < w AND NOT k.has_isrc THEN f ELSE w END ELSE coalesce(f, v) END AS rk FROM firsts x LEFT JOIN kept k ON k.request_id = x.request_id AND k.rk = x.w)
SELECT request_id, rec_id FROM answer JOIN kept USING (request_id, rk)"""


def resolve_isrc(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, recordings, releases = _views(spark, sf_dir, "request", "recording", "track_release")
    codes = F.filter(F.array(F.lower("isrc"), F.concat(F.lit("US"), F.lpad((F.col("request_id") + 1).cast("string"), 10, "0"))), lambda x: x.isNotNull())
    asked = requests.select(F.col("request_id").alias("ask_id"), F.posexplode(codes).alias("ord", "isrc"))
    counts = releases.groupBy("rec_id").agg(F.count("*").alias("n_releases"))
    return ranking.resolve_isrcs(asked, recordings.filter("isrc IS NOT NULL").join(counts, "rec_id"))


ISRC_SQL = """
, asked AS (SELECT request_id AS ask_id, 0 AS ord, isrc FROM request WHERE isrc IS NOT NULL
  UNION ALL SELECT request_id, CASE WHEN isrc IS NULL THEN 0 ELSE 1 END, 'US' || lpad(CAST(request_id + 1 AS VARCHAR), 10, '0') FROM request),
n AS (SELECT rec_id, count(*) AS n FROM track_release GROUP BY rec_id),
hits AS (SELECT ask_id, rec_id, row_number() OVER (PARTITION BY ask_id ORDER BY n DESC, ord, rec_id) AS rn FROM asked JOIN recording USING (isrc) JOIN n USING (rec_id))
SELECT ask_id, rec_id FROM hits WHERE rn = 1"""


def search_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), F.col("artist").alias("name"))
    return lookup.search_artists(asked, view(spark, sf_dir, "artist"))


_ARTIST_KEY_SQL = rf"""artist_key AS (
  SELECT artist_id, artist_key, max(score) AS score FROM (
    SELECT artist_id, {s_plain('name')} AS artist_key, 100 AS score FROM artist UNION ALL SELECT artist_id, {s_plain('alias')}, 100 FROM artist
    UNION ALL SELECT artist_id, regexp_replace({s_plain('name')}, '^(?:the|a|an) ', ''), 80 FROM artist UNION ALL SELECT artist_id, regexp_replace({s_plain('alias')}, '^(?:the|a|an) ', ''), 80 FROM artist)
  GROUP BY artist_id, artist_key)"""
SEARCH_ARTISTS_SQL = rf"""
, {_ARTIST_KEY_SQL}
SELECT request_id AS ask_id, artist_id, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT request_id, artist_id, score, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, artist_id) AS rank
  FROM (SELECT request_id, {s_plain('artist')} AS artist_key FROM request) JOIN artist_key USING (artist_key)) WHERE rank <= 100"""


def search_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), "title", "artist")
    return lookup.search_recordings(asked, *_views(spark, sf_dir, "recording", "credit", "artist"))


SEARCH_RECORDINGS_SQL = rf"""
, {_ARTIST_KEY_SQL}
, forms AS (SELECT rec_id, {s_plain('title')} AS own, unnest([{s_plain('title')},
    CASE WHEN regexp_matches(title, '^\s*(.*)\s+[\(\[].*[\)\]]$') THEN {s_plain(r"regexp_extract(title, '^\s*(.*)\s+[\(\[].*[\)\]]$', 1)")} END,
    {s_plain(r"regexp_replace(regexp_replace(title, ' [\(\[](?:Radio Edit|Remastered)[\)\]]', ''), ' - Single Version$', '')")}]) AS title_key FROM recording),
wanted AS (SELECT request_id AS ask_id, {s_plain('title')} AS title_key, {s_plain('artist')} AS artist_key FROM request),
hits AS (SELECT DISTINCT ask_id, f.rec_id, own = w.title_key AS same FROM wanted w JOIN forms f USING (title_key) JOIN credit c ON c.rec_id = f.rec_id JOIN artist_key k ON k.artist_id = c.artist_id AND k.artist_key = w.artist_key)
SELECT ask_id, rec_id, CAST(rank AS INTEGER) AS rank, total FROM (
  SELECT *, row_number() OVER (PARTITION BY ask_id ORDER BY same DESC, rec_id) AS rank, count(*) OVER (PARTITION BY ask_id) AS total FROM hits) WHERE rank <= 100"""


def search_recordings_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches with each kind of condition in turn: album, ids, groups of ids, the title alone, strict, year."""
    requests, recordings, credits, artists, releases = _views(spark, sf_dir, "request", "recording", "credit", "artist", "track_release")
    first, second = (credits.filter(f"pos = {p}").select(F.col("rec_id").alias("request_id"), F.col("artist_id").alias(n)) for p, n in ((0, "a"), (1, "b")))
    m = F.col("request_id") % 6
    groups = F.array(F.array("a", F.col("a") + 1), F.when(F.col("b").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("b")))
    asked = requests.join(first, "request_id").join(second, "request_id", "left").select(
        F.col("request_id").alias("ask_id"), "title", F.when(m != 3, F.col("artist")).alias("artist"), F.when((m == 1) | (m == 2), F.array("a", F.col("a") + 1)).alias("artist_ids"),
        F.when(m == 2, groups).alias("artist_id_groups"), F.when(m == 0, F.col("album")).alias("album"), (m == 4).alias("strict"), F.when(m == 5, F.lit(1996)).alias("year"),
    )
    return lookup.search_recordings(asked, recordings, credits, artists, releases=releases)


SEARCH_BY_SQL = rf"""
, {_ARTIST_KEY_SQL}
, forms AS (SELECT rec_id, first_date, {s_plain('title')} AS own, unnest([{s_plain('title')},
    CASE WHEN regexp_matches(title, '^\s*(.*)\s+[\(\[].*[\)\]]$') THEN {s_plain(r"regexp_extract(title, '^\s*(.*)\s+[\(\[].*[\)\]]$', 1)")} END,
    {s_plain(r"regexp_replace(regexp_replace(title, ' [\(\[](?:Radio Edit|Remastered)[\)\]]', ''), ' - Single Version$', '')")}]) AS title_key FROM recording),
w AS (SELECT request_id AS ask_id, request_id % 6 AS m, {s_plain('title')} AS title_key, {s_plain('artist')} AS artist_key, {s_plain('album')} AS album_key, f.artist_id AS a, g.artist_id AS b
  FROM request JOIN credit f ON f.rec_id = request_id AND f.pos = 0 LEFT JOIN credit g ON g.rec_id = request_id AND g.pos = 1),
h AS (SELECT DISTINCT ask_id, m, artist_key, album_key, a, b, f.rec_id, first_date, own = w.title_key AS same FROM w JOIN forms f USING (title_key)),
named AS (SELECT DISTINCT c.rec_id, k.artist_key FROM credit c JOIN artist_key k USING (artist_id)),
on_album AS (SELECT DISTINCT rec_id, {s_plain('title')} AS album_key FROM track_release),
made AS (SELECT rec_id, list(artist_id) AS ids FROM credit GROUP BY rec_id),
kinds AS (SELECT rec_id, bool_or(status = 'Official') AND NOT bool_or(secondary_type IN ('Compilation', 'Live')) AS strict FROM track_release GROUP BY rec_id),
hits AS (
  SELECT h.ask_id, h.rec_id, h.same FROM h JOIN made USING (rec_id) JOIN kinds USING (rec_id)
    LEFT JOIN named n ON n.rec_id = h.rec_id AND n.artist_key = h.artist_key LEFT JOIN on_album o ON o.rec_id = h.rec_id AND o.album_key = h.album_key
  WHERE CASE m WHEN 0 THEN n.rec_id IS NOT NULL AND (h.album_key IS NULL OR o.rec_id IS NOT NULL)
    WHEN 1 THEN list_has_any(ids, [a, a + 1]) WHEN 2 THEN list_has_any(ids, [a, a + 1]) AND (b IS NULL OR list_contains(ids, b)) WHEN 3 THEN TRUE
    WHEN 4 THEN n.rec_id IS NOT NULL AND strict ELSE n.rec_id IS NOT NULL AND CAST(substr(first_date, 1, 4) AS INTEGER) BETWEEN 1995 AND 1997 END)
SELECT ask_id, rec_id, CAST(rank AS INTEGER) AS rank, total FROM (
  SELECT *, row_number() OVER (PARTITION BY ask_id ORDER BY same DESC, rec_id) AS rank, count(*) OVER (PARTITION BY ask_id) AS total FROM hits) WHERE rank <= 100"""


def paged_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every search up to its cap, with the page on which each candidate comes."""
    return all_candidate_pages(spark, sf_dir).withColumn("page", F.ceil(F.col("rank") / lookup.PAGE).cast("int"))


PAGED_SQL = SEARCH_RECORDINGS_SQL.replace("WHERE rank <= 100", "WHERE rank <= 500").replace("total FROM (\n  SELECT *, row_number", "total, CAST((rank + 99) // 100 AS INTEGER) AS page FROM (\n  SELECT *, row_number")


def all_candidate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of each search, up to its cap."""
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), "title", "artist")
    return lookup.search_recordings(asked, *_views(spark, sf_dir, "recording", "credit", "artist"), limit=lookup.SEARCH_CAP)


ALL_PAGES_SQL = SEARCH_RECORDINGS_SQL.replace("WHERE rank <= 100", "WHERE rank <= 500")


def get_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings by id, some of the ids in capitals, with blanks, or no ids."""
    r = view(spark, sf_dir, "recording").select(F.md5(F.concat(F.lit("r"), F.col("rec_id").cast("string"))).alias("id"), "rec_id", "title")
    wanted = F.md5(F.concat(F.lit("r"), (F.col("request_id") * 2).cast("string")))
    uuid = F.when(F.col("request_id") % 3 == 0, F.concat(F.lit(" "), F.upper(wanted))).when(F.col("request_id") % 7 == 0, F.lit("not-an-id")).otherwise(wanted)
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), uuid.alias("uuid"))
    return lookup.get_by_id(asked, r, "id").select("ask_id", "rec_id", "title", "found")


GET_SQL = """
SELECT request_id AS ask_id, r.rec_id, r.title, r.rec_id IS NOT NULL AS found
FROM request q LEFT JOIN recording r ON r.rec_id = q.request_id * 2 AND NOT (q.request_id % 7 = 0 AND q.request_id % 3 <> 0)"""


def _asked_ids(spark: SparkSession, sf_dir: str, letter: str) -> DataFrame:
    """Ids asked for, some of them in capitals, some not ids."""
    n = F.col("request_id")
    wanted = F.md5(F.concat(F.lit(letter), n.cast("string")))
    return view(spark, sf_dir, "request").select(n.alias("ask_id"), F.when(n % 3 == 0, F.upper(wanted)).when(n % 7 == 0, F.lit("not-an-id")).otherwise(wanted).alias("uuid"))


def get_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists by id with the default section, tags; links are left out."""
    a = view(spark, sf_dir, "artist")
    documents_ = a.select(F.md5(F.concat(F.lit("a"), F.col("artist_id").cast("string"))).alias("id"), "name", F.concat(F.lit("nation "), F.col("nation").cast("string")).alias("tags"), F.col("alias").alias("relations"))
    found = lookup.get_entity(_asked_ids(spark, sf_dir, "a"), documents_, None, {"tags": ("tags",), "url-rels": ("relations",)}, ("tags",), fold=True)
    return found.select("ask_id", *(c for c in found.columns if c not in ("ask_id", "id")))


GET_ARTIST_SQL = """
SELECT request_id AS ask_id, name, 'nation ' || nation AS tags, artist_id IS NOT NULL AS found
FROM request LEFT JOIN artist ON artist_id = request_id AND NOT (request_id % 7 = 0 AND request_id % 3 <> 0)"""


def _releases_by_id(spark: SparkSession, sf_dir: str, letter: str, key: str, includes: list[str] | None) -> DataFrame:
    each = view(spark, sf_dir, "track_release").groupBy(key).agg(F.min("title").alias("title"), F.min("label").alias("label"), F.max("primary_type").alias("kind"))
    documents_ = each.select(F.md5(F.concat(F.lit(letter), F.col(key).cast("string"))).alias("id"), key, "title", "label", "kind")
    found = lookup.get_entity(_asked_ids(spark, sf_dir, letter), documents_, includes, {"labels": ("label",), "release-groups": ("kind",)})
    return found.drop("id")


def get_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases by id, whose case counts, with their labels."""
    return _releases_by_id(spark, sf_dir, "l", "release_id", ["labels"])


GET_RELEASE_SQL = """
SELECT request_id AS ask_id, release_id, r.title, label, release_id IS NOT NULL AS found
FROM request LEFT JOIN (SELECT release_id, min(title) AS title, min(label) AS label FROM track_release GROUP BY release_id) r ON release_id = request_id AND request_id % 3 <> 0 AND request_id % 7 <> 0"""


def get_release_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release groups by id, bare."""
    return _releases_by_id(spark, sf_dir, "g", "group_id", None)


GET_GROUP_SQL = """
SELECT request_id AS ask_id, group_id, r.title, group_id IS NOT NULL AS found
FROM request LEFT JOIN (SELECT group_id, min(title) AS title FROM track_release GROUP BY group_id) r ON group_id = request_id AND request_id % 3 <> 0 AND request_id % 7 <> 0"""


def get_by_isrc(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, recordings = _views(spark, sf_dir, "request", "recording")
    asked = requests.select(F.col("request_id").alias("ask_id"), F.upper(F.trim(F.concat(F.lit("  "), F.lower("isrc")))).alias("isrc"))
    return asked.join(recordings.select("isrc", "rec_id"), "isrc", "left").select("ask_id", "rec_id")


def browse_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The releases of each recording, of every second one the official ones only, up to the cap of browsing."""
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), F.col("request_id").alias("rec_id"), F.when(F.col("request_id") % 2 == 0, F.array(F.lit("Official"))).alias("statuses"))
    return lookup.browse_releases(asked, view(spark, sf_dir, "track_release").select("rec_id", "release_id", "status"))


BROWSE_SQL = """
SELECT rec_id AS ask_id, release_id, CAST(place AS INTEGER) AS pos, total FROM (
  SELECT rec_id, release_id, row_number() OVER (PARTITION BY rec_id ORDER BY release_id) AS place, count(*) OVER (PARTITION BY rec_id) AS total
  FROM track_release WHERE rec_id % 2 = 1 OR status = 'Official') WHERE place <= 1000"""


def browse_all_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The releases of each recording whatever their status, up to the cap of browsing."""
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), F.col("request_id").alias("rec_id"), F.lit(None).cast("array<string>").alias("statuses"))
    return lookup.browse_releases(asked, view(spark, sf_dir, "track_release").select("rec_id", "release_id", "status"))


BROWSE_ALL_SQL = BROWSE_SQL.replace("WHERE rec_id % 2 = 1 OR status = 'Official'", "")


def _albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases as documents of their own, with an artist and a barcode."""
    releases, credits = _views(spark, sf_dir, "track_release", "credit")
    first = credits.filter("pos = 0").select("rec_id", "artist_id")
    return releases.join(first, "rec_id").groupBy("release_id").agg(F.min("title").alias("title"), F.min("artist_id").alias("artist_id"), F.max("primary_type").alias("kind")).withColumn("barcode", F.concat(F.lit("BC"), F.col("release_id").cast("string")))


_ALBUMS_SQL = "albums AS (SELECT release_id, min(title) AS title, min(artist_id) AS artist_id, max(primary_type) AS kind, 'BC' || release_id AS barcode FROM track_release JOIN credit USING (rec_id) WHERE credit.pos = 0 GROUP BY release_id)"


def search_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = view(spark, sf_dir, "request")
    n = F.col("request_id")
    asked = requests.select(
        n.alias("ask_id"), F.when(n % 4 == 0, F.upper("album")).alias("title"), F.when((n % 4 == 0) | (n % 4 == 1), n % 7).alias("artist_id"), F.when(n % 4 == 2, F.concat(F.lit("BC"), n.cast("string"))).alias("barcode")
    )
    return lookup.search_releases(asked.filter("title IS NOT NULL OR artist_id IS NULL OR ask_id % 4 = 1"), _albums(spark, sf_dir))


SEARCH_RELEASES_SQL = f"""
, {_ALBUMS_SQL}
SELECT ask_id, release_id, CAST(row_number() OVER (PARTITION BY ask_id ORDER BY release_id) AS INTEGER) AS rank FROM (
SELECT DISTINCT request_id AS ask_id, release_id FROM request q JOIN albums a ON
  CASE q.request_id % 4 WHEN 0 THEN {s_plain('q.album')} = {s_plain('a.title')} AND a.artist_id = q.request_id % 7 WHEN 1 THEN a.artist_id = q.request_id % 7 WHEN 2 THEN a.barcode = 'BC' || q.request_id ELSE FALSE END)
QUALIFY rank <= 100"""


def search_releases_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches by artist's name, by group, by title alone and by title and name."""
    n = F.col("request_id")
    m = n % 4
    asked = view(spark, sf_dir, "request").select(
        n.alias("ask_id"), F.when((m == 2) | (m == 3), F.col("album")).alias("title"), F.when((m == 0) | (m == 3), F.col("artist")).alias("artist"), F.when(m == 1, n - n % 4).alias("group_id")
    )
    albums = _albums(spark, sf_dir).withColumn("group_id", F.col("release_id") - F.col("release_id") % 4)
    return lookup.search_releases(asked, albums, artists=view(spark, sf_dir, "artist"))


SEARCH_RELEASES_BY_SQL = f"""
, {_ALBUMS_SQL}
, {_ARTIST_KEY_SQL}
, q AS (SELECT request_id, request_id % 4 AS m, {s_plain('album')} AS title_key, {s_plain('artist')} AS artist_key FROM request),
t AS (SELECT release_id, artist_id, {s_plain('title')} AS title_key FROM albums),
hits AS (
  SELECT request_id, release_id FROM q JOIN artist_key USING (artist_key) JOIN t USING (artist_id) WHERE m = 0 OR (m = 3 AND (q.title_key IS NULL OR q.title_key = t.title_key))
  UNION SELECT request_id, release_id FROM q JOIN t ON t.release_id - t.release_id % 4 = q.request_id - q.request_id % 4 WHERE m = 1
  UNION SELECT request_id, release_id FROM q JOIN t USING (title_key) WHERE m = 2)
SELECT request_id AS ask_id, release_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY release_id) AS INTEGER) AS rank FROM hits QUALIFY rank <= 100"""


def search_release_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by title and type, by name, by an id that beats the name, and by a type alone, which finds none."""
    groups = _albums(spark, sf_dir).groupBy("title", "artist_id", "kind").agg(F.min("release_id").alias("group_id"))
    n = F.col("request_id")
    m = n % 4
    asked = view(spark, sf_dir, "request").select(
        n.alias("ask_id"), F.when(m == 0, F.col("album")).alias("title"), F.when((m == 1) | (m == 2), F.col("artist")).alias("artist"), F.when(m == 2, n % 7).alias("artist_id"), F.when(m != 1, F.lit("ALBUM")).alias("type")
    )
    return lookup.search_release_groups(asked, groups, artists=view(spark, sf_dir, "artist"))


GROUPS_SQL = f"""
, {_ALBUMS_SQL}
, {_ARTIST_KEY_SQL}
, groups AS (SELECT title, artist_id, kind, min(release_id) AS group_id FROM albums GROUP BY title, artist_id, kind),
q AS (SELECT request_id, request_id % 4 AS m, {s_plain('album')} AS title_key, {s_plain('artist')} AS artist_key FROM request),
hits AS (
  SELECT request_id, group_id FROM q JOIN groups g ON {s_plain('g.title')} = q.title_key WHERE m = 0 AND kind = 'Album'
  UNION SELECT request_id, group_id FROM q JOIN artist_key USING (artist_key) JOIN groups USING (artist_id) WHERE m = 1
  UNION SELECT request_id, group_id FROM q JOIN groups ON artist_id = request_id % 7 WHERE m = 2 AND kind = 'Album')
SELECT request_id AS ask_id, group_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY group_id) AS INTEGER) AS rank FROM hits QUALIFY rank <= 100"""


def json_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "events")
    n = F.col("event_id")
    body = F.when(n % 10 == 1, F.lit("{broken")).when(n % 10 == 2, F.lit("[1]")).when(n % 10 == 3, F.lit("null")).otherwise(F.col("props"))
    guard = documents.json_object(body, F.when(n % 10 == 4, F.lit(503)).otherwise(F.lit(200)))
    return e.select("event_id", guard["ok"].alias("ok"), guard["error"].alias("error"))


JSON_SQL = """
SELECT event_id, event_id % 10 NOT IN (1, 2, 3, 4) AS ok, CASE event_id % 10 WHEN 1 THEN 'not json' WHEN 2 THEN 'not an object' WHEN 3 THEN 'not an object' WHEN 4 THEN 'status 503' END AS error FROM events"""


def find_artist_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = view(spark, sf_dir, "track").select(F.col("track_id").alias("ask_id"), "artist")
    return who.find_artist_ids(asked, view(spark, sf_dir, "artist"))


def _variations(source: str, key: str, column: str, name: str) -> str:
    """CTEs that end in ``name``: key, ord, variation of a table's names."""
    steps = variations_sql().replace("FROM track", f"FROM {source}").replace("track_id", key).replace("lower(artist)", f"lower({column})")
    for step in ("base", "both_forms", "listed", "firsts"):
        steps = re.sub(rf"\b{step}\b", f"{step}_{name}", steps)
    steps = re.sub(r"\bt AS \(", f"t_{name} AS (", steps).replace("FROM t)", f"FROM t_{name} t)")
    head, last = steps.rsplit("\nSELECT ", 1)
    return f"{head},\n{name} AS (SELECT {last})"


def _find_sql() -> str:
    return rf"""
, {_ARTIST_KEY_SQL}
{_variations('track', 'track_id', 'artist', 'tv')}
{_variations('artist', 'artist_id', 'name', 'av')}
, hits AS (
  SELECT track_id, ord, artist_id, score, row_number() OVER (PARTITION BY track_id, ord ORDER BY score DESC, artist_id) AS place
  FROM tv JOIN artist_key k ON k.artist_key = {s_plain('tv.variation')} WHERE score >= 70),
seen AS (SELECT track_id, artist_id, max(score) AS score, min(ord * 1000 + place) AS first FROM hits WHERE place <= 10 GROUP BY track_id, artist_id),
alike AS (SELECT DISTINCT tv.track_id, av.artist_id FROM tv JOIN av ON tv.variation = av.variation),
aliased AS (SELECT DISTINCT tv.track_id, a.artist_id FROM tv JOIN artist a ON {s_tight('tv.variation')} = {s_tight('a.alias')}),
fit AS (
  SELECT s.* FROM seen s JOIN track USING (track_id) JOIN artist a ON a.artist_id = s.artist_id
  LEFT JOIN alike x ON x.track_id = s.track_id AND x.artist_id = s.artist_id LEFT JOIN aliased y ON y.track_id = s.track_id AND y.artist_id = s.artist_id
  WHERE x.artist_id IS NOT NULL OR y.artist_id IS NOT NULL OR {s_tight('track.artist')} = {s_tight('a.name')})
SELECT track_id AS ask_id, artist_id, CAST(row_number() OVER (PARTITION BY track_id ORDER BY score DESC, first) - 1 AS INTEGER) AS ord FROM fit"""


def and_of_ors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every request for a collaboration: recordings that credit, for each of its artists, that one or the one filed next."""
    credits = view(spark, sf_dir, "credit")
    shared = credits.filter("pos > 0").select("rec_id").distinct().join(credits, "rec_id")
    ids = F.explode(F.array("artist_id", F.col("artist_id") + 1)).alias("artist_id")
    asked = view(spark, sf_dir, "request").select(F.col("request_id").alias("rec_id"))
    return who.by_group(asked.join(shared, "rec_id").select(F.col("rec_id").alias("ask_id"), F.col("pos").alias("group_no"), ids), credits)


AND_OF_ORS_SQL = """
SELECT DISTINCT q.request_id AS ask_id, a.rec_id
FROM request q JOIN credit f ON f.rec_id = q.request_id AND f.pos = 0 JOIN credit s ON s.rec_id = q.request_id AND s.pos = 1
JOIN credit a ON a.artist_id IN (f.artist_id, f.artist_id + 1) JOIN credit b ON b.rec_id = a.rec_id AND b.artist_id IN (s.artist_id, s.artist_id + 1)"""


def _songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), F.col("artist").alias("name"), F.when(F.col("request_id") % 2 == 0, F.regexp_replace("title", "^03-", "")).alias("song"))


def lookup_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = who.lookup_artists(_songs(spark, sf_dir), *_views(spark, sf_dir, "artist", "recording", "credit"))
    return found.select("ask_id", "artist_id", F.array_join(F.transform("rec_ids", lambda x: x.cast("string")), "|").alias("rec_ids"))


def quorum_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = who.lookup_artists(_songs(spark, sf_dir), *_views(spark, sf_dir, "artist", "recording", "credit"), always_validate=True)
    return found.select("ask_id", "artist_id", F.array_join(F.transform("rec_ids", lambda x: x.cast("string")), "|").alias("rec_ids"))


def _lookup_sql(always: bool) -> str:
    needs = "TRUE" if always else "(song IS NOT NULL AND n > 1)"
    return rf"""
, {_ARTIST_KEY_SQL}
, q AS (SELECT request_id AS ask_id, artist, CASE WHEN request_id % 2 = 0 THEN regexp_replace(title, '^03-', '') END AS song FROM request),
v AS (SELECT *, 0 AS ord, artist AS variation FROM q UNION ALL SELECT *, 1, substr(artist, 5) FROM q WHERE lower(artist) LIKE 'the %'),
h AS (
  SELECT v.*, k.artist_id, {s_plain('v.artist')} AS whole, k.artist_key, count(*) OVER (PARTITION BY ask_id, ord) AS n, row_number() OVER (PARTITION BY ask_id, ord ORDER BY k.score DESC, k.artist_id) AS place
  FROM v JOIN artist_key k ON k.artist_key = {s_plain('v.variation')}),
p AS (
  SELECT h.*, {needs} AS needs, CASE WHEN {s_plain('a.name')} IN (whole, artist_key) OR {s_plain('a.alias')} IN (whole, artist_key) THEN 0 WHEN place = 1 THEN 1 END AS phase
  FROM h JOIN artist a USING (artist_id)),
made AS (SELECT c.artist_id, coalesce({s_plain('r.title')}, '') AS song_key, r.rec_id FROM credit c JOIN recording r USING (rec_id)),
proven AS (
  SELECT ask_id, ord, artist_id, array_to_string(list_sort(list(DISTINCT m.rec_id)), '|') AS rec_ids
  FROM p JOIN made m USING (artist_id) WHERE needs AND m.song_key = coalesce({s_plain('song')}, '') GROUP BY ask_id, ord, artist_id),
pick AS (
  SELECT p.ask_id, p.artist_id, coalesce(rec_ids, '') AS rec_ids, row_number() OVER (PARTITION BY p.ask_id ORDER BY p.ord, phase, place) AS rn
  FROM p LEFT JOIN proven USING (ask_id, ord, artist_id) WHERE phase IS NOT NULL AND (NOT needs OR rec_ids IS NOT NULL))
SELECT ask_id, artist_id, rec_ids FROM pick WHERE rn = 1"""


def validate_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every request, the recordings of its song by the first artist of its own recording."""
    songs = view(spark, sf_dir, "request").select(F.col("request_id").alias("ask_id"), F.regexp_replace("title", "^03-", "").alias("song"))
    first = view(spark, sf_dir, "credit").filter("pos = 0").select(F.col("rec_id").alias("ask_id"), "artist_id")
    return who.recordings_by(songs.join(first, "ask_id"), *_views(spark, sf_dir, "recording", "credit")).select("ask_id", "artist_id", "rec_id")


VALIDATE_SQL = rf"""
SELECT q.request_id AS ask_id, c.artist_id, d.rec_id FROM request q JOIN credit c ON c.rec_id = q.request_id AND c.pos = 0 JOIN credit d ON d.artist_id = c.artist_id
JOIN recording r ON r.rec_id = d.rec_id AND coalesce({s_plain('r.title')}, '') = coalesce({s_plain("regexp_replace(q.title, '^03-', '')")}, '')"""


def names_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of all artists that are credited."""
    return who.artist_names(view(spark, sf_dir, "credit"), view(spark, sf_dir, "artist"))


NAMES_SQL = "SELECT DISTINCT artist_id, name FROM credit JOIN artist USING (artist_id) WHERE name <> ''"


def label_for_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completing.label_of(view(spark, sf_dir, "track_release"))


LABEL_SQL = """
, listed AS (
  SELECT rec_id, label, label_type, round, row_number() OVER (PARTITION BY rec_id, round ORDER BY release_id) AS place
  FROM (SELECT *, 0 AS round FROM track_release WHERE status = 'Official' UNION ALL SELECT *, 1 AS round FROM track_release) r)
SELECT rec_id, arg_min(label, (round, place)) AS label FROM listed WHERE place <= 100 AND label_type IS NOT NULL GROUP BY rec_id"""


def tag_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = view(spark, sf_dir, "recording")
    none = F.array().cast("array<string>")
    tags = completing.first_tags(F.when(F.col("rec_id") % 4 == 0, F.array("tag")), F.when(F.col("rec_id") % 4 == 1, F.array(F.lit("release"))).otherwise(none), F.when(F.col("rec_id") % 4 == 2, F.array(F.lit("group"))))
    return r.select("rec_id", F.array_join(tags, "|").alias("tags"))


TAG_SQL = "SELECT rec_id, CASE rec_id % 4 WHEN 0 THEN tag WHEN 1 THEN 'release' WHEN 2 THEN 'group' ELSE '' END AS tags FROM recording"


def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    recordings, requests, releases, credits, artists = _views(spark, sf_dir, "recording", "request", "track_release", "credit", "artist")
    hints = requests.select(F.col("request_id").alias("rec_id"), F.col("album").alias("wanted"), "year")
    genres = _kinds(spark, sf_dir).withColumnRenamed("kinds", "genres")
    groups = releases.select("group_id").distinct().filter("group_id % 3 = 0")
    group_tags = groups.select("group_id", F.array(F.concat(F.lit("group "), (F.col("group_id") % 5).cast("string"))).alias("group_tags"))
    return completing.enrich(recordings, hints, releases, credits, artists, genres, group_tags)


ENRICH_SQL = (
    BEST_RELEASE_SQL[: BEST_RELEASE_SQL.rindex("SELECT rec_id, title")]
    + """, best AS (SELECT * FROM ranked WHERE rn = 1),
who AS (SELECT rec_id, string_agg(CAST(artist_id AS VARCHAR), '|' ORDER BY pos) AS artist_ids, string_agg(name || joinphrase, '' ORDER BY pos) AS artist, arg_min(nation, pos) AS nation FROM credit JOIN artist USING (artist_id) GROUP BY rec_id),
counted AS (SELECT rec_id, primary_type AS name, count(*) AS n FROM track_release GROUP BY rec_id, primary_type),
g AS (SELECT rec_id, string_agg(name, '|' ORDER BY n DESC, name) AS genres FROM counted GROUP BY rec_id)
SELECT r.rec_id, r.title, who.artist, b.title AS album, b.date, CASE WHEN b.label_type IS NOT NULL THEN b.label END AS label, r.isrc, who.artist_ids, b.release_id, b.group_id, g.genres,
  CASE WHEN r.rec_id % 2 = 0 THEN r.tag WHEN b.secondary_type <> '' THEN b.secondary_type WHEN b.group_id % 3 = 0 THEN 'group ' || (b.group_id % 5) ELSE coalesce('nation ' || who.nation, '') END AS tags
FROM recording r LEFT JOIN best b USING (rec_id) LEFT JOIN who USING (rec_id) LEFT JOIN g USING (rec_id)"""
)


def _catalog(spark: SparkSession, sf_dir: str) -> cascade.Catalog:
    credits, artists = _views(spark, sf_dir, "credit", "artist")
    titles, credits = materialized(_titles(spark, sf_dir)), materialized(credits)
    return cascade.Catalog(view(spark, sf_dir, "recording", track_release=titles), titles, credits, artists, titled=True)


def _asked(spark: SparkSession, sf_dir: str, c: cascade.Catalog) -> DataFrame:
    return view(spark, sf_dir, "request", recording=c.recordings, credit=c.credits).withColumnRenamed("request_id", "ask_id")


def search_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _catalog(spark, sf_dir)
    return cascade.search(c, _asked(spark, sf_dir, c))


def find_recording(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _catalog(spark, sf_dir)
    return cascade.find_recordings(c, _asked(spark, sf_dir, c))


def _collaborations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Strings of credited names with the recording's title, and which names are known at once."""
    named, recordings, artists = _named(spark, sf_dir), *_views(spark, sf_dir, "recording", "artist")
    artist = F.concat(nested.credit_string(F.col("credits")), F.when(F.col("rec_id") % 5 == 0, F.lit(" feat. Nobody Else")).when(F.col("rec_id") % 7 == 0, F.lit(", Act 1 & Act 2")).otherwise(F.lit("")))
    asked = named.join(recordings, "rec_id").select(F.col("rec_id").alias("ask_id"), artist.alias("artist"), F.col("title").alias("song"))
    names = artists.select(F.explode(F.array_distinct(F.array("name", "alias"))).alias("name"), "artist_id").filter("artist_id % 10 <> 3").groupBy("name").agg(F.min("artist_id").alias("artist_id"))
    return asked, names


def _dotted(path: str) -> Column:
    return F.array_join(F.transform(path, lambda x: x.cast("string")), ".")


def hierarchical(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, names = _collaborations(spark, sf_dir)
    found = collaboration.hierarchical(collaboration.first_parts(asked), names)
    return found.withColumn("path", _dotted("path"))


def hierarchical_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, _ = _collaborations(spark, sf_dir)
    found = collaboration.hierarchical_with_recordings(collaboration.first_parts(asked), asked.select("ask_id", "song"), *_views(spark, sf_dir, "artist", "recording", "credit"))
    return found.select("ask_id", _dotted("path").alias("path"), "name", "artist_id", F.array_join(F.transform("rec_ids", lambda x: x.cast("string")), "|").alias("rec_ids"))


def quorum(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, _ = _collaborations(spark, sf_dir)
    artists, recordings, credits = _views(spark, sf_dir, "artist", "recording", "credit")
    found = collaboration.hierarchical_with_recordings(collaboration.first_parts(asked), asked.select("ask_id", "song"), artists, recordings, credits)
    return collaboration.quorum(found, credits, artists).select("ask_id", "rec_id", F.array_join(F.transform("artist_ids", lambda x: x.cast("string")), "|").alias("artist_ids"), "artist")


def resolve_collab(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, names = _collaborations(spark, sf_dir)
    found = collaboration.resolve_collaborations(asked, names, *_views(spark, sf_dir, "artist", "recording", "credit"))
    return found.select("ask_id", "stage", F.array_join(F.transform("artist_ids", lambda x: x.cast("string")), "|").alias("artist_ids"), F.array_join("artists", "|").alias("artists"), "artist")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        best_release, credit_string, genre_rank, primary_label, url_map, artist_match, recording_artist_match, variant_marker, score_recording, select_recording, resolve_isrc, search_artists,
        search_recordings, search_recordings_by, paged_candidates, all_candidate_pages, get_by_id, get_artist, get_release, get_release_group, get_by_isrc, browse_releases, browse_all_releases, search_releases, search_releases_by, search_release_groups, json_guard, find_artist_ids, and_of_ors, lookup_artist, quorum_lookup,
        validate_recordings, names_by_ids, label_for_recording, tag_fallback, enrich, search_cascade, find_recording, hierarchical, hierarchical_partial, quorum, resolve_collab,
    )
}


def sql() -> dict[str, str]:
    all_ = ("recording", "track_release", "credit", "artist", "request")
    return {
        "best_release": with_views(BEST_RELEASE_SQL, *all_),
        "credit_string": with_views(CREDIT_SQL, "credit", "artist"),
        "genre_rank": with_views(GENRE_SQL, "track_release"),
        "primary_label": with_views(PRIMARY_LABEL_SQL, "track_release"),
        "url_map": with_views(URL_SQL, "track_release"),
        "artist_match": with_views(ARTIST_MATCH_SQL, "artist"),
        "recording_artist_match": with_views(RECORDING_ARTIST_SQL, *all_),
        "variant_marker": with_views(VARIANT_SQL, "recording"),
        "score_recording": with_views(SCORE_SQL, *all_),
        "select_recording": with_views(SELECT_SQL, *all_),
        "resolve_isrc": with_views(ISRC_SQL, *all_),
        "search_artists": with_views(SEARCH_ARTISTS_SQL, *all_),
        "search_recordings": with_views(SEARCH_RECORDINGS_SQL, *all_),
        "search_recordings_by": with_views(SEARCH_BY_SQL, *all_),
        "search_releases_by": with_views(SEARCH_RELEASES_BY_SQL, *all_),
        "get_artist": with_views(GET_ARTIST_SQL, *all_),
        "get_release": with_views(GET_RELEASE_SQL, *all_),
        "get_release_group": with_views(GET_GROUP_SQL, *all_),
        "paged_candidates": with_views(PAGED_SQL, *all_),
        "all_candidate_pages": with_views(ALL_PAGES_SQL, *all_),
        "get_by_id": with_views(GET_SQL, *all_),
        "get_by_isrc": with_views("SELECT q.request_id AS ask_id, r.rec_id FROM request q LEFT JOIN recording r ON r.isrc = q.isrc", *all_),
        "browse_releases": with_views(BROWSE_SQL, "track_release"),
        "browse_all_releases": with_views(BROWSE_ALL_SQL, "track_release"),
        "search_releases": with_views(SEARCH_RELEASES_SQL, *all_),
        "search_release_groups": with_views(GROUPS_SQL, *all_),
        "json_guard": JSON_SQL,
        "find_artist_ids": with_views(_find_sql(), *all_, "track"),
        "and_of_ors": with_views(AND_OF_ORS_SQL, *all_),
        "validate_recordings": with_views(VALIDATE_SQL, *all_),
        "lookup_artist": with_views(_lookup_sql(False), *all_),
        "quorum_lookup": with_views(_lookup_sql(True), *all_),
        "names_by_ids": with_views(NAMES_SQL, *all_),
        "label_for_recording": with_views(LABEL_SQL, "track_release"),
        "tag_fallback": with_views(TAG_SQL, "recording"),
        "enrich": with_views(ENRICH_SQL, *all_),
    }
