"""Queries of the phrase index, and SQL that compares every phrase with every value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackforge.functions.text import plain
from trackforge.operators import artists as who, phrases
from trackforge.plans.catalog_queries import _find_sql, _views
from trackforge.plans.text_queries import Query, s_plain
from trackforge.sources.catalog import view, with_views


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of titles and names, whole ones, and with some an album."""
    title, artist = plain(F.col("title")), plain(F.col("artist"))
    last = lambda c, n: F.array_join(F.reverse(F.slice(F.reverse(F.split(c, " ")), 1, n)), " ")
    by, r = F.col("request_id"), view(spark, sf_dir, "request")
    return r.select(
        by.alias("ask_id"),
        F.when(by % 3 == 0, F.substring_index(title, " ", 1)).when(by % 3 == 1, F.col("title")).otherwise(last(title, 2)).alias("title"),
        F.when(by % 4 == 0, last(artist, 1)).when(by % 4 < 3, F.col("artist")).alias("artist"),
        F.when(by % 5 == 0, F.col("album")).alias("album"),
    )


def phrase_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _asked(spark, sf_dir).select("ask_id", F.col("artist").alias("name"))
    return phrases.search_artists(asked, phrases.artist_phrases(view(spark, sf_dir, "artist")))


def phrase_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = phrases.recording_phrases(*_views(spark, sf_dir, "recording", "track_release", "credit", "artist"))
    return phrases.search_recordings(_asked(spark, sf_dir), index, limit=20, offset=5)


def find_artist_ids_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, artists = view(spark, sf_dir, "track").select(F.col("track_id").alias("ask_id"), "artist"), view(spark, sf_dir, "artist")
    return who.find_artist_ids(asked, artists, index=phrases.artist_phrases(artists))


ASKED_SQL = f"""
, normed AS (SELECT *, {s_plain('title')} AS t, {s_plain('artist')} AS a FROM request),
asked AS (
  SELECT request_id AS ask_id,
    CASE request_id % 3 WHEN 0 THEN string_split(t, ' ')[1] WHEN 1 THEN title ELSE array_to_string(string_split(t, ' ')[-2:], ' ') END AS title,
    CASE WHEN request_id % 4 = 0 THEN string_split(a, ' ')[-1] WHEN request_id % 4 < 3 THEN artist END AS artist,
    CASE WHEN request_id % 5 = 0 THEN album END AS album
  FROM normed)"""
NAMES_SQL = "SELECT artist_id AS key, 'name' AS field, unnest([name, alias]) AS text FROM artist"


def _hits_sql(values: str, wanted: str) -> str:
    """CTEs that end in hit (ask_id, key, score), from SQL of values (key, field, text) and of wanted (ask_id, field, phrase)."""
    return f"""
, value AS (SELECT DISTINCT key, field, {s_plain('text')} AS value FROM ({values}) v WHERE {s_plain('text')} IS NOT NULL),
held AS (SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(string_split(value, ' '))) AS word FROM value) w GROUP BY word),
weight AS (SELECT word, length(bin((SELECT count(*) FROM value) // n)) AS w FROM held),
value_word AS (SELECT value, unnest(string_split(value, ' ')) AS word FROM (SELECT DISTINCT value FROM value) d),
whole AS (SELECT value, sum(w) AS whole FROM value_word JOIN weight USING (word) GROUP BY value),
wanted AS (SELECT DISTINCT ask_id, field, {s_plain('phrase')} AS phrase FROM ({wanted}) w WHERE coalesce(phrase, '') <> ''),
phrase_word AS (SELECT phrase, unnest(string_split(phrase, ' ')) AS word FROM (SELECT DISTINCT phrase FROM wanted) d),
cover AS (SELECT phrase, sum(coalesce(w, 0)) AS covers FROM phrase_word LEFT JOIN weight USING (word) GROUP BY phrase),
stands AS (
  SELECT field, phrase, value FROM (SELECT DISTINCT field, phrase FROM wanted WHERE phrase IS NOT NULL) p JOIN (SELECT DISTINCT field, value FROM value) v USING (field)
  WHERE contains(' ' || value || ' ', ' ' || phrase || ' ')),
met AS (
  SELECT ask_id, v.key, w.field, w.phrase, max(CAST(100 * covers // whole AS INTEGER)) AS score
  FROM wanted w JOIN stands s ON s.field = w.field AND s.phrase = w.phrase JOIN value v ON v.field = s.field AND v.value = s.value
  JOIN whole ON whole.value = v.value JOIN cover ON cover.phrase = w.phrase GROUP BY ask_id, v.key, w.field, w.phrase),
conditions AS (SELECT ask_id, count(*) AS n FROM wanted GROUP BY ask_id),
hit AS (
  SELECT ask_id, key, CAST(sum(score) // n AS INTEGER) AS score FROM met JOIN conditions USING (ask_id) GROUP BY ask_id, key, n HAVING count(*) = n)"""


def _page_sql(key: str, limit: int, offset: int = 0) -> str:
    return f"""
SELECT ask_id, key AS {key}, score, rank, total
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ask_id ORDER BY score DESC, key) AS INTEGER) AS rank, count(*) OVER (PARTITION BY ask_id) AS total FROM hit) h
WHERE rank > {offset} AND rank <= {offset + limit}"""


ARTISTS_SQL = ASKED_SQL + _hits_sql(NAMES_SQL, "SELECT ask_id, 'name' AS field, artist AS phrase FROM asked") + _page_sql("artist_id", 100)
RECORDINGS_SQL = (
    ASKED_SQL
    + _hits_sql(
        """SELECT rec_id AS key, 'title' AS field, title AS text FROM recording UNION ALL SELECT rec_id, 'artist', unnest([name, alias]) FROM credit JOIN artist USING (artist_id)
  UNION ALL SELECT rec_id, 'album', title FROM track_release""",
        "SELECT ask_id, unnest(['title', 'artist', 'album']) AS field, unnest([title, artist, album]) AS phrase FROM asked WHERE title <> ''",
    )
    + _page_sql("rec_id", 20, 5)
)


def _graded_sql() -> str:
    """find_artist_ids with these hits."""
    text = _find_sql()
    variations, rest = text[: text.index(", hits AS (")], text[text.index("seen AS (") :]
    hits = _hits_sql(NAMES_SQL, "SELECT track_id * 100 + ord AS ask_id, 'name' AS field, variation AS phrase FROM tv")
    ranked = """,
ranked AS (SELECT ask_id // 100 AS track_id, ask_id % 100 AS ord, key AS artist_id, score, row_number() OVER (PARTITION BY ask_id ORDER BY score DESC, key) AS place FROM hit),
hits AS (SELECT * FROM ranked WHERE score >= 70),
"""
    return variations + hits + ranked + rest


QUERIES: dict[str, Query] = {f.__name__: f for f in (phrase_artists, phrase_recordings, find_artist_ids_graded)}


def sql() -> dict[str, str]:
    all_ = ("recording", "track_release", "credit", "artist", "request")
    return {
        "phrase_artists": with_views(ARTISTS_SQL, *all_),
        "phrase_recordings": with_views(RECORDINGS_SQL, *all_),
        "find_artist_ids_graded": with_views(_graded_sql(), *all_, "track"),
    }
