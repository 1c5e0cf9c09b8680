"""SQL of the cascade: the tries of every step, the choice in each, and the first step that has one."""

from __future__ import annotations

from trackforge.plans.catalog_queries import _find_sql, _step
from trackforge.plans.text_queries import Query, s_norm, s_plain, s_points, s_tight, s_year
from trackforge.sources.catalog import with_views

QUERIES: dict[str, Query] = {}
_SUFFIX = r"'^\s*(.*)\s+[\(\[].*[\)\]]$'"

CATALOG = rf"""
, forms AS (SELECT DISTINCT rec_id, title_key FROM (SELECT rec_id, unnest([{s_plain('title')},
    CASE WHEN regexp_matches(title, {_SUFFIX}) THEN {s_plain(f"regexp_extract(title, {_SUFFIX}, 1)")} END,
    {s_plain(r"regexp_replace(regexp_replace(title, ' [\(\[](?:Radio Edit|Remastered)[\)\]]', ''), ' - Single Version$', '')")}]) AS title_key FROM recording) WHERE title_key IS NOT NULL),
rel AS (SELECT rec_id, {s_plain('title')} AS album_key, {s_norm('title')} AS release_key, {s_year('date')} AS released, {s_points('primary_type', 'secondary_type')} AS points, secondary_type IN ('Compilation', 'Live') AS other_kind, various FROM track_release),
on_album AS (SELECT DISTINCT rec_id, album_key FROM rel),
who_credits AS (
  SELECT rec_id, count(*) AS n_credits, arg_min(name, pos) AS first_name, arg_min(joinphrase, pos) AS first_join, list({s_tight('name')} ORDER BY pos) AS names FROM credit JOIN artist USING (artist_id) GROUP BY rec_id)"""


def _ids(strings: str) -> str:
    """CTEs from SQL of strings (artist) that end in by_id (artist, artist_id) and variation_of (artist, ord, variation), with artist_key on the way."""
    text = _find_sql().replace("FROM track)", "FROM track_string)").replace("FROM track_string)", "FROM named_string)").replace("JOIN track USING", "JOIN named_string USING")
    text = text.replace("track.artist", "named_string.artist").replace("FROM track ", "FROM named_string ").replace("FROM track\n", "FROM named_string\n").replace("FROM track,", "FROM named_string,")
    head, last = text.rsplit("\nSELECT ", 1)
    return f"""
, named_string AS (SELECT artist, row_number() OVER (ORDER BY artist) AS track_id FROM ({strings}) s){head},
by_id AS (SELECT artist, artist_id FROM (SELECT {last}) f JOIN named_string ON track_id = ask_id),
variation_of AS (SELECT artist, ord, variation FROM tv JOIN named_string USING (track_id))"""


def _search(asked: str, x: str) -> str:
    """CTEs that end in found_x (ask_id, rec_id, step), from the table ``asked`` (ask_id, title, artist, album, year)."""
    bare = lambda c: s_tight(rf"regexp_replace({c}, '(?i)^(?:the|a|an)\s+', '')")
    return rf"""
, want_{x} AS (SELECT *, {s_plain('title')} AS title_key, {s_plain('album')} AS wanted_album FROM {asked} WHERE title <> '' AND artist <> ''),
name_hit_{x} AS (
  SELECT DISTINCT w.*, v.ord, f.rec_id FROM want_{x} w JOIN variation_of v ON v.artist = w.artist JOIN artist_key k ON k.artist_key = {s_plain('v.variation')}
  JOIN credit c ON c.artist_id = k.artist_id JOIN forms f ON f.rec_id = c.rec_id AND f.title_key = w.title_key),
id_hit_{x} AS (
  SELECT DISTINCT w.*, f.rec_id FROM want_{x} w JOIN by_id i ON i.artist = w.artist JOIN credit c ON c.artist_id = i.artist_id JOIN forms f ON f.rec_id = c.rec_id AND f.title_key = w.title_key),
group_{x} AS (
  SELECT ask_id, g, artist_id FROM (SELECT ask_id, unnest(parts) AS artist, unnest(range(len(parts))) AS g FROM (SELECT ask_id, {_PARTS} AS parts FROM want_{x} WHERE contains(artist, ',')) a WHERE len(parts) >= 2) p LEFT JOIN by_id USING (artist)),
group_hit_{x} AS (
  SELECT w.*, m.rec_id FROM want_{x} w JOIN (
    SELECT ask_id, rec_id, count(DISTINCT g) AS met FROM group_{x} JOIN credit USING (artist_id) GROUP BY ask_id, rec_id) m USING (ask_id)
  JOIN forms f ON f.rec_id = m.rec_id AND f.title_key = w.title_key
  WHERE met = (SELECT count(DISTINCT g) FROM group_{x} z WHERE z.ask_id = w.ask_id)),
tried_{x} AS (
  SELECT ask_id, 101000 + ord AS slot, rec_id, title, artist, album, year, TRUE AS checked, FALSE AS loose, 500 AS cap FROM name_hit_{x} WHERE album <> '' AND (rec_id, wanted_album) IN (SELECT (rec_id, album_key) FROM on_album)
  UNION ALL SELECT ask_id, 100000 + round * 1000 + ord, rec_id, title, artist, NULL, year, TRUE, round = 3, 500 FROM name_hit_{x}, (SELECT unnest([2, 3]) AS round) r
  UNION ALL SELECT ask_id, slot, rec_id, title, artist, album, year, FALSE, FALSE, 100 FROM (
    SELECT *, count(*) OVER (PARTITION BY ask_id, slot) AS n FROM (
      SELECT ask_id, CASE WHEN regexp_matches(artist, '[^\x00-\x7F]') THEN 0 ELSE 500000 END AS slot, rec_id, title, artist, album, year FROM id_hit_{x} WHERE album <> '' AND (rec_id, wanted_album) IN (SELECT (rec_id, album_key) FROM on_album)
      UNION ALL SELECT ask_id, CASE WHEN regexp_matches(artist, '[^\x00-\x7F]') THEN 1 ELSE 500001 END, rec_id, title, artist, NULL, year FROM id_hit_{x}) b) d JOIN (SELECT rec_id, first_date FROM recording) born USING (rec_id)
    WHERE n <= 150 OR abs(CAST(substr(first_date, 1, 4) AS INTEGER) - year) <= 1
  UNION ALL SELECT ask_id, 400000, rec_id, title, artist, album, year, FALSE, FALSE, 100 FROM group_hit_{x} WHERE album <> '' AND (rec_id, wanted_album) IN (SELECT (rec_id, album_key) FROM on_album)
  UNION ALL SELECT ask_id, 400001, rec_id, title, artist, NULL, year, FALSE, FALSE, 100 FROM group_hit_{x}),
kept_try_{x} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ask_id, slot ORDER BY rec_id) AS place FROM tried_{x}) t WHERE place <= cap),
credited_{x} AS (
  SELECT t.*, r.title AS own_title, r.isrc, r.length, r.disambiguation, r.first_date, n_credits FROM kept_try_{x} t JOIN recording r USING (rec_id) LEFT JOIN who_credits w USING (rec_id)
  WHERE NOT checked OR CASE WHEN coalesce(n_credits, 0) < 1 THEN FALSE
    WHEN n_credits = 1 THEN coalesce({bare('first_name')}, '') = coalesce({bare('artist')}, '')
    ELSE len(list_filter(names, lambda y: NOT contains({s_tight('artist')}, y))) = 0 OR (coalesce({bare('first_name')}, '') = coalesce({bare('artist')}, '') AND contains(first_join, 'feat')) END),
pair_{x} AS (SELECT DISTINCT ask_id, rec_id, coalesce(album, '') AS album_given, album, year, {s_norm('album')} AS wanted FROM credited_{x}),
summed_{x} AS (
  SELECT ask_id, rec_id, album_given, max(CASE WHEN wanted IS NULL THEN 0 WHEN release_key = wanted THEN 100 WHEN contains(release_key, wanted) OR contains(wanted, release_key) THEN 50 ELSE 0 END
      + {_step("abs(released - year)", (0, 75), (1, 40), (5, 20))}) + sum(points) + sum(CASE WHEN released < 2000 THEN 15 WHEN released < 2010 THEN 10 WHEN released < 2020 THEN 5 ELSE 0 END) AS points,
    bool_or((wanted IS NULL OR release_key = wanted) AND NOT various AND NOT other_kind) AS plain_ok, bool_or((wanted IS NULL OR release_key = wanted) AND NOT various) AS any_ok, bool_or((wanted IS NULL OR release_key = wanted) AND various) AS va
  FROM pair_{x} JOIN rel USING (rec_id) GROUP BY ask_id, rec_id, album_given),
scored_{x} AS (
  SELECT h.ask_id, slot, h.rec_id, h.title AS asked, place, isrc IS NOT NULL AS has_isrc, CASE WHEN loose THEN any_ok ELSE plain_ok END AS qualifies, va, coalesce({s_tight('h.title')} = {s_tight('h.own_title')}, FALSE) AS exact,
    date_diff('day', make_date(CAST(substr(first_date, 1, 4) AS BIGINT), CAST(coalesce(nullif(substr(first_date, 6, 2), ''), '7') AS BIGINT), least(CAST(coalesce(nullif(substr(first_date, 9, 2), ''), '15') AS BIGINT), 28)), DATE '2100-01-01') AS days,
    CASE WHEN isrc IS NULL THEN 0 ELSE 50 END + (2100 - CAST(substr(first_date, 1, 4) AS INTEGER)) * 10 + {_step("abs(CAST(substr(first_date, 1, 4) AS INTEGER) - year)", (0, 500), (1, 300), (2, 150), (5, 50))}
      + CASE WHEN length IS NULL THEN 0 ELSE 5 END + 5 * coalesce(n_credits, 0)
      + CASE WHEN disambiguation = '' THEN 0 WHEN disambiguation = '1995 remaster' OR (disambiguation = 'live' AND regexp_matches(h.title, '(?i)\blive\b')) THEN 10 ELSE -50 END + points AS score
  FROM credited_{x} h JOIN summed_{x} s ON s.ask_id = h.ask_id AND s.rec_id = h.rec_id AND s.album_given = coalesce(h.album, '')),
ranked_{x} AS (
  SELECT *, row_number() OVER (PARTITION BY ask_id, slot ORDER BY exact DESC, score DESC, days DESC, place) AS rk, bool_or(exact) OVER (PARTITION BY ask_id, slot) AS any_exact FROM scored_{x}),
fit_{x} AS (SELECT * FROM ranked_{x} WHERE any_exact OR NOT regexp_matches(asked, {_SUFFIX})),
firsts_{x} AS (
  SELECT ask_id, slot, min(rk) FILTER (qualifies) AS w, min(rk) FILTER (exact AND has_isrc AND NOT qualifies) AS f, min(rk) FILTER (va) AS v FROM fit_{x} GROUP BY ask_id, slot),
answer_{x} AS (
  SELECT y.ask_id, y.slot, CASE WHEN w IS NOT NULL THEN CASE WHEN f < w AND NOT k.has_isrc THEN f ELSE w END ELSE coalesce(f, v) END AS rk
  FROM firsts_{x} y LEFT JOIN fit_{x} k ON k.ask_id = y.ask_id AND k.slot = y.slot AND k.rk = y.w),
found_{x} AS (SELECT ask_id, arg_min(rec_id, slot) AS rec_id, CAST(min(slot) // 100000 AS INTEGER) AS step FROM answer_{x} JOIN fit_{x} USING (ask_id, slot, rk) GROUP BY ask_id)"""


_PARTS = r"list_filter(list_transform(string_split(artist, ','), lambda y: trim(regexp_replace(trim(y), '(?i)^(?:&|and)\s+', ''))), lambda y: y <> '')"
_STRINGS = f"SELECT artist FROM request UNION SELECT unnest({_PARTS}) FROM request WHERE contains(artist, ',')"
_GIVEN = r"""
, given AS (
  SELECT request_id AS ask_id, CASE WHEN regexp_matches(title, '^\d{1,4}[-.]') THEN coalesce(nullif(trim(regexp_replace(title, '^\d{1,4}[-.]\s*', '')), ''), title) ELSE title END AS title, artist, album, year, isrc FROM request),
sizes AS (SELECT rec_id, count(*) AS n FROM track_release GROUP BY rec_id),
coded AS (
  SELECT ask_id, arg_min(rec_id, (-coalesce(n, 0), rec_id)) AS rec_id FROM given g JOIN recording r ON upper(trim(r.isrc)) = upper(trim(g.isrc)) LEFT JOIN sizes USING (rec_id) WHERE g.title <> '' AND g.artist <> '' GROUP BY ask_id),
left_over AS (SELECT * FROM given WHERE ask_id NOT IN (SELECT ask_id FROM coded))"""


def sql() -> dict[str, str]:
    all_ = ("recording", "track_release", "credit", "artist", "request")
    plainly = "\n, asked_all AS (SELECT request_id AS ask_id, title, artist, album, year FROM request)"
    based = rf"""
, based AS (SELECT ask_id, regexp_extract(title, {_SUFFIX}, 1) AS title, artist, album, year FROM left_over
  WHERE ask_id NOT IN (SELECT ask_id FROM found_a) AND regexp_matches(title, {_SUFFIX}) AND regexp_extract(title, {_SUFFIX}, 1) <> title)"""
    last = """
SELECT g.ask_id, coalesce(coded.rec_id, found_a.rec_id) AS exact_id, found_b.rec_id AS fallback_id
FROM given g LEFT JOIN coded USING (ask_id) LEFT JOIN found_a USING (ask_id) LEFT JOIN found_b USING (ask_id)"""
    return {
        "search_cascade": with_views(CATALOG + _ids(_STRINGS) + plainly + _search("asked_all", "a") + "\nSELECT ask_id, rec_id, step FROM found_a", *all_),
        "find_recording": with_views(CATALOG + _ids(_STRINGS) + _GIVEN + _search("left_over", "a") + based + _search("based", "b") + last, *all_),
    }
