"""SQL of the queries that resolve strings of several artists: recursive, by splitting every part once more."""

from __future__ import annotations

from trackforge.functions import splitting
from trackforge.plans.catalog_queries import CREDIT_SQL, _lookup_sql
from trackforge.plans.text_queries import Query
from trackforge.sources.catalog import with_views

QUERIES: dict[str, Query] = {}
MAX_DEPTH = 3


def _best_cut(x: str) -> str:
    """The most telling cut of a string, or null: rank, place, least length of a side, whether at a mark, and both sides."""
    cut = lambda found, rank, least, mark, left, right: f"CASE WHEN {found} THEN {{'rank': {rank}, 'at': length({left}), 'least': {least}, 'mark': {mark}, 'l': {left}, 'r': {right}}} END"
    cuts = []
    for i, word in enumerate(splitting.DELIMITERS):
        head = r"^(.*?[^\d\s])" if word == "ft" else "^(.*?)"
        p = rf"(?i){head}\s+{word.replace('.', chr(92) + '.')}\s+(.*)$"
        cuts.append(cut(f"regexp_matches({x}, '{p}')", i, 3, "FALSE", f"regexp_extract({x}, '{p}', 1)", f"regexp_extract({x}, '{p}', 2)"))
    for m in ",;":
        p = f"^([^{m}]*){m}(.*)$"
        cuts.append(cut(f"contains({x}, '{m}')", splitting.MARK_RANK, 3, "TRUE", f"regexp_extract({x}, '{p}', 1)", f"regexp_extract({x}, '{p}', 2)"))
    left, right = (f"regexp_extract({x}, '^([^/]*)/(.*)$', {i})" for i in (1, 2))
    apart = f"contains({x}, '/') AND NOT (rtrim({left}) LIKE '% w' OR lower({left}) = 'w') AND (contains(trim({left}), ' ') OR contains(trim({right}), ' ') OR (length(trim({left})) >= 3 AND length(trim({right})) >= 3))"
    cuts.append(cut(apart, splitting.MARK_RANK, 2, "FALSE", left, right))
    return f"list_sort(list_filter([{', '.join(cuts)}], lambda c: c IS NOT NULL))[1]"


def _halves(best: str) -> str:
    """Both sides of a cut, or null where it does not separate names."""
    side = lambda c: rf"CASE WHEN {best}.mark THEN trim(regexp_replace(trim({best}.{c}), '(?i)^(?:&|and)\s+', '')) ELSE trim({best}.{c}) END"
    left, right = side("l"), side("r")
    return f"CASE WHEN {best} IS NOT NULL AND length({left}) >= {best}.least AND length({right}) >= {best}.least THEN [{left}, {right}] END"


PARTS = f"""
, credited AS ({CREDIT_SQL}),
asked AS (
  SELECT rec_id AS ask_id, artist || CASE WHEN rec_id % 5 = 0 THEN ' feat. Nobody Else' WHEN rec_id % 7 = 0 THEN ', Act 1 & Act 2' ELSE '' END AS artist, title AS song
  FROM credited JOIN recording USING (rec_id)),
known AS (
  SELECT name, min(artist_id) AS artist_id FROM (SELECT DISTINCT unnest([name, alias]) AS name, artist_id FROM artist WHERE artist_id % 10 <> 3) n GROUP BY name),
part(ask_id, path, name, halves, depth) AS (
  SELECT ask_id, [i - 1], h[i], {_halves('cut')}, 0
  FROM (SELECT *, {_best_cut('h[i]')} AS cut FROM (
    SELECT ask_id, {_halves('cut')} AS h, unnest([1, 2]) AS i FROM (SELECT *, {_best_cut('artist')} AS cut FROM asked) a) b WHERE h IS NOT NULL) c
  UNION ALL
  SELECT ask_id, list_append(path, i - 1), half, {_halves('cut')}, depth + 1
  FROM (SELECT *, {_best_cut('half')} AS cut FROM (
    SELECT ask_id, path, depth, i, halves[i] AS half FROM part, (SELECT unnest([1, 2]) AS i) two WHERE halves IS NOT NULL AND depth + 1 < {MAX_DEPTH}) d) e),
song_part AS (SELECT p.*, song, row_number() OVER (ORDER BY ask_id, path) AS nid FROM part p JOIN asked USING (ask_id))"""
BY_NAME = """
, hit AS (SELECT nid, ask_id, path, p.name, artist_id FROM song_part p JOIN known k ON k.name = p.name),
missed AS (SELECT * FROM song_part WHERE nid NOT IN (SELECT nid FROM hit) AND (halves IS NULL OR depth + 1 >= %d)),
counted AS (SELECT * FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit a WHERE a.ask_id = h.ask_id AND len(a.path) < len(h.path) AND a.path = h.path[:len(a.path)])),
lost AS (SELECT DISTINCT ask_id FROM missed m WHERE NOT EXISTS (SELECT 1 FROM hit a WHERE a.ask_id = m.ask_id AND len(a.path) < len(m.path) AND a.path = m.path[:len(a.path)])),
whole AS (SELECT * FROM counted WHERE ask_id NOT IN (SELECT ask_id FROM lost))""" % MAX_DEPTH


def _by_recording() -> str:
    """CTEs that end in shared: the parts that count, with their recordings of the song."""
    text = _lookup_sql(True)
    start, end = text.index(", q AS ("), text.index("v AS (")
    text = text[:start] + ", q AS (SELECT nid AS ask_id, name AS artist, song FROM song_part),\n" + text[end:]
    head, last = text.rsplit("\nSELECT ", 1)
    return f"""{head},
looked AS (SELECT {last}),
heard AS (SELECT s.*, artist_id, rec_ids FROM song_part s JOIN looked l ON l.ask_id = s.nid),
shared AS (SELECT * FROM heard h WHERE NOT EXISTS (SELECT 1 FROM heard a WHERE a.ask_id = h.ask_id AND len(a.path) < len(h.path) AND a.path = h.path[:len(a.path)]))"""


QUORUM = """
, placed AS (SELECT ask_id, string_split(rec_ids, '|') AS recs, row_number() OVER (PARTITION BY ask_id ORDER BY path) AS place, count(*) OVER (PARTITION BY ask_id) AS n FROM shared),
vote AS (SELECT ask_id, n, place, CAST(unnest(recs) AS BIGINT) AS rec_id, unnest(range(len(recs))) AS i FROM placed WHERE n >= 2),
voted AS (SELECT ask_id, n, rec_id, count(*) AS votes, min((place, i)) AS first FROM vote GROUP BY ask_id, n, rec_id),
agreed AS (SELECT ask_id, arg_min(rec_id, (-votes, first)) AS rec_id FROM voted WHERE votes >= greatest(2, n // 2) GROUP BY ask_id),
agreed_names AS (
  SELECT ask_id, rec_id, string_agg(CAST(artist_id AS VARCHAR), '|' ORDER BY pos) AS artist_ids, string_agg(name, '|' ORDER BY pos) AS artists, string_agg(name, ', ' ORDER BY pos) AS artist
  FROM agreed JOIN credit USING (rec_id) JOIN artist USING (artist_id) GROUP BY ask_id, rec_id)"""
RESOLVE = r"""
, stage_1 AS (SELECT ask_id, 1 AS stage, CAST(artist_id AS VARCHAR) AS artist_ids, artist AS artists, artist FROM asked JOIN known ON known.name = asked.artist WHERE trim(artist) <> ''),
listed AS (
  SELECT w.ask_id, list(artist_id ORDER BY path) AS ids, list(w.name ORDER BY path) AS names FROM whole w WHERE w.ask_id NOT IN (SELECT ask_id FROM stage_1) GROUP BY w.ask_id),
stage_2 AS (
  SELECT ask_id, 2 AS stage, array_to_string(list_transform(list_filter(ids, lambda x, i: list_position(ids, x) = i), lambda x: CAST(x AS VARCHAR)), '|') AS artist_ids, array_to_string(names, '|') AS artists, artist
  FROM listed JOIN asked USING (ask_id)),
stage_3 AS (
  SELECT ask_id, 3 AS stage, artist_ids, artists, artist FROM agreed_names WHERE ask_id NOT IN (SELECT ask_id FROM stage_1 UNION ALL SELECT ask_id FROM stage_2) AND ask_id IN (SELECT ask_id FROM asked WHERE song <> '')),
main AS (
  SELECT ask_id, trim(regexp_extract(artist, '(?i)^(.+?)\s+(?:feat\.?|ft\.?|featuring)\s+.+$', 1)) AS artist FROM asked
  WHERE ask_id NOT IN (SELECT ask_id FROM stage_1 UNION ALL SELECT ask_id FROM stage_2 UNION ALL SELECT ask_id FROM stage_3)),
stage_4 AS (SELECT m.ask_id, 4 AS stage, CAST(artist_id AS VARCHAR) AS artist_ids, m.artist AS artists, a.artist FROM main m JOIN known ON known.name = m.artist JOIN asked a USING (ask_id))
SELECT * FROM stage_1 UNION ALL SELECT * FROM stage_2 UNION ALL SELECT * FROM stage_3 UNION ALL SELECT * FROM stage_4"""
_PATH = "array_to_string(list_transform(path, lambda x: CAST(x AS VARCHAR)), '.') AS path"


def sql() -> dict[str, str]:
    all_ = ("recording", "track_release", "credit", "artist")
    full = lambda text: with_views(text, *all_).replace("WITH ", "WITH RECURSIVE ", 1)
    shared = PARTS + _by_recording()
    return {
        "hierarchical": full(PARTS + BY_NAME + f"\nSELECT ask_id, {_PATH}, name, artist_id FROM whole"),
        "hierarchical_partial": full(shared + f"\nSELECT ask_id, {_PATH}, name, artist_id, rec_ids FROM shared"),
        "quorum": full(shared + QUORUM + "\nSELECT ask_id, rec_id, artist_ids, artist FROM agreed_names"),
        "resolve_collab": full(shared + QUORUM + BY_NAME + RESOLVE),
    }
