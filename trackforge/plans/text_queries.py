"""Queries of the text, date and splitting functions, with SQL that computes the same by other means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackforge.functions import dates, lucene, splitting, text
from trackforge.sources.catalog import view, with_views

Query = Callable[[SparkSession, str], DataFrame]

# ---- SQL expressions


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def s_fold(x: str) -> str:
    return f"translate({x}, 'ΛΔӨЯλδөя†', 'AAORaaort')"


def s_quotes(x: str) -> str:
    return f"translate({x}, '‘’“”', '''''\"\"')"


def s_plain(x: str) -> str:
    bare = rf"regexp_replace(strip_accents(lower({x})), '[\p{{Mn}}\p{{Me}}\p{{Lm}}\p{{Sc}}\p{{Sk}}\p{{No}}]', '', 'g')"
    return rf"nullif(trim(regexp_replace({bare}, '[\p{{P}}\p{{Z}}\p{{So}}\p{{Sm}}\p{{Cc}}\p{{Cf}}\p{{Mc}}]+', ' ', 'g')), '')"


def s_norm(x: str) -> str:
    folded = s_quotes(s_fold(x))
    return f"nullif(coalesce({s_plain(folded)}, {folded}), '')"


def s_tight(x: str) -> str:
    return f"replace({s_norm(x)}, ' ', '')"


def s_no_article(x: str) -> str:
    bare = rf"regexp_replace({x}, '(?i)^(?:the|a|an)\s+', '')"
    return f"coalesce({s_tight(bare)}, '')"


def s_track_number(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\d{{1,4}}[-.]') THEN nullif({s_strip(rf"regexp_replace({x}, '^\d{{1,4}}[-.]\s*', '')")}, '') END"


def s_title_key(x: str) -> str:
    key = rf"regexp_replace({s_strip(f'lower({x})')}, '\s*&\s*', ' and ', 'g')"
    key = rf"regexp_replace({key}, '(?i)\b(?:feat(?:uring)?\.?|ft\.?)\b', 'feat', 'g')"
    return s_strip(rf"regexp_replace({key}, '\s+', ' ', 'g')")


def s_year(x: str) -> str:
    return rf"TRY_CAST(nullif(regexp_extract(CAST({x} AS VARCHAR), '\b(?:19|20)\d{{2}}\b'), '') AS INTEGER)"


_PHRASES = "|".join(sorted(text.VERSION_PHRASES, key=len, reverse=True))


def s_clean(x: str) -> str:
    out = x
    for p in (rf" \((?:{_PHRASES})\)", rf" - (?:{_PHRASES}$)", rf" \[(?:{_PHRASES})\]"):
        out = f"regexp_replace({out}, '{p}', '', 'gi')"
    return f"CASE WHEN {x} <> '' THEN coalesce(nullif({out}, ''), {x}) END"


_FEAT = r"[\(\[](?:ft\.?|feat\.?|featuring|with|w/)\s+([^\)\]]+)[\)\]]"


def s_featured_title(x: str) -> str:
    left = s_strip(f"regexp_replace({x}, '{_FEAT}', '', 'gi')")
    left = rf"regexp_replace(regexp_replace({left}, '\s+', ' ', 'g'), '\s*[,;]\s*$', '', 'g')"
    return f"CASE WHEN regexp_matches({x}, '{_FEAT}', 'i') THEN {left} ELSE {x} END"


def s_featured_names(x: str) -> str:
    c = s_strip(f"regexp_extract({x}, '{_FEAT}', 1, 'i')")
    for p, to in ((r"[;,]\s*(?:ft\.?|feat\.?|w/|with)\s+", ", "), (r"\s+and\s+", ", "), (r"\s*[;&]\s*", ", "), (r"\s*\+\s*", ", ")):
        c = f"regexp_replace({c}, '{p}', '{to}', 'gi')"
    return f"array_to_string(list_filter(list_transform(string_split({c}, ','), lambda x: trim(x)), lambda x: x <> ''), '|')"


def s_days(x: str) -> str:
    y, m, d = (f"TRY_CAST(string_split({x}, '-')[{i}] AS INTEGER)" for i in (1, 2, 3))
    month, day = f"CASE WHEN len(string_split({x}, '-')) > 1 THEN least({m}, 12) ELSE 7 END", f"CASE WHEN len(string_split({x}, '-')) > 2 THEN least({d}, 28) ELSE 15 END"
    return f"CAST(coalesce(date_diff('day', make_date({y}, {month}, {day}), DATE '2100-01-01'), 0) AS INTEGER)"


def s_points(primary: str, secondary: str) -> str:
    return f"""greatest(0, CASE {primary} WHEN 'Album' THEN 25 WHEN 'Single' THEN 20 WHEN 'EP' THEN 20 WHEN 'Broadcast' THEN 10 ELSE 0 END
      - CASE WHEN {secondary} IN ('Compilation', 'Live', 'Demo', 'Mixtape/Street') THEN 15 WHEN {secondary} IN ('Remix', 'DJ-mix') THEN 10 ELSE 0 END)"""


def s_safe(x: str) -> str:
    return "replace(replace(" + x + ", '\\', '\\\\'), '\"', '\\\"')"


# ---- queries of one value per track

_join = lambda c: F.array_join(c, "|")


def _values() -> dict[str, tuple[Callable[[], Column], str]]:
    """name: (the value, the same in SQL)."""
    ids = lambda: F.concat(F.lit(" a"), F.col("size").cast("string"), F.lit("; b,, c\0 "))
    uuid = lambda: F.when(F.col("track_id") % 3 == 0, F.concat(F.lit("urn:uuid:"), F.md5(F.col("raw")))).when(F.col("track_id") % 3 == 1, F.concat(F.lit("{"), F.md5(F.col("raw")), F.lit("}"))).otherwise(F.col("raw"))
    return {
        "unsmart_quotes": (lambda: text.straight_quotes(F.col("raw")), s_quotes("raw")),
        "fold_chars": (lambda: text.latin_lookalikes(F.col("raw")), s_fold("raw")),
        "normalize_text": (lambda: text.normalize_text(F.col("raw")), s_norm("raw")),
        "normalize_nospace": (lambda: text.normalize(F.col("raw"), sizecheck=9, nospaces=True), f"CASE WHEN length(raw) < 9 THEN 'TEXT IS TOO SMALL IGNORE' ELSE {s_tight('raw')} END"),
        "strip_track_prefix": (lambda: text.strip_track_number(F.col("raw")), s_track_number("raw")),
        "conservative_variations": (
            lambda: _join(text.conservative_variations(F.col("artist"))),
            "CASE WHEN lower(artist) LIKE 'the %' THEN artist || '|' || substr(artist, 5) WHEN regexp_matches(artist, '^\\d{1,4}[-.]') THEN artist || '|' || regexp_replace(artist, '^\\d{1,4}[-.]\\s*', '') ELSE artist END",
        ),
        "clean_title": (lambda: text.clean_title(F.col("raw")), s_clean("raw")),
        "clean_title_custom": (lambda: text.clean_title(F.col("raw"), (r"(?U)^\d+[-.]\s*", r" \(Live\)$")), r"coalesce(nullif(regexp_replace(regexp_replace(raw, '^\d+[-.]\s*', ''), ' \(Live\)$', ''), ''), raw)"),
        "drop_artist_prefix": (
            lambda: text.drop_artist_prefix(F.col("raw"), F.regexp_extract(F.col("raw"), "^(Act [0-9]+)", 1)),
            r"CASE WHEN regexp_matches(raw, '^Act [0-9]+\s*[-–—]\s*.') THEN regexp_replace(raw, '^Act [0-9]+\s*[-–—]\s*', '') ELSE raw END",
        ),
        "featured_title": (lambda: text.featured_artists(F.col("raw"))["title"], s_featured_title("raw")),
        "featured_artists": (lambda: _join(text.featured_artists(F.col("raw"))["artists"]), s_featured_names("raw")),
        "id_clean": (lambda: text.clean_identifier(F.concat(F.col("raw"), F.lit(" \0\t"))), s_strip("raw")),
        "id_list_clean": (lambda: _join(text.clean_identifiers(ids())), "'a' || CAST(size AS VARCHAR) || '|b|c'"),
        "id_array_clean": (lambda: _join(text.clean_identifier_array(F.array(F.lit(" a b "), F.lit("\0"), F.col("artist")))), f"'a b|' || {s_strip('artist')}"),
        "sanitize_query": (lambda: text.sanitize_query(F.concat(F.col("raw"), F.lit('\\"'))), s_safe("raw || '\\\"'")),
        "title_match_key": (lambda: text.title_key(F.col("raw")), s_title_key("raw")),
        "norm_no_article": (lambda: text.norm_no_article(F.col("artist")), s_no_article("artist")),
        "version_base": (lambda: text.version_base(F.col("raw")), r"CASE WHEN regexp_matches(raw, '^\s*(.*)\s+[\(\[].*[\)\]]$') THEN regexp_extract(raw, '^\s*(.*)\s+[\(\[].*[\)\]]$', 1) END"),
        "valid_uuid": (lambda: text.valid_uuid(uuid()), "track_id % 3 < 2"),
        "is_ascii": (lambda: text.is_ascii(F.col("artist")), r"NOT regexp_matches(artist, '[^\x00-\x7F]')"),
        "lucene_artist_query": (lambda: lucene.artist_query(F.col("artist")), f"'(artist:\"' || {s_safe('artist')} || '\" OR alias:\"' || {s_safe('artist')} || '\" OR sortname:\"' || {s_safe('artist')} || '\")'"),
        "lucene_recording_query": (
            lambda: lucene.recording_query(
                F.col("raw"),
                artist_name=F.col("artist"),
                artist_ids=F.when(F.col("track_id") % 4 == 1, F.array(F.lit("i1"), F.lit("i2"))).otherwise(F.array().cast("array<string>")),
                artist_id_groups=F.when(F.col("track_id") % 4 == 2, F.array(F.array(F.lit("g1")), F.array(F.lit("g2"), F.lit("g3")))).otherwise(F.array().cast("array<array<string>>")),
                album=F.when(F.col("track_id") % 2 == 0, F.col("album")),
                strict=F.col("track_id") % 3 == 0,
                year=F.when(F.col("track_id") % 5 == 0, F.lit(2000) + F.col("size")),
            ),
            f"""'recording:"' || {s_safe('raw')} || '"' || CASE track_id % 4 WHEN 1 THEN ' AND (arid:i1 OR arid:i2)' WHEN 2 THEN ' AND arid:g1 AND (arid:g2 OR arid:g3)' ELSE ' AND artist:"' || {s_safe('artist')} || '"' END
            || CASE WHEN track_id % 2 = 0 THEN ' AND release:"' || album || '"' ELSE '' END
            || CASE WHEN track_id % 3 = 0 THEN ' AND -(secondarytype:Compilation OR secondarytype:Live) AND status:Official' ELSE '' END
            || CASE WHEN track_id % 5 = 0 THEN ' AND firstreleasedate:[' || (1999 + size) || ' TO ' || (2001 + size) || ']' ELSE '' END""",
        ),
        "track_year": (
            lambda: dates.track_year(F.when(F.col("track_id") % 4 == 0, F.concat(F.lit("ca. "), F.lit(1950) + F.col("size"))), F.when(F.col("track_id") % 3 == 0, F.lit("85")), F.concat((F.lit(1960) + F.col("size")).cast("string"), F.lit("-05"))),
            "CASE WHEN track_id % 4 = 0 THEN 1950 + size ELSE 1960 + size END",
        ),
        "comma_parts": (
            lambda: _join(splitting.comma_parts(F.col("artist"))),
            r"CASE WHEN contains(artist, ',') THEN array_to_string(list_transform(string_split(artist, ','), lambda x: regexp_replace(trim(x), '(?i)^(?:&|and)\s+', '')), '|') END",
        ),
    }


def _value_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return view(spark, sf_dir, "track").select("track_id", _values()[name][0]().alias("value"))

    return run


def dup_parens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "track").select("track_id", text.collapse_repeated_brackets(F.concat("raw", F.lit(" [Mix] (mix)"))).alias("value"))


def document_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised whole texts, by their digest."""
    return view(spark, sf_dir, "documents").select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("digest"))


def artist_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "track").select("track_id", F.posexplode(text.artist_variations(F.col("artist"))).alias("ord", "variation"))


def variations_sql() -> str:
    lower = "t.low"
    heads = [lower] + [rf"nullif(trim(regexp_replace(regexp_extract({lower}, '{p}', 1), '(?i)\s+(?:and|&|or|with|feat\.?|ft\.?)\s*$', '')), '')" for p in text.NAME_HEADS]
    forms = [f for h in heads for f in (h, s_fold(h), s_plain(h), s_fold(s_plain(h)))]
    sides = [f"CASE WHEN t.two THEN {f} END" for h in ("t.l", "t.r") for f in (h, s_fold(h), s_plain(h))]
    return rf"""
, base AS (SELECT track_id, {s_strip(rf"regexp_replace({s_quotes('lower(artist)')}, '\s+\.?\s*$', '')")} AS low FROM track),
both_forms AS (SELECT track_id, 0 AS pass, low FROM base UNION ALL SELECT track_id, 1, {s_track_number('low')} FROM base),
t AS (SELECT *, trim(string_split(low, '/')[1]) AS l, trim(string_split(low, '/')[-1]) AS r,
  len(string_split(low, '/')) = 2 AND length(trim(string_split(low, '/')[1])) >= 3 AND length(trim(string_split(low, '/')[-1])) >= 3 AND trim(string_split(low, '/')[1]) NOT LIKE '% w' AS two FROM both_forms WHERE low <> ''),
listed AS (SELECT track_id, pass, unnest([{', '.join(forms + sides)}]) AS variation, unnest(range({len(forms) + len(sides)})) AS i FROM t),
firsts AS (SELECT track_id, variation, min(pass * 1000 + i) AS i FROM listed WHERE variation IS NOT NULL GROUP BY track_id, variation)
SELECT track_id, CAST(row_number() OVER (PARTITION BY track_id ORDER BY i) - 1 AS INTEGER) AS ord, variation FROM firsts"""


def split_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "track").select("track_id", F.posexplode(splitting.split_artists(F.col("artist"))).alias("ord", "part"))


def _split_sql() -> str:
    cuts = []
    for i, w in enumerate(splitting.DELIMITERS):
        escaped = w.replace(".", r"\.").replace("/", "/")
        head = r"^(.*?[^\d\s])" if w == "ft" else "^(.*?)"
        p = rf"(?i){head}\s+{escaped}\s+(.*)$"
        cuts.append(f"SELECT track_id, artist, {i} AS prio, 3 AS least, FALSE AS mark, regexp_extract(artist, '{p}', 1) AS l, regexp_extract(artist, '{p}', 2) AS r FROM track WHERE regexp_matches(artist, '{p}')")
    for m in ",;":
        cuts.append(f"SELECT track_id, artist, 7, 3, TRUE, regexp_extract(artist, '^([^{m}]*){m}(.*)$', 1), regexp_extract(artist, '^([^{m}]*){m}(.*)$', 2) FROM track WHERE contains(artist, '{m}')")
    slash = "SELECT track_id, artist, regexp_extract(artist, '^([^/]*)/(.*)$', 1) AS l, regexp_extract(artist, '^([^/]*)/(.*)$', 2) AS r FROM track WHERE contains(artist, '/')"
    cuts.append(f"SELECT track_id, artist, 7, 2, FALSE, l, r FROM ({slash}) WHERE NOT (rtrim(l) LIKE '% w' OR lower(l) = 'w') AND (contains(trim(l), ' ') OR contains(trim(r), ' ') OR (length(trim(l)) >= 3 AND length(trim(r)) >= 3))")
    side = lambda x: rf"CASE WHEN mark THEN trim(regexp_replace(trim({x}), '(?i)^(?:&|and)\s+', '')) ELSE trim({x}) END"
    return f"""
, cuts AS ({' UNION ALL '.join(cuts)}),
best AS (SELECT *, {side('l')} AS a, {side('r')} AS b FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY prio, length(l)) AS rn FROM cuts) WHERE rn = 1),
good AS (SELECT * FROM best WHERE length(a) >= least AND length(b) >= least)
SELECT track_id, CAST(0 AS INTEGER) AS ord, a AS part FROM good UNION ALL SELECT track_id, 1, b FROM good
UNION ALL SELECT track_id, 0, artist FROM track WHERE track_id NOT IN (SELECT track_id FROM good)"""


def release_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, reissue, kind points, kind flag and title flag of every release."""
    secondary = F.when(F.col("secondary_type") != "", F.array("secondary_type")).otherwise(F.array().cast("array<string>"))
    return view(spark, sf_dir, "track_release").select(
        "rec_id", "release_id",
        dates.year_of(F.col("date")).alias("year"),
        dates.is_reissue(F.col("date"), F.col("first_date")).alias("reissue"),
        dates.release_group_points(F.col("primary_type"), secondary).alias("points"),
        dates.is_compilation_or_live(F.col("primary_type"), secondary).alias("comp_or_live"),
        dates.looks_like_compilation(F.col("title")).alias("comp_title"),
        dates.days_before_2100(F.col("date")).alias("days"),
    )


RELEASE_FACTS_SQL = rf"""
SELECT rec_id, release_id, {s_year('date')} AS year, coalesce({s_year('date')} > {s_year('first_date')} + 1, FALSE) AS reissue,
  CAST({s_points('primary_type', 'secondary_type')} AS INTEGER) AS points, secondary_type IN ('Compilation', 'Live') AS comp_or_live,
  regexp_matches(title, '(?i)\b(?:vol\.?|volume|hits|greatest\s+hits|best\s+of|essential|anthology|collection|classics)\b') AS comp_title, {s_days('date')} AS days
FROM track_release"""

QUERIES: dict[str, Query] = {name: _value_query(name) for name in (
    "unsmart_quotes fold_chars normalize_text normalize_nospace strip_track_prefix conservative_variations clean_title clean_title_custom drop_artist_prefix featured_title "
    "featured_artists id_clean id_list_clean id_array_clean sanitize_query title_match_key norm_no_article version_base valid_uuid is_ascii lucene_artist_query "
    "lucene_recording_query track_year comma_parts"
).split()}
QUERIES |= {"dup_parens": dup_parens, "document_plain": document_plain, "artist_variations": artist_variations, "split_artists": split_artists, "release_facts": release_facts}


def sql() -> dict[str, str]:
    found = {name: with_views(f"SELECT track_id, {expression} AS value FROM track", "track") for name, (_, expression) in _values().items()}
    collapsed = "replace(replace(raw || ' [Mix] (mix)', '(Edit) (EDIT)', '(Edit)'), '[Mix] (mix)', '(Mix)')"
    found["dup_parens"] = with_views(f"SELECT track_id, {s_strip(collapsed)} AS value FROM track", "track")
    found["document_plain"] = f"SELECT doc_id, md5({s_norm('text')}) AS digest FROM documents"
    found["artist_variations"] = with_views(variations_sql(), "track")
    found["split_artists"] = with_views(_split_sql(), "track")
    found["release_facts"] = with_views(RELEASE_FACTS_SQL, "track_release")
    return found
