"""Searches and look-ups in the catalog, as joins of what is asked with keyed tables.

The search index answers by equal keys: a title is filed under its plain form
and that of its base without version suffix, an artist under the plain forms of
name and alias, with and without an article.  This replaces the relevance
ranking of a remote index by a rule that any engine can repeat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.functions.dates import lead_year
from trackforge.functions.text import clean_title, plain, valid_uuid, version_base
from trackforge.operators.common import materialized

# Names that are filed under another.
REPLACED_NAMES = {'lil b "the based god"': "Lil B", 'lil b "the basedgod"': "Lil B"}
PAGE, SEARCH_CAP, BROWSE_CAP = 100, 500, 1000
SCORE_FLOOR, AMBIGUOUS_ABOVE = 70, 150


def replaced_name(name: Column) -> Column:
    out = name
    for old, new in REPLACED_NAMES.items():
        out = F.when(F.lower(name) == old, F.lit(new)).otherwise(out)
    return out


def title_index(recordings: DataFrame, *more: Column) -> DataFrame:
    """rec_id, title_key and ``more``: every key under which a recording's title is filed."""
    forms = F.array(plain(F.col("title")), plain(version_base(F.col("title"))), plain(clean_title(F.col("title"))))
    return recordings.select("rec_id", F.explode(F.array_distinct(F.filter(forms, lambda x: x.isNotNull()))).alias("title_key"), *more)


def artist_index(artists: DataFrame) -> DataFrame:
    """artist_id, artist_key, score: 100 for the name or alias itself, 80 without its article."""
    bare = lambda c: F.regexp_replace(plain(c), "^(?:the|a|an) ", "")
    entry = lambda k, s: F.struct(k.alias("k"), F.lit(s).alias("s"))
    names = (F.col("name"), F.col("alias"))
    entries = F.array(*(entry(plain(n), 100) for n in names), *(entry(bare(n), 80) for n in names))
    return artists.select("artist_id", F.explode(entries).alias("e")).filter("e.k IS NOT NULL").groupBy("artist_id", F.col("e.k").alias("artist_key")).agg(F.max("e.s").alias("score"))


def search_artists(asked: DataFrame, artists: DataFrame, limit: int = PAGE) -> DataFrame:
    """ask_id, artist_id, score, rank for each asked (ask_id, name)."""
    hits = asked.select("ask_id", plain(replaced_name(F.col("name"))).alias("artist_key")).join(artist_index(artists), "artist_key")
    rank = F.row_number().over(Window.partitionBy("ask_id").orderBy(F.desc("score"), "artist_id"))
    return hits.select("ask_id", "artist_id", "score", rank.alias("rank")).filter(F.col("rank") <= limit)


def _with(asked: DataFrame, **missing: str) -> DataFrame:
    """The asked rows with those columns that they lack, null."""
    return asked.withColumns({n: F.lit(None).cast(t) for n, t in missing.items() if n not in asked.columns})


def search_recordings(asked: DataFrame, recordings: DataFrame, credits: DataFrame, artists: DataFrame, limit: int = PAGE, offset: int = 0, releases: DataFrame | None = None) -> DataFrame:
    """ask_id, rec_id, rank, total for each asked row that has a title; exact titles first, then by id.

    Asked: ask_id, title and any of artist, artist_ids, artist_id_groups (one of
    each group must be credited), album, strict and year.  Groups beat ids, ids
    beat the name; what is given must all hold.  Strict: some release is
    official, none a compilation or live; year: first out within a year of it.
    album and strict need the releases.  Where a title is all that is asked for,
    requests meet only the page of its key, however many recordings it has, and
    titles under equal conditions are worked out once.
    """
    named_only = not {"artist_ids", "artist_id_groups"} & set(asked.columns)
    conditions = [c for c in ("album", "strict", "year") if c in asked.columns]
    if {"album", "strict"} & set(conditions) and releases is None:
        raise ValueError("album and strict need the releases")
    wanted = _with(asked, artist="string", artist_ids="array<bigint>", artist_id_groups="array<array<bigint>>").filter("title <> ''").withColumns(
        {"title_key": plain(F.col("title")), "artist_key": plain(F.col("artist")), "groups": F.filter("artist_id_groups", lambda g: F.size(g) > 0)}
    )
    mode = F.when(F.size("artist_id_groups") > 0, F.when(F.size("groups") > 0, "groups").otherwise("title")).when(F.size("artist_ids") > 0, "ids").when(F.col("artist") != "", "name").otherwise("title")
    wanted = wanted.withColumn("mode", mode)
    born = lead_year(F.col("first_date")) if "year" in conditions else F.lit(None).cast("int")
    titles = title_index(recordings, plain(F.col("title")).alias("own_key"), born.alias("born")).withColumn("exact", F.coalesce(F.col("own_key") == F.col("title_key"), F.lit(False))).drop("own_key")
    titles, wanted = materialized(titles), materialized(wanted)
    hit = ("ask_id", "rec_id", "exact", "born")
    best = (F.desc("exact"), F.asc("rec_id"))
    by_artist = credits.select("rec_id", "artist_id").join(artist_index(artists), "artist_id").select("rec_id", "artist_key").distinct()
    hits = wanted.filter("mode = 'name'").join(titles.join(by_artist, "rec_id"), ["title_key", "artist_key"]).select(*hit)
    if not named_only:
        by_id = titles.join(credits.select("rec_id", "artist_id").distinct(), "rec_id")
        ids = wanted.filter("mode = 'ids'").select("ask_id", "title_key", F.explode(F.array_distinct("artist_ids")).alias("artist_id"))
        hits = hits.unionByName(ids.join(by_id, ["title_key", "artist_id"]).select(*hit).distinct())
        groups = wanted.filter("mode = 'groups'").select("ask_id", "title_key", F.size("groups").alias("n"), F.posexplode("groups").alias("g", "ids"))
        met = groups.select("ask_id", "title_key", "n", "g", F.explode("ids").alias("artist_id")).join(by_id, ["title_key", "artist_id"]).groupBy(*hit, "n").agg(F.count_distinct("g").alias("met"))
        hits = hits.unionByName(met.filter("met = n").select(*hit))
    by_title = wanted.filter("mode = 'title'")
    if conditions:
        hits = _held(hits.join(asked.select("ask_id", *conditions), "ask_id"), releases, conditions)
        free = reduce(Column.__and__, [~_asks(c) for c in conditions])
        narrowed, by_title = by_title.filter(~free), by_title.filter(free)
    each = Window.partitionBy("ask_id")
    found = hits.select("ask_id", "rec_id", F.row_number().over(each.orderBy(*best)).alias("rank"), F.count("*").over(each).alias("total"))
    found = found.filter((F.col("rank") > offset) & (F.col("rank") <= offset + limit))

    def paged(under: DataFrame, key: str) -> DataFrame:
        """The page and the count of every key, whoever asks."""
        page = under.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*best))).filter(F.col("rank") <= offset + limit).filter(F.col("rank") > offset)
        return page.join(under.groupBy(key).agg(F.count("*").alias("total")), key).select(key, "rec_id", "rank", "total")

    found = found.unionByName(by_title.select("ask_id", "title_key").join(paged(titles, "title_key"), "title_key").drop("title_key"))
    if conditions:
        narrowed = narrowed.select("ask_id", F.to_json(F.struct("title_key", *(F.when(_asks(c), F.col(c)).alias(c) for c in conditions))).alias("request"), "title_key", *conditions)
        requests = narrowed.groupBy("request", "title_key").agg(*(F.any_value(c).alias(c) for c in conditions))
        hits = materialized(_narrowed(requests, titles, releases, conditions))
        found = found.unionByName(narrowed.select("ask_id", "request").join(paged(hits, "request"), "request").drop("request"))
    return found


def _asks(condition: str) -> Column:
    """Whether a row makes that condition: a value that is empty, false or 0 makes none."""
    none = {"album": F.lit(""), "strict": F.lit(False), "year": F.lit(0)}[condition]
    return F.coalesce(condition, none) != none


def _on_albums(releases: DataFrame) -> DataFrame:
    return releases.select("rec_id", plain(F.col("title")).alias("album_key")).distinct()


def _held(hits: DataFrame, releases: DataFrame | None, conditions: list[str]) -> DataFrame:
    """The hits (rec_id, born and the conditions) that hold under their conditions."""
    if "album" in conditions:
        keyed = hits.withColumn("album_key", plain(F.col("album")))
        hits = keyed.filter(~_asks("album")).unionByName(keyed.filter(_asks("album")).join(_on_albums(releases), ["rec_id", "album_key"], "left_semi")).drop("album_key")
    if "strict" in conditions:
        kinds = releases.groupBy("rec_id").agg(F.max(F.col("status") == "Official").alias("official"), F.max(F.col("secondary_type").isin("Compilation", "Live")).alias("other_kind"))
        hits = hits.join(kinds, "rec_id", "left").filter(~_asks("strict") | (F.coalesce("official", F.lit(False)) & ~F.coalesce("other_kind", F.lit(False)))).drop("official", "other_kind")
    if "year" in conditions:
        hits = hits.filter(~_asks("year") | F.coalesce(F.abs(F.col("born") - F.col("year")) <= 1, F.lit(False)))
    return hits


def _narrowed(requests: DataFrame, titles: DataFrame, releases: DataFrame | None, conditions: list[str]) -> DataFrame:
    """request, rec_id, exact for requests (title_key and conditions): album and year are part of the join key, so a frequent title alone joins nothing."""
    titles = titles.join(requests.select("title_key").distinct(), "title_key", "left_semi")
    left, hits = requests, []
    if "album" in conditions:
        albums = titles.join(_on_albums(releases), "rec_id")
        hits.append(left.filter(_asks("album")).withColumn("album_key", plain(F.col("album"))).join(albums, ["title_key", "album_key"]).drop("album_key"))
        left = left.filter(~_asks("album"))
    if "year" in conditions:
        years = F.explode(F.array(*(F.col("year") + k for k in (-1, 0, 1)))).alias("born")
        hits.append(left.filter(_asks("year")).select("*", years).join(titles, ["title_key", "born"]))
        left = left.filter(~_asks("year"))
    hits.append(left.join(titles, "title_key"))
    return _held(reduce(DataFrame.unionByName, hits), releases, conditions).select("request", "rec_id", "exact")


def get_by_id(asked: DataFrame, documents: DataFrame, key: str, fold: bool = True) -> DataFrame:
    """Asked rows (ask_id, uuid) with the document of that id, or null: invalid ids and unknown ones are not found."""
    wanted = F.lower(F.trim("uuid")) if fold else F.col("uuid")
    valid = asked.select("ask_id", F.when(valid_uuid(F.trim("uuid") if fold else F.col("uuid")), wanted).alias(key))
    return valid.join(documents.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def get_entity(asked: DataFrame, documents: DataFrame, includes: list[str] | None, sections: dict[str, tuple[str, ...]], default: tuple[str, ...] = (), fold: bool = False) -> DataFrame:
    """``get_by_id`` (key: id) with only the sections that are included: null means the default ones, an empty list none.

    Recordings and artists are found whatever the case of their ids, releases and release groups are not.
    """
    inside = {c for columns in sections.values() for c in columns}
    wanted = {c for name in (default if includes is None else includes) for c in sections[name]}
    return get_by_id(asked, documents.select(*(c for c in documents.columns if c not in inside or c in wanted)), "id", fold)


def _given(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) != ""


def _named(asked: DataFrame, artists: DataFrame | None) -> DataFrame:
    """Asked rows with an artist's name, once for each artist of that name; ids that are given beat names."""
    by_name = _given("artist") & F.col("artist_id").isNull()
    if artists is None:
        return asked.filter(~by_name)
    named = asked.filter(by_name).withColumn("artist_key", plain(replaced_name(F.col("artist")))).drop("artist_id").join(artist_index(artists).select("artist_key", "artist_id"), "artist_key")
    return asked.filter(~by_name).unionByName(named.select(*asked.columns))


def _first_of(entities: DataFrame, by: list[str], key: str, n: int) -> DataFrame:
    return entities.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(key))).filter(F.col("place") <= n).drop("place")


def _once(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Asked rows (ask_id and conditions, one or more rows each) as (ask_id, request) and (request, conditions): equal requests are worked out once."""
    conditions = [c for c in asked.columns if c != "ask_id"]
    listed = asked.groupBy("ask_id").agg(F.array_sort(F.collect_set(F.struct(*conditions))).alias("rows"))
    listed = materialized(listed.withColumn("request", F.to_json("rows")))
    return listed.select("ask_id", "request"), materialized(listed.groupBy("request").agg(F.any_value("rows").alias("rows")).select("request", F.inline("rows")))


def _page(asked: DataFrame, found: DataFrame, key: str, limit: int, offset: int) -> DataFrame:
    """ask_id, key, rank: the page of every request (found: request, key) for those who asked; a list gathers one page."""
    rank = F.row_number().over(Window.partitionBy("request").orderBy(key))
    ranked = found.select("request", key).distinct().withColumn("rank", rank).filter((F.col("rank") > offset) & (F.col("rank") <= offset + limit))
    pages = ranked.groupBy("request").agg(F.collect_list(F.struct(key, "rank")).alias("page"))
    return asked.join(pages, "request").select("ask_id", F.inline("page"))


def search_releases(asked: DataFrame, releases: DataFrame, limit: int = PAGE, offset: int = 0, artists: DataFrame | None = None) -> DataFrame:
    """ask_id, release_id, rank of releases that meet all given conditions, by id; none given, none found.

    Asked: ask_id and any of title, artist, artist_id, group_id, barcode.  The
    conditions that are given decide the join key.  Requests for a title or an
    artist alone meet only as many releases as they can return.  Equal requests
    are worked out once, and pages are joined with those who asked as lists.
    """
    asked = _named(_with(asked, title="string", artist="string", artist_id="bigint", group_id="bigint", barcode="string"), artists)
    askers, asked = _once(asked.select(
        "ask_id", plain(F.col("title")).alias("want_title"), _given("title").alias("titled"), F.col("artist_id").alias("want_by"), F.col("group_id").alias("want_group"), F.col("barcode").alias("want_code")
    ))
    r = _with(releases, group_id="bigint").select("release_id", plain(F.col("title")).alias("title_key"), F.col("artist_id").alias("by"), F.col("group_id").alias("group"), F.col("barcode").alias("code")).distinct()
    r = materialized(r)  # each kind of condition reads it
    coded, grouped, credited = _given("want_code"), F.col("want_group").isNotNull(), F.col("want_by").isNotNull()
    free = asked.filter(~coded & ~grouped)
    n = offset + limit
    hits = [
        asked.filter(coded).join(r, F.col("want_code") == F.col("code")),
        asked.filter(~coded & grouped & (F.col("titled") | credited)).join(r, F.col("want_group") == F.col("group")),
        asked.filter(~coded & grouped & ~F.col("titled") & ~credited).join(_first_of(r, ["group"], "release_id", n), F.col("want_group") == F.col("group")),
        free.filter(F.col("titled") & credited).join(r, (F.col("want_title") == F.col("title_key")) & (F.col("want_by") == F.col("by"))),
        free.filter(F.col("titled") & ~credited).join(_first_of(r, ["title_key"], "release_id", n), F.col("want_title") == F.col("title_key")),
        free.filter(~F.col("titled") & credited).join(_first_of(r, ["by"], "release_id", n), F.col("want_by") == F.col("by")),
    ]
    met = (~F.col("titled") | (F.col("want_title") == F.col("title_key"))) & (~credited | (F.col("want_by") == F.col("by"))) & (~grouped | (F.col("want_group") == F.col("group")))
    return _page(askers, reduce(DataFrame.unionByName, hits).filter(met), "release_id", limit, offset)


def search_release_groups(asked: DataFrame, groups: DataFrame, limit: int = PAGE, offset: int = 0, artists: DataFrame | None = None) -> DataFrame:
    """ask_id, group_id, rank of release groups (group_id, title, artist_id, kind) that meet all given conditions, by id.

    Asked: ask_id and any of title, artist, artist_id (which beats the name) and
    type; a type alone is not enough.
    """
    asked = _named(_with(asked, title="string", artist="string", artist_id="bigint", type="string"), artists)
    askers, asked = _once(asked.select("ask_id", plain(F.col("title")).alias("want_title"), _given("title").alias("titled"), F.col("artist_id").alias("want_by"), F.when(_given("type"), F.lower("type")).alias("want_kind")))
    g = materialized(groups.select("group_id", plain(F.col("title")).alias("title_key"), F.col("artist_id").alias("by"), F.lower("kind").alias("kind_key")).distinct())
    credited, n = F.col("want_by").isNotNull(), offset + limit
    hits = [
        asked.filter(F.col("titled") & credited).join(g, (F.col("want_title") == F.col("title_key")) & (F.col("want_by") == F.col("by"))),
        asked.filter(F.col("titled") & ~credited).join(_first_of(g, ["title_key", "kind_key"], "group_id", n), F.col("want_title") == F.col("title_key")),
        asked.filter(~F.col("titled") & credited).join(_first_of(g, ["by", "kind_key"], "group_id", n), F.col("want_by") == F.col("by")),
    ]
    met = F.col("want_kind").isNull() | (F.col("want_kind") == F.col("kind_key"))
    return _page(askers, reduce(DataFrame.unionByName, hits).filter(met), "group_id", limit, offset)


def browse_releases(asked: DataFrame, releases: DataFrame, cap: int = BROWSE_CAP) -> DataFrame:
    """ask_id, release_id, pos, total for each asked (ask_id, rec_id, statuses); null statuses: all."""
    each = Window.partitionBy("ask_id")
    hits = asked.filter("rec_id IS NOT NULL").join(releases, "rec_id").filter(F.col("statuses").isNull() | F.array_contains("statuses", F.col("status")))
    found = hits.select("ask_id", "release_id", F.row_number().over(each.orderBy("release_id")).alias("pos"), F.count("*").over(each).alias("total"))
    return found.filter(F.col("pos") <= cap)


def image_lists(asked: DataFrame, images: DataFrame) -> DataFrame:
    """id, images of each asked id: structs of all columns of its images (id, image_id, ...) in the order of image_id.

    An id without images, or that is null or unknown, has an empty list.  A list
    gathers the images of one id, of which there are as many as a cover has pages.
    """
    rest = sorted(set(images.columns) - {"id", "image_id"})
    item = F.struct("image_id", *rest)
    listed = images.filter("id IS NOT NULL").groupBy("id").agg(F.sort_array(F.collect_list(item)).alias("images"))
    none = F.array().cast(listed.schema["images"].dataType)
    return asked.join(listed, "id", "left").withColumn("images", F.coalesce("images", none))


def front_image(images: Column) -> Column:
    """The first approved image of a list that is marked as the front; null if there is none."""
    return F.try_element_at(F.filter(images, lambda x: x["front"] & x["approved"]), F.lit(1))
