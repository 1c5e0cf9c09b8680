"""Resolving strings that name several artists.

A string is split into parts, a part into halves, and these again, to a depth
that is a parameter.  How a string splits does not depend on what is known of its
parts, so all parts are made first, by projections without a shuffle; then one
join looks up all of them, and per string a part counts if no part around it is
found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.functions.splitting import split_artists
from trackforge.functions.text import strip
from trackforge.operators.artists import lookup_artists
from trackforge.operators.common import materialized

MAX_DEPTH = 3


def first_parts(asked: DataFrame) -> DataFrame:
    """ask_id, path, name of the parts of each asked (ask_id, artist) that splits; a path is the place on each level."""
    halves = materialized(asked.select("ask_id", split_artists(F.col("artist")).alias("halves"))).filter(F.size("halves") > 1)
    return halves.select("ask_id", F.posexplode("halves").alias("i", "name")).select("ask_id", F.array("i").alias("path"), "name")


def all_parts(parts: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """ask_id, path, name, splits of the parts and of all that they split into; ``splits`` is false on the last level."""
    level, out = parts.select("ask_id", "path", strip(F.col("name")).alias("name")), None
    for depth in range(max_depth):
        halves = materialized(level.withColumn("halves", split_artists(F.col("name"))))
        splits = F.coalesce(F.size("halves") > 1, F.lit(False)) & F.lit(depth + 1 < max_depth)
        nodes = halves.select("ask_id", "path", "name", splits.alias("splits"))
        out = nodes if out is None else out.unionByName(nodes)
        level = halves.filter(splits).select("ask_id", "path", F.posexplode("halves").alias("i", "half")).select("ask_id", F.concat("path", F.array("i")).alias("path"), strip(F.col("half")).alias("name"))
    return level.select("ask_id", "path", "name", F.lit(False).alias("splits")).limit(0) if out is None else out


def _settled(known: DataFrame, *more: str) -> DataFrame:
    """ask_id, found, lost of all parts with artist_id (null: not found): the parts that count in the order of their paths, and how many are found at no level.

    A string has at most 2 ** max_depth parts for each of its first ones.
    """
    part = F.struct("path", "name", "artist_id", *more, "splits")
    trees = known.groupBy("ask_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))

    def covered(x: Column) -> Column:
        around = lambda y: (F.size(y["path"]) < F.size(x["path"])) & (F.slice(x["path"], F.lit(1), F.size(y["path"])) == y["path"])
        return F.exists("parts", lambda y: y["artist_id"].isNotNull() & around(y))

    found = F.filter("parts", lambda x: x["artist_id"].isNotNull() & ~covered(x))
    lost = F.filter("parts", lambda x: x["artist_id"].isNull() & ~x["splits"] & ~covered(x))
    return trees.select("ask_id", found.alias("found"), F.size(lost).alias("lost"))


def hierarchical(parts: DataFrame, names: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """ask_id, path, name, artist_id where every part is found at some level (all or nothing); names: name, artist_id."""
    known = all_parts(parts, max_depth).join(names, "name", "left")
    whole = _settled(known).filter("lost = 0")
    return whole.select("ask_id", F.explode("found").alias("p")).select("ask_id", "p.path", "p.name", "p.artist_id")


def hierarchical_with_recordings(parts: DataFrame, songs: DataFrame, artists: DataFrame, recordings: DataFrame, credits: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """ask_id, path, name, artist_id, rec_ids of the parts that are found with a recording of the song; the others are left out."""
    nodes = materialized(all_parts(parts, max_depth).join(songs, "ask_id").withColumn("part", F.struct("ask_id", "path")))
    hits = lookup_artists(nodes.select(F.col("part").alias("ask_id"), "name", "song"), artists, recordings, credits, always_validate=True)
    known = nodes.join(hits.select(F.col("ask_id").alias("part"), "artist_id", "rec_ids"), "part", "left")
    found = _settled(known.select("ask_id", "path", "name", "artist_id", "rec_ids", "splits"), "rec_ids")
    return found.select("ask_id", F.explode("found").alias("p")).select("ask_id", "p.path", "p.name", "p.artist_id", "p.rec_ids")


def quorum(lookups: DataFrame, credits: DataFrame, artists: DataFrame) -> DataFrame:
    """ask_id, rec_id, artist_ids, artists, artist: the credits of the recording that most of the looked-up artists share."""
    sizes = lookups.groupBy("ask_id").agg(F.count("*").alias("n")).filter("n >= 2")
    order = Window.partitionBy("ask_id").orderBy("path")
    placed = lookups.withColumn("place", F.row_number().over(order)).select("ask_id", "place", F.posexplode("rec_ids").alias("i", "rec_id"))
    counted = placed.groupBy("ask_id", "rec_id").agg(F.count("*").alias("votes"), F.min(F.struct("place", "i")).alias("first"))
    enough = counted.join(sizes, "ask_id").filter(F.col("votes") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2)))
    best = enough.groupBy("ask_id").agg(F.min_by("rec_id", F.struct(-F.col("votes"), "first")).alias("rec_id"))
    who = best.join(credits, "rec_id").join(artists.select("artist_id", "name"), "artist_id")
    listed = who.groupBy("ask_id", "rec_id").agg(F.sort_array(F.collect_list(F.struct("pos", "artist_id", "name"))).alias("c"))
    names = F.transform("c", lambda x: x["name"])
    return listed.select("ask_id", "rec_id", F.transform("c", lambda x: x["artist_id"]).alias("artist_ids"), names.alias("artists"), F.array_join(names, ", ").alias("artist"))


def resolve_collaborations(asked: DataFrame, names: DataFrame, artists: DataFrame, recordings: DataFrame, credits: DataFrame) -> DataFrame:
    """ask_id, stage, artist_ids, artists, artist for each asked (ask_id, artist, song) that resolves.

    Stages: the whole string, all of its parts, the quorum of a shared recording,
    the main artist before "feat."; each sees only what the ones before left over.
    """
    asked = materialized(asked.filter(strip(F.col("artist")) != ""))
    one = lambda df, stage, name: df.select("ask_id", F.lit(stage).alias("stage"), F.array("artist_id").alias("artist_ids"), F.array(name).alias("artists"), "artist")
    whole = asked.join(names, asked["artist"] == names["name"])
    first = materialized(one(whole, 1, "artist"))
    left = asked.join(first.select("ask_id"), "ask_id", "left_anti")
    parts = first_parts(left)
    full = hierarchical(parts, names).groupBy("ask_id").agg(F.sort_array(F.collect_list(F.struct("path", "artist_id", "name"))).alias("p")).join(left, "ask_id")
    ids, known = F.array_distinct(F.transform("p", lambda x: x["artist_id"])), F.transform("p", lambda x: x["name"])
    second = materialized(full.select("ask_id", F.lit(2).alias("stage"), ids.alias("artist_ids"), known.alias("artists"), "artist"))
    left = left.join(second.select("ask_id"), "ask_id", "left_anti")
    with_song = left.filter("song <> ''")
    shared = hierarchical_with_recordings(parts.join(with_song.select("ask_id"), "ask_id", "left_semi"), with_song.select("ask_id", "song"), artists, recordings, credits)
    third = materialized(quorum(shared, credits, artists).select("ask_id", F.lit(3).alias("stage"), "artist_ids", "artists", "artist"))
    left = left.join(third.select("ask_id"), "ask_id", "left_anti")
    main = left.withColumn("main", strip(F.regexp_extract("artist", r"(?iU)^(.+?)\s+(?:feat\.?|ft\.?|featuring)\s+.+$", 1))).filter("main <> ''")
    fourth = one(main.join(names, main["main"] == names["name"]), 4, "main")
    return first.unionByName(second).unionByName(third).unionByName(fourth)
