"""Completing a recording from its releases, tags and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.functions.nested import genre_names
from trackforge.operators.ranking import best_under_hints


def first_tags(*levels: Column) -> Column:
    """The first list of tags that is not empty, else an empty list."""
    return F.coalesce(*(F.when(F.size(x) > 0, x) for x in levels), F.array().cast("array<string>"))


def label_of(releases: DataFrame, first: int = 100) -> DataFrame:
    """rec_id, label: of the first releases with a typed label, official ones before all others."""
    typed = (F.coalesce(F.col("label_type"), F.lit("")) != "") & (F.col("label") != "")
    official = releases.filter("status = 'Official'").select("rec_id", "release_id", "label", "label_type", F.lit(0).alias("round"))
    every = releases.select("rec_id", "release_id", "label", "label_type", F.lit(1).alias("round"))
    place = F.row_number().over(Window.partitionBy("rec_id", "round").orderBy("release_id"))
    seen = official.unionByName(every).withColumn("place", place).filter(F.col("place") <= first).filter(typed)
    return seen.groupBy("rec_id").agg(F.min_by("label", F.struct("round", "place")).alias("label"))


def enrich(recordings: DataFrame, hints: DataFrame, releases: DataFrame, credits: DataFrame, artists: DataFrame, genres: DataFrame, group_tags: DataFrame) -> DataFrame:
    """One completed row per recording: its best release under the hints (rec_id, wanted, year), credits, label, genres and tags.

    genres: rec_id, genres (arrays of name and count); group_tags: group_id, group_tags.
    """
    hinted = releases.join(hints, "rec_id").join(recordings.select("rec_id", F.col("title").alias("recording_title")), "rec_id")
    best = best_under_hints(hinted, F.col("wanted"), F.col("year"), F.col("recording_title")).select(
        "rec_id", F.col("title").alias("album"), "date", "release_id", "group_id", F.when(F.coalesce("label_type", F.lit("")) != "", F.col("label")).alias("label"), F.col("secondary_type").alias("kind")
    )
    named = credits.join(artists.select("artist_id", "name", "nation"), "artist_id")
    who = named.groupBy("rec_id").agg(F.sort_array(F.collect_list(F.struct("pos", "artist_id", "name", "joinphrase", "nation"))).alias("c"))
    who = who.select(
        "rec_id", F.array_join(F.transform("c", lambda x: F.concat(x["name"], x["joinphrase"])), "").alias("artist"), F.array_join(F.transform("c", lambda x: x["artist_id"].cast("string")), "|").alias("artist_ids"),
        F.transform(F.slice("c", 1, 1), lambda x: F.concat(F.lit("nation "), x["nation"].cast("string"))).alias("artist_tags"),
    )
    own = F.when(F.col("rec_id") % 2 == 0, F.array("tag"))
    of_release = F.when(F.col("kind") != "", F.array("kind"))
    return (
        recordings.join(best, "rec_id", "left").join(who, "rec_id", "left").join(genres, "rec_id", "left").join(group_tags, "group_id", "left")
        .select(
            "rec_id", "title", "artist", "album", "date", "label", "isrc", "artist_ids", "release_id", "group_id", F.array_join(genre_names(F.col("genres")), "|").alias("genres"),
            F.array_join(first_tags(own, of_release, F.col("group_tags"), F.col("artist_tags")), "|").alias("tags"),
        )
    )
