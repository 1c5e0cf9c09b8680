"""Phrase search with graded scores over a positional inverted index.

A document (a recording, an artist, a release) has values in fields: titles,
names and aliases, albums.  Every word of a value's plain form and every pair of
adjacent words is a term, filed with its place.  A request is a set of
conditions, each a phrase in a field; all must hold, a phrase holds where its
words stand in a row in one value.  The rarest term of all conditions names the
candidates, at the places where that phrase would have to stand; what remains of
the conditions is checked value by value, and where nothing remains the value that
was met has the score.  So a request never meets more documents than its rarest
pair of words has places, and no document meets requests that share no term.

A word weighs as many binary digits as the number of values over the number of
those that hold it has.  A condition scores the share, from 0 to 100, of its best
value's weight that the phrase covers: 100 is the whole value.  A document's
score is the mean over the conditions, rounded down.  All in whole numbers.

Equal requests are worked out once.  Pages are cut per request before they are
joined with those who asked; totals are counted on the side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.functions.text import plain
from trackforge.operators.common import materialized
from trackforge.operators.lookup import PAGE, replaced_name


def _terms(words: Column) -> Column:
    """Words and pairs of adjacent words with the place of their first."""
    single = F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("term")))
    pairs = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.struct(i.alias("pos"), F.concat(words[i], F.lit(" "), w).alias("term")))
    return F.concat(single, pairs)


class PhraseIndex:
    """The index of values (key, field, text); fields and keys are plain columns, texts any."""

    def __init__(self, values: DataFrame) -> None:
        # equal texts are normalised once, and the plain form stands in one small plan
        values = materialized(values.select("key", "field", "text").distinct())  # a table behind them is read once
        forms = materialized(values.select("text").distinct().select("text", plain(F.col("text")).alias("value")))
        worded = values.join(forms.filter("value IS NOT NULL"), "text").select("key", "field", "value").distinct()
        worded = materialized(worded.withColumn("words", F.split("value", " ")))
        holders = worded.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        self.n_values = worded.count()
        self.weights = holders.select("word", F.length(F.bin(F.floor(F.lit(self.n_values) / F.col("n")).cast("long"))).alias("weight"))
        each = worded.select("key", "field", "value", F.explode("words").alias("word")).join(self.weights, "word")
        self.values = materialized(each.groupBy("key", "field", "value").agg(F.sum("weight").alias("whole")))
        placed = self.values.select("key", "field", "value", "whole", F.explode(_terms(F.split("value", " "))).alias("t"))
        self.postings = placed.select("key", "field", "value", "whole", "t.pos", "t.term")

    def search(self, asked: DataFrame, limit: int = PAGE, offset: int = 0) -> DataFrame:
        """ask_id, key, score, rank, total for each asked (ask_id, conditions: array of field and phrase); best scores first, then by key.

        Conditions whose phrase is null or empty do not count; one of marks alone finds nothing, nor do no conditions at all.
        """
        given = F.filter("conditions", lambda c: F.coalesce(c["phrase"], F.lit("")) != "")
        norm = F.array_sort(F.array_distinct(F.transform(given, lambda c: F.struct(c["field"].alias("field"), plain(c["phrase"]).alias("phrase")))))
        # written first: each later use of a plain form would repeat its whole expression in the plan
        wanted = materialized(asked.select("ask_id", norm.alias("conditions"))).filter((F.size("conditions") > 0) & F.forall("conditions", lambda c: c["phrase"].isNotNull()))
        wanted = wanted.withColumn("asked", F.to_json("conditions"))
        # numbered once they are written, so that a number and not their text goes through the joins
        requests = materialized(wanted.groupBy("asked").agg(F.any_value("conditions").alias("conditions")))
        requests = materialized(requests.withColumn("request", F.monotonically_increasing_id()))
        each = materialized(requests.select("request", F.size("conditions").alias("n"), F.posexplode("conditions").alias("no", "c")).select("request", "n", "no", "c.field", "c.phrase"))
        worded = each.withColumn("words", F.split("phrase", " "))
        terms = worded.select("request", "no", "field", "phrase", "words", F.explode(_terms(F.col("words"))).alias("t")).select("request", "no", "field", "phrase", "words", "t.pos", "t.term")
        terms = terms.filter((F.size("words") == 1) | F.col("term").contains(" "))  # pairs tell more than their words
        known = materialized(self.postings.join(terms.select("field", "term").distinct(), ["field", "term"], "left_semi"))
        counts = known.groupBy("field", "term").agg(F.count("*").alias("places"))
        rarity = terms.join(counts, ["field", "term"], "left").withColumn("places", F.coalesce("places", F.lit(0).cast("long")))
        anchor = rarity.groupBy("request").agg(F.min(F.struct("places", "no", "pos", "field", "term", "phrase")).alias("a")).filter("a.places > 0")
        anchor = anchor.select("request", "a.no", F.col("a.pos").alias("offset"), "a.field", "a.term", "a.phrase")
        weights = self.weights.withColumnRenamed("weight", "w")
        covered = worded.select("request", "no", F.explode("words").alias("word")).join(weights, "word").groupBy("request", "no").agg(F.sum("w").alias("covers"))
        listed = each.join(covered, ["request", "no"]).groupBy("request", "n").agg(F.collect_list(F.struct("no", "field", "phrase", "covers")).alias("all"))
        anchor = anchor.join(listed, "request").withColumns({
            "others": F.filter("all", lambda c: c["no"] != F.col("no")), "covers": F.filter("all", lambda c: c["no"] == F.col("no"))[0]["covers"]
        }).drop("all", "no")
        anchor = materialized(anchor)
        score = F.floor(F.lit(100) * F.col("covers") / F.col("whole")).cast("int")
        there = F.array_join(F.slice(F.split("value", " "), F.col("pos") - F.col("offset") + 1, F.size(F.split("phrase", " "))), " ") == F.col("phrase")

        def met(anchors: DataFrame) -> DataFrame:
            """The values in which an anchor's phrase stands, with its score there."""
            return anchors.join(known, ["field", "term"]).filter(F.col("pos") >= F.col("offset")).filter(there).withColumn("first", score)

        single = met(anchor.filter("n = 1")).groupBy("request", "key").agg(F.max("first").alias("score"))
        checks = met(anchor.filter("n > 1")).select("request", "n", "key", "first", F.explode("others").alias("c")).select("request", "n", "key", "first", "c.*").join(self.values, ["key", "field"])
        holds = F.contains(F.concat(F.lit(" "), "value", F.lit(" ")), F.concat(F.lit(" "), "phrase", F.lit(" ")))
        rest = checks.filter(holds).groupBy("request", "n", "key", "no").agg(F.max("first").alias("first"), F.max(score).alias("score"))
        several = rest.groupBy("request", "n", "key").agg(F.count("*").alias("met"), (F.sum("score") + F.max("first")).alias("score")).filter("met = n - 1")
        found = single.unionByName(several.select("request", "key", F.floor(F.col("score") / F.col("n")).cast("int").alias("score")))
        found = materialized(found)
        totals = found.groupBy("request").agg(F.count("*").alias("total"))
        rank = F.row_number().over(Window.partitionBy("request").orderBy(F.desc("score"), "key"))
        page = found.withColumn("rank", rank).filter(F.col("rank") <= offset + limit).filter(F.col("rank") > offset)
        pages = page.join(totals, "request").join(requests.select("request", "asked"), "request").drop("request")
        return wanted.select("ask_id", "asked").join(pages, "asked").drop("asked")


def condition(field: str, phrase: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), phrase.alias("phrase"))


def artist_phrases(artists: DataFrame) -> PhraseIndex:
    """Artists by name and alias."""
    text = F.explode(F.array("name", "alias")).alias("text")
    return PhraseIndex(artists.select(F.col("artist_id").alias("key"), F.lit("name").alias("field"), text))


def recording_phrases(recordings: DataFrame, releases: DataFrame, credits: DataFrame, artists: DataFrame) -> PhraseIndex:
    """Recordings by title, by the names and aliases of those credited, and by the titles of their releases."""
    names = credits.join(artists.select("artist_id", F.explode(F.array("name", "alias")).alias("text")), "artist_id")
    values = recordings.select(F.col("rec_id").alias("key"), F.lit("title").alias("field"), F.col("title").alias("text"))
    values = values.unionByName(names.select(F.col("rec_id").alias("key"), F.lit("artist").alias("field"), "text"))
    return PhraseIndex(values.unionByName(releases.select(F.col("rec_id").alias("key"), F.lit("album").alias("field"), F.col("title").alias("text"))))


def search_artists(asked: DataFrame, index: PhraseIndex, limit: int = PAGE, offset: int = 0) -> DataFrame:
    """ask_id, artist_id, score, rank, total for each asked (ask_id, name)."""
    wanted = asked.select("ask_id", F.array(condition("name", replaced_name(F.col("name")))).alias("conditions"))
    return index.search(wanted, limit, offset).withColumnRenamed("key", "artist_id")


def search_recordings(asked: DataFrame, index: PhraseIndex, limit: int = PAGE, offset: int = 0) -> DataFrame:
    """ask_id, rec_id, score, rank, total for each asked row with a title (ask_id, title, artist, album)."""
    wanted = asked.filter("title <> ''").select("ask_id", F.array(condition("title", F.col("title")), condition("artist", F.col("artist")), condition("album", F.col("album"))).alias("conditions"))
    return index.search(wanted, limit, offset).withColumnRenamed("key", "rec_id")
