"""Scoring and choosing releases and recordings.

A choice is "the greatest score, ties to the earlier": an aggregation that keeps
the row of the greatest key, so that a key with very many releases is settled
before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackforge.functions import dates
from trackforge.functions.matching import has_marker, shares_marker
from trackforge.functions.text import VERSION_SUFFIX, normalize, title_key

# What makes a package a physical album.
PHYSICAL = ("Cardboard/Paper Sleeve", "Jewel Case", "Digipak", "Box", "Keep Case")


def stepped(difference: Column, steps: dict[int, int]) -> Column:
    """Points by the first bound that a difference does not exceed; 0 beyond the last or if it is null."""
    out = F.lit(0)
    for bound, points in sorted(steps.items(), reverse=True):
        out = F.when(difference <= bound, F.lit(points)).otherwise(out)
    return F.coalesce(out, F.lit(0))


def _match(a: Column, b: Column, exact: int, partial: int) -> Column:
    given = (a != "") & (b != "")
    return F.coalesce(F.when(given & (a == b), exact).when(given & (a.contains(b) | b.contains(a)), partial), F.lit(0))


def secondary_types(c: Column) -> Column:
    return F.when(c != "", F.array(c)).otherwise(F.array().cast("array<string>"))


def best_under_hints(releases: DataFrame, album: Column, year: Column, recording_title: Column, key: str = "rec_id") -> DataFrame:
    """The best release of each key with score10, ten times its score under hints, as ``best_release`` would choose it.

    Releases: columns title, date, first_date, primary_type, secondary_type,
    packaging, pos, status and any that can be ordered.  Of the releases of one
    title those of a kind (albums or not, compilations or not) differ in points
    that need no look at texts, so the best of each kind is found first; what
    the title is worth is then worked out once per key and title.
    """
    secondary, born = secondary_types(F.col("secondary_type")), dates.year_of(F.col("date"))
    hinted = releases.withColumns({"_album": album, "_asked_year": year, "_recording": recording_title, "_year": born})
    points = (
        stepped(F.abs(F.col("_year") - F.col("_asked_year")), {0: 75, 1: 40, 5: 20})
        + dates.release_group_points(F.col("primary_type"), secondary)
        - F.when(F.coalesce(F.col("_year") > dates.year_of(F.col("first_date")) + dates.REISSUE_AFTER_YEARS, F.lit(False)), 10).otherwise(0)
        + F.when(F.col("packaging").isin(*PHYSICAL), 5).when(F.col("packaging") == "None", 1).otherwise(0)
    )
    unguided = (F.coalesce("_album", F.lit("")) == "") & (F.coalesce("_asked_year", F.lit(0)) == 0)
    points = (points * 10 + F.when(unguided, F.coalesce(2100 - F.col("_year"), F.lit(0))).otherwise(0)).cast("long")
    rest = [c for c in releases.columns if c not in (key, "title")]
    order = (F.coalesce(F.col("status") == "Official", F.lit(False)).alias("official"), points.alias("points"), (-F.col("pos").cast("long")).alias("before"))
    album_kind = F.coalesce(F.col("primary_type") == "Album", F.lit(False))
    compiled = F.coalesce(F.array_contains(secondary, "Compilation"), F.lit(True))  # a null type is no reason to take points off
    kinds = {f"_{a:d}{b:d}": (a, b) for a in (False, True) for b in (False, True)}
    # columns of their own, which stand in the plan once however often they are named
    hinted = hinted.withColumns({"_is_album": album_kind, "_is_compiled": compiled, "_ranked": F.struct(*order, F.struct(*rest).alias("rest"))})
    firsts = [F.max(F.when((F.col("_is_album") == a) & (F.col("_is_compiled") == b), F.col("_ranked"))).alias(n) for n, (a, b) in kinds.items()]
    titled = hinted.groupBy(key, "title", "_album", "_recording").agg(*firsts)
    titled = titled.withColumns({"_key": title_key(F.col("title")), "_wanted": title_key(F.col("_album"))})
    titled = titled.withColumns({
        "_match": _match(F.col("_key"), F.col("_wanted"), 100, 50), "_collected": dates.looks_like_compilation(F.col("title")),
        "_same": F.coalesce(normalize(F.col("_recording")) == normalize(F.col("title")), F.lit(False)),
    })

    def whole(name: str, is_album: bool, is_compiled: bool) -> Column:
        found = F.col(name)
        texts = F.col("_match") - (F.lit(0) if is_compiled else F.when(F.col("_collected"), 10).otherwise(0)) + (F.when(F.col("_same"), 20).otherwise(0) if is_album else F.lit(0))
        score = (found["points"] + texts * 10).cast("long")
        return F.when(found.isNotNull(), F.struct(found["official"].alias("official"), score.alias("score10"), found["before"].alias("before"), F.col("title"), found["rest"].alias("rest")))

    best = titled.groupBy(key).agg(F.max(F.greatest(*(whole(n, a, b) for n, (a, b) in kinds.items()))).alias("best"))
    return best.select(key, *(F.col("best.title") if c == "title" else F.col("best.rest")[c].alias(c) for c in releases.columns if c != key), F.col("best.score10").alias("score10"))


def best_release(releases: DataFrame, key: str = "rec_id") -> DataFrame:
    """The best release of each key, by columns score10, pos and status: among the official ones where there are any."""
    official = F.coalesce(F.col("status") == "Official", F.lit(False))
    rest = [c for c in releases.columns if c != key]
    best = releases.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(official, "score10", -F.col("pos").cast("long"))).alias("best"))
    return best.select(key, *(F.col("best")[c].alias(c) for c in rest))


def points_of_era(year: Column) -> Column:
    return F.coalesce(F.when(year < 2000, 15).when(year < 2010, 10).when(year < 2020, 5), F.lit(0))


def recording_points(title: Column, year: Column, n_isrcs: Column, n_credits: Column, length: Column, disambiguation: Column, first_date: Column) -> Column:
    """What a recording scores by itself, without its releases."""
    born = dates.lead_year(first_date)
    unasked = has_marker(disambiguation) & ~shares_marker(title, disambiguation)
    noted = F.coalesce(disambiguation, F.lit("")) != ""
    return (
        n_isrcs * 50
        + F.coalesce((2100 - born) * 10, F.lit(0))
        + stepped(F.abs(born - F.when(year != 0, year)), {0: 500, 1: 300, 2: 150, 5: 50})
        + F.when(F.coalesce(length, F.lit(0)) != 0, 5).otherwise(0)
        + n_credits * 5
        + F.when(noted, F.when(unasked, -50).otherwise(10)).otherwise(0)
    )


def years_seen(year: Column) -> list[Column]:
    """Which years from 1900 to 2099 a group holds, as bits: a set of them would be an object that every group writes, reads and sorts by."""
    place = year - 1900
    bit = lambda i: F.when((place >= 50 * i) & (place < 50 * i + 50), F.call_function("shiftleft", F.lit(1).cast("long"), place - 50 * i))
    return [F.bit_or(bit(i)).alias(f"years_{i}") for i in range(4)]


def year_seen(year: Column) -> Column:
    """Whether ``years_seen`` has a year."""
    place = year - 1900
    part = F.get(F.array(*(f"years_{i}" for i in range(4))), F.floor(place / 50).cast("int"))
    return F.coalesce(F.call_function("shiftright", part, F.pmod(place, F.lit(50))).bitwiseAND(1) == 1, F.lit(False))


def _release_facts(releases: DataFrame, name: str, released: Column) -> DataFrame:
    secondary = F.col("secondary_type")
    facts = releases.select("rec_id", name, "date", "various", "primary_type", "secondary_type", released.alias("released"))
    return facts.select(
        "rec_id", name, "date", "various", "released", (dates.single_kind_points(F.col("primary_type"), secondary) + points_of_era(F.col("released"))).alias("points"),
        (F.coalesce(F.col("primary_type") == "Compilation", F.lit(False)) | F.coalesce(secondary.isin("Compilation", "Live"), F.lit(False))).alias("other_kind"),
    )


def _added_up(facts: DataFrame, name: str) -> DataFrame:
    return facts.groupBy("rec_id", name).agg(
        F.count("*").alias("n_releases"), F.min("date").alias("date"), *years_seen(F.col("released")), F.sum("points").alias("points"),
        F.max(~F.col("various") & ~F.col("other_kind")).alias("plain"), F.max(~F.col("various")).alias("own"), F.max("various").alias("by_various"),
    )


def release_titles(releases: DataFrame) -> DataFrame:
    """What the releases of a recording under one title add up to: a row for each rec_id and title.

    date is the first, years_0 to years_3 are all years of theirs, plain and own tell whether
    one is not by various artists (plain: nor a compilation or live).  None of
    it depends on what is asked, and a title is normalised once, not per release.
    """
    titled = _added_up(_release_facts(releases, "title", dates.year_of(F.col("date"))), "title")
    return titled.withColumn("release_key", normalize(F.col("title")))


def numbered_release_titles(releases: DataFrame, names: DataFrame) -> DataFrame:
    """``release_titles`` of releases that have a title_no and a date as a number (``dates.date_number``); names: rec_id, title_no, title.

    A first date that is a text would make Spark sort all releases to add them up;
    numbers are hashed.  The few sums meet the texts, not the releases.
    """
    sums = _added_up(_release_facts(releases, "title_no", dates.year_of_number(F.col("date"))), "title_no")
    titled = sums.join(names, ["rec_id", "title_no"]).groupBy("rec_id", "title").agg(  # numbers may stand for one title
        F.sum("n_releases").alias("n_releases"), F.min("date").alias("date"), *(F.bit_or(f"years_{i}").alias(f"years_{i}") for i in range(4)),
        F.sum("points").alias("points"), *(F.max(c).alias(c) for c in ("plain", "own", "by_various")),
    )
    return titled.withColumn("date", dates.number_as_date(F.col("date"))).withColumn("release_key", normalize(F.col("title")))


def release_summary(pairs: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    """For each pair of keys (with album, year and rec_id): what its recording's releases (``release_titles``) add up to, and which kinds qualify.

    plain_ok and any_ok: a release qualifies without, or also with,
    compilations and live releases; various: one is by various artists.  The
    same with bare_ before it: as if no album had been asked for.
    """
    r = pairs.select(*keys, normalize(F.col("album")).alias("wanted"), F.when(F.col("year") != 0, F.col("year")).alias("when")).join(titles, "rec_id")
    within = lambda *apart: reduce(or_, (year_seen(F.col("when") + k) for d in apart for k in (-d, d)))
    nearest = F.when(within(0), 75).when(within(1), 40).when(within(2, 3, 4, 5), 20).otherwise(0)
    context = _match(F.col("release_key"), F.col("wanted"), 100, 50) + nearest
    on_album = F.col("wanted").isNull() | F.coalesce(F.col("wanted") == F.col("release_key"), F.lit(False))
    return r.groupBy(*keys).agg(
        (F.max(context) + F.sum("points")).alias("release_points"), F.max(on_album & F.col("plain")).alias("plain_ok"), F.max(on_album & F.col("own")).alias("any_ok"), F.max(on_album & F.col("by_various")).alias("various"),
        (F.max(nearest) + F.sum("points")).alias("bare_release_points"), F.max("plain").alias("bare_plain_ok"), F.max("own").alias("bare_any_ok"), F.max("by_various").alias("bare_various"),
    )


def select_recordings(candidates: DataFrame, key: list[str]) -> DataFrame:
    """key and rec_id of the chosen recording; keys without an acceptable one are absent.

    Candidates: one row per key and recording with asked (the title asked for),
    title, score, days, place (order of arrival), has_isrc, qualifies and
    various.  Exact titles come first, then score, age and place.  The first that
    qualifies wins, unless it has no ISRC and an exact one with ISRC that does
    not qualify stands before it; else that one, else the first by various artists.
    """
    return select_judged(candidates.withColumns(title_marks(F.col("asked"), F.col("title"))), key)


def title_marks(asked: Column, title: Column) -> dict[str, Column]:
    """exact: the titles are the same; versioned: the asked one names a version."""
    exact = F.coalesce(normalize(asked, nospaces=True) == normalize(title, nospaces=True), F.lit(False))
    return {"exact": exact, "versioned": F.coalesce(asked.rlike(VERSION_SUFFIX), F.lit(False))}


def select_judged(c: DataFrame, key: list[str]) -> DataFrame:
    """``select_recordings`` of candidates whose titles have been compared (``title_marks``)."""
    everyone = Window.partitionBy(*key)
    order = everyone.orderBy(F.desc("exact"), F.desc("score"), F.desc("days"), F.asc("place"))
    c = c.withColumn("rank", F.row_number().over(order)).withColumn("any_exact", F.max("exact").over(everyone))
    c = c.filter(F.col("any_exact") | ~F.col("versioned"))
    first = lambda which: F.min(F.when(which, F.struct("rank", "rec_id", "has_isrc")))
    held = F.col("exact") & F.col("has_isrc") & ~F.col("qualifies")
    found = c.groupBy(*key).agg(first(F.col("qualifies")).alias("w"), first(held).alias("f"), first(F.col("various")).alias("v"))
    before = F.coalesce((F.col("f.rank") < F.col("w.rank")) & ~F.col("w.has_isrc"), F.lit(False))
    chosen = F.when(F.col("w").isNotNull(), F.when(before, F.col("f.rec_id")).otherwise(F.col("w.rec_id"))).otherwise(F.coalesce("f.rec_id", "v.rec_id"))
    return found.select(*key, chosen.alias("rec_id")).filter("rec_id IS NOT NULL")


def resolve_isrcs(asked: DataFrame, recordings: DataFrame) -> DataFrame:
    """ask_id and the recording of its ISRCs (ask_id, ord, isrc) with the most releases, ties to the earlier ISRC."""
    index = recordings.select(F.upper(F.trim("isrc")).alias("code"), "rec_id", "n_releases")
    hits = asked.select("ask_id", "ord", F.upper(F.trim("isrc")).alias("code")).join(index, "code")
    return hits.groupBy("ask_id").agg(F.min_by("rec_id", F.struct(-F.col("n_releases"), "ord", "rec_id")).alias("rec_id"))
