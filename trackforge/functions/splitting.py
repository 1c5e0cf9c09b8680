"""Splitting of strings that name several artists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackforge.functions.text import bound, strip

# Words between artists, most telling first; a word's place is its rank.
DELIMITERS = ("presents", "feat.", "featuring", "ft.", "ft", "feat", "vs.", "versus", "vs", "with", "w/", "x", "×", "&", "and")
#: Commas, semicolons and slashes rank with "versus".
MARK_RANK = 7
CONJUNCTION = r"(?iU)^(?:&|and)\s+"
_CUT = "struct<rank:int,at:int,least:int,left:string,right:string>"


def _cut(rank: int, least: int, left: Column, right: Column) -> Column:
    return F.struct(F.lit(rank).alias("rank"), F.length(left).alias("at"), F.lit(least).alias("least"), left.alias("left"), right.alias("right")).cast(_CUT)


def _by_word(s: Column, rank: int, word: str) -> Column:
    escaped = "".join(rf"\{c}" if c in ".&/" else c for c in word)
    guard = r"(?<![\d\s])" if word == "ft" else ""  # "MC 900 Ft" is a name
    sides = F.split(s, rf"(?iU){guard}\s+{escaped}\s+", 2)
    return bound(sides, lambda x: F.when(F.size(x) == 2, _cut(rank, 3, x[0], F.try_element_at(x, F.lit(2)))))


def _by_mark(s: Column, mark: str) -> Column:
    return bound(F.split(s, mark, 2), lambda x: F.when(F.size(x) == 2, _cut(MARK_RANK, 3, x[0], F.try_element_at(x, F.lit(2)))))


def _by_slash(s: Column) -> Column:
    """At the first slash that separates names: not the one of "w/", and not one inside a short name."""
    parts = F.split(s, "/")
    places = F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1))
    sides = F.transform(places, lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), "/").alias("l"), F.array_join(F.slice(parts, k + 1, F.size(parts)), "/").alias("r")))

    def separates(x: Column) -> Column:
        left, right = strip(x["l"]), strip(x["r"])
        with_ = F.regexp_replace(x["l"], r"(?U)\s+$", "").endswith(" w") | (F.lower(x["l"]) == "w")
        spaced = x["l"].endswith(" ") & x["r"].startswith(" ")
        return ~with_ & (spaced | left.contains(" ") | right.contains(" ") | ((F.length(left) >= 3) & (F.length(right) >= 3)))

    first = F.try_element_at(F.filter(sides, separates), F.lit(1))
    return bound(first, lambda x: F.when(x.isNotNull(), _cut(MARK_RANK, 2, x["l"], x["r"])))


def split_artists(s: Column) -> Column:
    """[left, right] at the most telling delimiter (the first of its rank), or [s] where that one does not separate names."""
    cuts = [_by_word(s, i, w) for i, w in enumerate(DELIMITERS)] + [_by_mark(s, ","), _by_mark(s, ";"), _by_slash(s)]
    best = F.array_min(F.filter(F.array(*cuts), lambda c: c.isNotNull()))

    def sides(b: Column) -> Column:
        by_mark = (b["rank"] == MARK_RANK) & (b["least"] == 3) & F.substr(s, b["at"] + 1, F.lit(1)).isin(",", ";")
        side = lambda x: F.when(by_mark, strip(F.regexp_replace(strip(x), CONJUNCTION, ""))).otherwise(strip(x))
        return F.struct(b["least"].alias("least"), side(b["left"]).alias("l"), side(b["right"]).alias("r"))

    def parts(x: Column) -> Column:
        fits = (F.length(x["l"]) >= x["least"]) & (F.length(x["r"]) >= x["least"])
        return F.when(F.coalesce(fits, F.lit(False)) & (strip(s) != ""), F.array(x["l"], x["r"])).otherwise(F.array(s))

    return bound(bound(best, sides), parts)


def comma_parts(s: Column) -> Column:
    """The parts of a comma-separated list, without leading conjunctions; null if there are fewer than two."""
    parts = F.transform(F.split(s, ","), lambda x: strip(F.regexp_replace(strip(x), CONJUNCTION, "")))
    parts = F.filter(parts, lambda x: x != "")
    return F.when(F.size(parts) >= 2, parts)
