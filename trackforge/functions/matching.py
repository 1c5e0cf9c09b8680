"""Whether names, credits and markers match."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackforge.functions.text import norm_no_article, normalize, plain

# Words that mark a version which is not the studio recording.
VARIANT_MARKERS = ("live", "remix", "instrumental", "karaoke", "acoustic", "acapella", "a cappella", "demo", "cover", "reprise")
_MARKER = r"(?iU)\b(?:" + "|".join(VARIANT_MARKERS) + r")\b"


def name_matches(name: Column, aliases: Column, search: Column, variation: Column) -> Column:
    """Whether the plain name, or a plain alias, is one of two plain search forms."""
    known = F.coalesce(plain(name).isin(search, variation), F.lit(False))
    return known | F.exists(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: F.coalesce(plain(a).isin(search, variation), F.lit(False)))


def credits_match(artist: Column, names: Column, first_join: Column) -> Column:
    """Whether a recording's credited names (in order) fit an artist string.

    One name must be equal but for its article; several must all occur in the
    string, or the first must be equal and the rest only featured.
    """
    wanted = F.coalesce(normalize(artist, nospaces=True), F.lit(""))
    spelled = F.transform(names, lambda n: F.coalesce(normalize(n, nospaces=True), F.lit("")))
    first = norm_no_article(F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("")))
    equal = (first != "") & (first == norm_no_article(F.coalesce(artist, F.lit(""))))
    within = F.forall(spelled, lambda n: (n != "") & wanted.contains(n))
    featured = F.coalesce(first_join, F.lit("")).rlike(r"(?iU)\bfeat(?:uring)?\.?\b")
    several = within | (equal & featured)
    no_credit = names.isNull() | (F.size(names) < 1)
    various = F.exists(names, lambda n: F.coalesce(n, F.lit("")).contains("Various Artists"))
    return F.when(no_credit, False).when(various, False).when(wanted == "", True).when(F.size(names) == 1, equal).otherwise(several)


def markers(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(_MARKER), F.lit(0)), F.lower))


def has_marker(c: Column) -> Column:
    return F.coalesce(c.rlike(_MARKER), F.lit(False))


def shares_marker(title: Column, disambiguation: Column) -> Column:
    return F.coalesce(F.arrays_overlap(markers(title), markers(disambiguation)), F.lit(False))
