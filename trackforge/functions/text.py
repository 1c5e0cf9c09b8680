"""Text clean-up of titles and names as Column functions; all run inside the JVM.

Regular expressions carry (?U), so that white space, digits and word borders are
those of Unicode, and (?iU) where case does not matter.
"""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column, functions as F

# Phrases that name a version of a track rather than the track.
VERSION_PHRASES = (
    "12 inch version", "7 inch edit", "7 inch mix", "7 inch version", "album version", "album version edit", "clean", "dirty", "edit",
    "edited version", "explicit", "extended mix", "extended version", "live album version", "official music video", "official video",
    "original version", "offizielles video", "original mix", "radio edit", "radio version", "remaster", "remastered", "single edit", "single",
    "single mix", "single version", "the original version", "video version", "video version edit", "video edit", "visualizer",
)
# Letters that look like Latin ones, and what they stand for.
LOOKALIKES, LATIN = "ΛΔӨЯλδөя†", "AAORaaort"
# What may follow the name that a longer credit begins with.
NAME_HEADS = (
    r"^the (.*)", r"^(.*?)( & .*)$", r"^(.*?)( featuring .*)$", r"^(.*?)( ft\.? .*)$", r"^(.*?)( feat.* .*)$",
    r"^(.*?)( with .*)$", r"^(.*?)( vs\.? .*)$", r"^(.*?)( x .*)$", r"^(.*?)( presents .*)$",
)
TRAILING_CONJUNCTION = r"(?iU)\s+(?:and|&|or|with|feat\.?|ft\.?)\s*$"
VERSION_SUFFIX = r"(?U)^\s*(.*)\s+[\(\[].*[\)\]]$"
TRACK_NUMBER = r"(?U)^\d{1,4}[-.]\s*"
FEATURED = r"(?iU)[\(\[](?:ft\.?|feat\.?|featuring|with|w/)\s+([^\)\]]+)[\)\]]"
#: Beyond ASCII, letters of common scripts, quotes and dashes; none of these stands for several letters, and this class is quick to test.
UNCOMMON = r"[^\x00-\x7F\xC0-\u0131\u0370-\u0586\u2010-\u201F\u3041-\u3096\u4E00-\u9FFF\uAC00-\uD7A3]"
#: Texts that are plain but for their case.
SIMPLE = r"^[A-Za-z0-9]++(?: [A-Za-z0-9]++)*+\z"
TOO_SMALL = "TEXT IS TOO SMALL IGNORE"

_LONGEST_FIRST = "|".join(sorted(VERSION_PHRASES, key=len, reverse=True))
#: The end of the string binds to the last phrase of the second pattern only.
VERSION_PATTERNS = (rf"(?iU) \((?:{_LONGEST_FIRST})\)", rf"(?iU) - (?:{_LONGEST_FIRST}$)", rf"(?iU) \[(?:{_LONGEST_FIRST})\]")


def bound(c: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(c), use)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """Null for an empty string; works its argument out once."""
    return bound(c, lambda x: F.when(x != "", x))


def straight_quotes(c: Column) -> Column:
    return F.when(c.rlike("[‘’“”]"), F.translate(c, "‘’“”", "''\"\"")).otherwise(c)


def latin_lookalikes(c: Column) -> Column:
    return F.when(c.rlike(f"[{LOOKALIKES}]"), F.translate(c, LOOKALIKES, LATIN)).otherwise(c)


def _decomposed() -> dict[str, str]:
    """Characters and their compatibility decompositions without marks, where these differ; syllables of Hangul stay whole."""
    pairs = {}
    for code in [*range(0xA0, 0xAC00), *range(0xF900, 0x1F300), *range(0x2F800, 0x2FA20)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if unicodedata.category(x) != "Mn")
        if base and base != chr(code) and unicodedata.category(chr(code)) not in ("Cn", "Cs", "Co"):
            pairs[chr(code)] = base.lower()
    return pairs


@cache
def _accents() -> tuple[str, str]:
    """Characters whose decomposition is one character, and those characters."""
    pairs = {k: v for k, v in _decomposed().items() if len(v) == 1}
    return "".join(pairs), "".join(pairs.values())


@cache
def _ligatures() -> tuple[str, dict[str, str]]:
    """Characters whose decomposition is several, such as ligatures, fractions and units: a pattern for them, and what they stand for.

    What is a blank either way, such as an ellipsis, is left out.
    """
    blank = lambda x: all(unicodedata.category(y)[0] in "PZ" for y in x)
    pairs = {k: v for k, v in _decomposed().items() if len(v) > 1 and not (blank(k) and blank(v))}
    ranges: list[list[int]] = []
    for code in sorted(map(ord, pairs)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]", pairs


def _spelt_out(c: Column) -> Column:
    """Ligatures and the like as the letters that they stand for; the text is cut around them, and all else is only looked at."""
    pattern, pairs = _ligatures()
    known = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in pairs.items())), F.lit("\x01"), F.lit("\x02"))
    parts = F.transform(F.split(c, f"(?={pattern})|(?<={pattern})"), lambda x: F.when((F.length(x) == 1) & x.rlike(pattern), F.try_element_at(known, x)).otherwise(x))
    return F.when(c.rlike(UNCOMMON) & c.rlike(pattern), F.array_join(parts, "")).otherwise(c)


def _bare(lower: Column) -> Column:
    bare = F.when(lower.rlike(r"[^\x00-\x7F]"), F.translate(_spelt_out(lower), *_accents())).otherwise(lower)
    bare = F.regexp_replace(bare, r"[\p{Mn}\p{Me}\p{Lm}\p{Sc}\p{Sk}\p{No}]", "")
    return F.trim(F.regexp_replace(bare, r"[\p{P}\p{Z}\p{So}\p{Sm}\p{Cc}\p{Cf}\p{Mc}]+", " "))


def plain(c: Column) -> Column:
    """Lower case without accents, every run of punctuation, symbols and white space one space; null if nothing is left."""
    return F.nullif(_bare(F.lower(c)), F.lit(""))


def plain_once(c: Column) -> Column:
    """``plain`` inside a lambda, where Spark works each repetition of an expression out anew."""
    return filled(bound(F.lower(c), _bare))


def normalize_text(c: Column) -> Column:
    """The plain form, or the text itself where that is empty; words of ASCII letters and digits with one space between them only lose their case."""
    whole = lambda c: bound(bound(latin_lookalikes(c), straight_quotes), lambda x: filled(F.coalesce(plain_once(x), x)))
    return bound(c, lambda x: F.when(x.rlike(SIMPLE), F.lower(x)).otherwise(whole(x)))


def normalize(c: Column, sizecheck: int = 0, nospaces: bool = False) -> Column:
    text = F.coalesce(normalize_text(c), c)
    text = F.replace(text, F.lit(" "), F.lit("")) if nospaces else text
    text = F.when(F.length(c) < sizecheck, F.lit(TOO_SMALL)).otherwise(text) if sizecheck else text
    return F.when(c != "", text)


def norm_no_article(c: Column) -> Column:
    return F.coalesce(normalize(F.regexp_replace(c, r"(?iU)^(?:the|a|an)\s+", ""), nospaces=True), F.lit(""))


def strip_track_number(c: Column) -> Column:
    """The text without a leading track number, null if it has none or is nothing else."""
    return F.when(c.rlike(TRACK_NUMBER), filled(strip(F.regexp_replace(c, TRACK_NUMBER, ""))))


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def _name_forms(lower: Column) -> Column:
    """Spellings under which a lower-case name may be filed, likeliest first."""
    heads = [filled(strip(F.regexp_replace(F.regexp_extract(lower, f"(?i){p}", 1), TRAILING_CONJUNCTION, ""))) for p in NAME_HEADS]
    forms = lambda x: bound(plain_once(x), lambda p: F.array(x, latin_lookalikes(x), p, latin_lookalikes(p)))
    whole = F.flatten(F.transform(_present(F.array(lower, *heads)), forms))
    left, right = strip(F.substring_index(lower, "/", 1)), strip(F.substring_index(lower, "/", -1))
    two = (F.size(F.split(lower, "/")) == 2) & (F.length(left) >= 3) & (F.length(right) >= 3) & ~left.endswith(" w")
    sides = F.flatten(F.transform(F.array(left, right), lambda x: F.array(x, latin_lookalikes(x), plain_once(x))))
    return F.concat(whole, F.when(two, sides).otherwise(F.array().cast("array<string>")))


def artist_variations(name: Column) -> Column:
    """Distinct spellings of an artist's name in order of preference; empty for a blank name."""
    lower = filled(strip(F.regexp_replace(straight_quotes(F.lower(name)), r"(?U)\s+\.?\s*$", "")))
    spellings = bound(lower, lambda x: _present(F.array(x, strip_track_number(x))))
    return F.array_distinct(_present(F.flatten(F.transform(spellings, _name_forms))))


def conservative_variations(name: Column) -> Column:
    """The name, and the name without "the" and without a track number."""
    whole = filled(strip(name))
    bare = strip_track_number(whole)
    without = lambda x: F.when(F.lower(x).startswith("the "), filled(F.substr(x, F.lit(5))))
    return F.array_distinct(_present(F.array(whole, without(whole), bare, without(bare))))


def clean_title(title: Column, patterns: tuple[str, ...] = VERSION_PATTERNS) -> Column:
    """The title without what the patterns match; unchanged where nothing would be left, null if empty."""
    left = reduce(lambda c, p: F.regexp_replace(c, p, ""), patterns, title)
    return F.when(title != "", F.when(left == "", title).otherwise(left))


def collapse_repeated_brackets(title: Column) -> Column:
    """Adjacent brackets of equal content become one, however often they repeat and however deep such runs are nested.

    A pass that changes anything takes away a bracket, so as many passes as there are brackets come to an end.
    """
    run = r"(?iU)[\(\[]([^\)\]]+)[\)\]](?:\s*[\(\[]\1[\)\]])+"
    passes = F.sequence(F.lit(1), F.regexp_count(title, F.lit(r"[\(\[]")))
    collapsed = F.aggregate(passes, title, lambda c, _: F.regexp_replace(c, run, "($1)"))
    return F.when(title == "", title).otherwise(strip(F.when(title.rlike(run), collapsed).otherwise(title)))


def drop_artist_prefix(title: Column, artist: Column) -> Column:
    """The title without a leading "artist - "."""
    t, a = strip(title), strip(artist)
    rest = F.substr(t, F.length(a) + 1)
    dash = r"(?U)^\s*[-–—]\s*(.+)$"
    prefixed = (F.lower(F.substr(t, F.lit(1), F.length(a))) == F.lower(a)) & rest.rlike(dash)
    given = F.coalesce((title != "") & (artist != ""), F.lit(False))
    return F.when(~given, title).when((a == "") | (t == ""), t).when(prefixed, strip(F.regexp_extract(rest, dash, 1))).otherwise(t)


def featured_artists(title: Column) -> Column:
    """struct(title, artists): the title without its bracketed featuring clauses, and the artists of the first."""
    clause = strip(F.regexp_extract(title, FEATURED, 1))
    for pattern, to in ((r"(?iU)[;,]\s*(?:ft\.?|feat\.?|w/|with)\s+", ", "), (r"(?iU)\s+and\s+", ", "), (r"(?U)\s*[;&]\s*", ", "), (r"(?U)\s*\+\s*", ", ")):
        clause = F.regexp_replace(clause, pattern, to)
    names = F.filter(F.transform(F.split(clause, ","), strip), lambda x: x != "")
    left = F.regexp_replace(F.regexp_replace(strip(F.regexp_replace(title, FEATURED, "")), r"(?U)\s+", " "), r"(?U)\s*[,;]\s*$", "")
    has = F.coalesce(title.rlike(FEATURED), F.lit(False))
    none = F.array().cast("array<string>")
    return F.struct(F.when(has, left).otherwise(F.coalesce(title, F.lit(""))).alias("title"), F.when(has, names).otherwise(none).alias("artists"))


def clean_identifier(c: Column) -> Column:
    return filled(strip(F.replace(c, F.lit("\0"), F.lit(""))))


def clean_identifiers(c: Column) -> Column:
    """The identifiers of a delimited string; null if there are none."""
    return _some(_present(F.transform(F.split(c, r"(?U)[;,\s]+"), clean_identifier)))


def clean_identifier_array(c: Column) -> Column:
    """The identifiers of an array, whose elements are not split; null if there are none."""
    return _some(_present(F.transform(c, clean_identifier)))


def _some(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def sanitize_query(c: Column) -> Column:
    return F.coalesce(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit(""))


def title_key(c: Column) -> Column:
    """Titles that compare equal whatever their ampersands, featuring words and white space."""
    key = F.regexp_replace(strip(F.lower(c)), r"(?U)\s*&\s*", " and ")
    key = F.regexp_replace(key, r"(?iU)\b(?:feat(?:uring)?\.?|ft\.?)\b", "feat")
    return strip(F.regexp_replace(key, r"(?U)\s+", " "))


def version_base(title: Column) -> Column:
    """The title before its last bracketed suffix, null if it has none."""
    return F.when(title.rlike(VERSION_SUFFIX), F.regexp_extract(title, VERSION_SUFFIX, 1))


def valid_uuid(c: Column) -> Column:
    """Whether the text is a UUID, with or without dashes, braces and prefix."""
    bare = F.regexp_replace(F.regexp_replace(F.replace(F.replace(c, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit("")), r"^[{}]+|[{}]+$", ""), "-", "")
    return F.coalesce(bare.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))


def is_ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")
