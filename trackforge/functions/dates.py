"""Years and partial dates (YYYY, YYYY-MM, YYYY-MM-DD), and what releases score by their kind."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

YEAR = r"(?U)\b(19|20)\d{2}\b"
# Points by primary type, deductions by secondary type.
PRIMARY_POINTS = {"Album": 25, "Single": 20, "EP": 20, "Broadcast": 10}
SECONDARY_DEDUCTIONS = {"Compilation": 15, "Live": 15, "Demo": 15, "Mixtape/Street": 15, "Remix": 10, "DJ-mix": 10}
REISSUE_AFTER_YEARS = 1


def year_of(c: Column) -> Column:
    """The first year from 1900 to 2099 in a text; where a date begins with it, no pattern is tried."""
    c = c.cast("string")
    lead, found = F.substring(c, 1, 4).try_cast("int"), F.regexp_extract(c, YEAR, 0)
    return F.when(lead.between(1900, 2099) & F.substring(c, 5, 1).isin("", "-"), lead).when(found != "", found.cast("int"))


def date_number(day: Column, parts: Column) -> Column:
    """The partial date of a day's first parts (1: year, 2: month, else all) as a number: 19970000, 19970300, 19970315.

    From year 0 to 9999 numbers have the order of the texts.
    """
    month = F.when(parts == 1, 0).otherwise(F.month(day))
    return F.year(day).cast("long") * 10000 + month * 100 + F.when(parts <= 2, 0).otherwise(F.dayofmonth(day))


def number_as_date(number: Column) -> Column:
    """The text of a ``date_number``."""
    digits = F.lpad(number.cast("string"), 8, "0")
    year, month, day = (F.substring(digits, i, n) for i, n in ((1, 4), (5, 2), (7, 2)))
    return F.when(number % 10000 == 0, year).when(number % 100 == 0, F.concat_ws("-", year, month)).when(number.isNotNull(), F.concat_ws("-", year, month, day))


def year_of_number(number: Column) -> Column:
    """``year_of`` the text of a ``date_number``."""
    year = F.floor(number / 10000).cast("int")
    return F.when(year.between(1900, 2099), year)


def track_year(originalyear: Column, year: Column, date: Column) -> Column:
    return F.coalesce(year_of(originalyear), year_of(year), year_of(date))


def is_reissue(date: Column, first_release_date: Column) -> Column:
    return F.coalesce(year_of(date) > year_of(first_release_date) + REISSUE_AFTER_YEARS, F.lit(False))


def lead_year(c: Column) -> Column:
    """The year that a partial date begins with, if it is from 1 to 2100."""
    year = F.split(c, "-")[0].try_cast("int")
    return F.when((year > 0) & (year <= 2100), year)


def days_before_2100(c: Column) -> Column:
    """Days from a partial date to 2100-01-01 (a missing month is July, a missing day the 15th); 0 if it is no date."""
    parts = F.split(c, "-")
    part = lambda i, missing, most: F.when(F.size(parts) > i, F.least(F.try_element_at(parts, F.lit(i + 1)).try_cast("int"), F.lit(most))).otherwise(missing)
    month, day = part(1, 7, 12), part(2, 15, 28)
    valid = lead_year(c).isNotNull() & (month >= 1) & (day >= 1)
    days = F.datediff(F.lit("2100-01-01").cast("date"), F.make_date(F.when(valid, lead_year(c)), F.when(valid, month), F.when(valid, day)))
    return F.coalesce(days, F.lit(0))


def _table(c: Column, points: dict[str, int]) -> Column:
    out = F.lit(0)
    for key, value in points.items():
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out


def _kind_points(primary: Column, off: Column) -> Column:
    return F.greatest(F.lit(0), F.coalesce(_table(primary, PRIMARY_POINTS), F.lit(0)) - off)


def release_group_points(primary: Column, secondary: Column) -> Column:
    return _kind_points(primary, F.aggregate(F.coalesce(secondary, F.array().cast("array<string>")), F.lit(0), lambda total, s: total + _table(s, SECONDARY_DEDUCTIONS)))


def single_kind_points(primary: Column, secondary: Column) -> Column:
    """``release_group_points`` of one secondary type at most, as text ('' or null: none)."""
    return _kind_points(primary, _table(secondary, SECONDARY_DEDUCTIONS))


def is_compilation_or_live(primary: Column, secondary: Column) -> Column:
    has = lambda x: F.coalesce(F.array_contains(secondary, x), F.lit(False))
    return F.coalesce(primary == "Compilation", F.lit(False)) | has("Compilation") | has("Live")


def looks_like_compilation(title: Column) -> Column:
    return F.coalesce(title.rlike(r"(?iU)\b(?:vol\.?|volume|hits|greatest\s+hits|best\s+of|essential|anthology|collection|classics)\b"), F.lit(False))
