"""Search strings in the index's query language."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackforge.functions.text import sanitize_query


def _any_of(ids: Column, always_bracket: bool) -> Column:
    terms = F.transform(ids, lambda x: F.concat(F.lit("arid:"), sanitize_query(x)))
    bracketed = F.concat(F.lit("("), F.array_join(terms, " OR "), F.lit(")"))
    return bracketed if always_bracket else F.when(F.size(ids) == 1, F.element_at(terms, 1)).otherwise(bracketed)


def recording_query(
    title: Column,
    artist_name: Column | None = None,
    artist_ids: Column | None = None,
    artist_id_groups: Column | None = None,
    album: Column | None = None,
    strict: Column | None = None,
    year: Column | None = None,
) -> Column:
    """All conditions joined by AND; groups of ids beat ids, ids beat the name."""
    absent, no_list = F.lit(None).cast("string"), F.array().cast("array<string>")
    groups = F.coalesce(artist_id_groups, F.array().cast("array<array<string>>")) if artist_id_groups is not None else F.array().cast("array<array<string>>")
    ids = F.coalesce(artist_ids, no_list) if artist_ids is not None else no_list
    name = artist_name if artist_name is not None else absent
    used = F.filter(groups, lambda g: F.size(g) > 0)
    by_group = F.array_join(F.transform(used, lambda g: _any_of(g, False)), " AND ")
    named = lambda field, c: F.when(c != "", F.concat(F.lit(f'{field}:"'), sanitize_query(c), F.lit('"')))
    who = F.when(F.size(groups) > 0, F.when(by_group != "", by_group)).when(F.size(ids) > 0, _any_of(ids, True)).otherwise(named("artist", name))
    only = F.when(strict, F.lit("-(secondarytype:Compilation OR secondarytype:Live) AND status:Official")) if strict is not None else absent
    when = F.when(year != 0, F.concat(F.lit("firstreleasedate:["), (year - 1).cast("string"), F.lit(" TO "), (year + 1).cast("string"), F.lit("]"))) if year is not None else absent
    head = F.concat(F.lit('recording:"'), sanitize_query(title), F.lit('"'))
    return F.concat_ws(" AND ", head, who, named("release", album) if album is not None else absent, only, when)


def artist_query(name: Column) -> Column:
    safe = sanitize_query(name)
    quoted = [F.concat(F.lit(f'{field}:"'), safe, F.lit('"')) for field in ("artist", "alias", "sortname")]
    return F.concat(F.lit("("), F.concat_ws(" OR ", *quoted), F.lit(")"))
