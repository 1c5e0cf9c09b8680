"""What is read from nested documents: credits, tags, genres, labels, links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackforge.functions.text import filled


def _some(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def credit_ids(credits: Column) -> Column:
    """Artist ids in the order of the credits; entries without artist do not count."""
    return F.filter(F.transform(credits, lambda c: filled(c["artist"]["id"])), lambda x: x.isNotNull())


def credit_string(credits: Column) -> Column:
    """Credited names with their join phrases; null if there are none."""
    named = F.filter(credits, lambda c: c["artist"].isNotNull() & (F.coalesce(c["name"], F.lit("")) != ""))
    return filled(F.array_join(F.transform(named, lambda c: F.concat(c["name"], F.coalesce(c["joinphrase"], F.lit("")))), ""))


def tag_names(tags: Column) -> Column:
    return _some(F.filter(F.transform(tags, lambda t: t["name"]), lambda x: x.isNotNull()))


def genre_names(genres: Column) -> Column:
    """Names by falling count; equal counts stay in their order."""
    numbered = F.transform(genres, lambda g, i: F.struct((-F.coalesce(g["count"], F.lit(0))).alias("n"), i.alias("i"), g["name"].alias("name")))
    return _some(F.filter(F.transform(F.array_sort(numbered), lambda g: g["name"]), lambda x: x.isNotNull()))


def first_label(label_info: Column) -> Column:
    """The first label with both a type and a name."""
    typed = F.filter(label_info, lambda i: i["label"]["type"].isNotNull() & (F.coalesce(i["label"]["name"], F.lit("")) != ""))
    return F.try_element_at(typed, F.lit(1))["label"]["name"]


def link_map(relations: Column) -> Column:
    """Relation type to address; the first of a type counts."""
    links = F.filter(relations, lambda r: (r["target_type"] == "url") & (F.coalesce(r["type"], F.lit("")) != "") & (F.coalesce(r["url"]["resource"], F.lit("")) != ""))
    kinds = F.transform(links, lambda r: r["type"])
    first = F.filter(links, lambda r, i: F.array_position(kinds, r["type"]) == i + 1)
    return F.map_from_entries(F.transform(first, lambda r: F.struct(r["type"], r["url"]["resource"])))
