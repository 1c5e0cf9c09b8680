"""What is read from documents held as one VARIANT, where a missing key, a null and an empty value stay apart.

A struct turns all three into null.  Here a key that is present counts as
present even if its value is null, as it does for whoever looks keys up in a
parsed document: a tag whose name is null is a tag, a label whose type is null
has a type.  Nulls where a list, a text or a number is wanted count as none.
Values of the wrong kind (a text where a list should be) count as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trackforge.functions.text import filled


def _at(doc: Column, *keys: str) -> Column:
    """The value at a path of keys as a VARIANT: SQL null if a key is missing, a VARIANT null if the value is."""
    return F.try_variant_get(doc, "$" + "".join(f"['{k}']" for k in keys), "variant")


def has(doc: Column, *keys: str) -> Column:
    """Whether the key is present, with a null or not."""
    return _at(doc, *keys).isNotNull()


def text_at(doc: Column, *keys: str) -> Column:
    """The text at a path of keys; null if it is missing, null or no text."""
    value = _at(doc, *keys)
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def list_at(doc: Column, *keys: str) -> Column:
    """The list at a path of keys as an array of VARIANT; empty if it is missing, null or no list."""
    return F.coalesce(F.try_variant_get(_at(doc, *keys), "$", "array<variant>"), F.array().cast("array<variant>"))


def state_of(doc: Column, *keys: str) -> Column:
    """missing, null, empty (an empty text, list or object) or filled."""
    value = _at(doc, *keys)
    empty = (F.schema_of_variant(value) == "OBJECT<>") | (F.to_json(value).isin("[]", '""'))
    return F.when(value.isNull(), F.lit("missing")).when(F.is_variant_null(value), F.lit("null")).when(empty, F.lit("empty")).otherwise(F.lit("filled"))


def _some(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def _credits(doc: Column) -> Column:
    return F.filter(list_at(doc, "artist-credit"), lambda c: has(c, "artist"))


def credit_ids(doc: Column) -> Column:
    """Artist ids in the order of the credits; entries without the key ``artist`` do not count."""
    return F.filter(F.transform(_credits(doc), lambda c: filled(text_at(c, "artist", "id"))), lambda x: x.isNotNull())


def credit_string(doc: Column) -> Column:
    """Credited names with their join phrases, null if there are none; an entry whose artist is null still has its name."""
    named = F.transform(_credits(doc), lambda c: F.concat(filled(text_at(c, "name")), F.coalesce(text_at(c, "joinphrase"), F.lit(""))))
    return filled(F.array_join(named, ""))


def tag_names(doc: Column) -> Column:
    """Names of the tags that have the key ``name``, null names as nulls; null if there are none."""
    return _some(F.transform(F.filter(list_at(doc, "tags"), lambda t: has(t, "name")), lambda t: text_at(t, "name")))


def genre_names(doc: Column) -> Column:
    """Names by falling count, a missing or null count being 0; equal counts stay in their order."""
    count = lambda g: F.coalesce(F.try_variant_get(g, "$.count", "bigint"), F.lit(0).cast("bigint"))
    numbered = F.transform(list_at(doc, "genres"), lambda g, i: F.struct((-count(g)).alias("n"), i.alias("i"), has(g, "name").alias("has"), text_at(g, "name").alias("name")))
    return _some(F.transform(F.filter(F.array_sort(numbered), lambda g: g["has"]), lambda g: g["name"]))


def first_label(doc: Column) -> Column:
    """The name of the first label that has the key ``type`` and a name."""
    names = F.transform(list_at(doc, "label-info"), lambda i: F.when(has(i, "label", "type"), filled(text_at(i, "label", "name"))))
    return F.try_element_at(F.filter(names, lambda x: x.isNotNull()), F.lit(1))


def link_map(doc: Column) -> Column:
    """Relation type to address; the first of a type counts."""
    links = F.transform(
        F.filter(list_at(doc, "relations"), lambda r: text_at(r, "target-type") == "url"), lambda r: F.struct(filled(text_at(r, "type")).alias("type"), filled(text_at(r, "url", "resource")).alias("address"))
    )
    links = F.filter(links, lambda r: r["type"].isNotNull() & r["address"].isNotNull())
    kinds = F.transform(links, lambda r: r["type"])
    return F.map_from_entries(F.filter(links, lambda r, i: F.array_position(kinds, r["type"]) == i + 1))
