"""Queries over documents held as one VARIANT and over lists of images, and SQL that knows what was put into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackforge.functions import variants
from trackforge.operators import lookup
from trackforge.plans.text_queries import Query
from trackforge.sources import documents
from trackforge.sources.catalog import view, with_views


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(c, r'(["\\])', r"\\$1"), F.lit('"'))


def _one_of(n: Column, *texts: str | Column) -> Column:
    """The text numbered n modulo their number."""
    cases = [F.lit(t) if isinstance(t, str) else t for t in texts]
    return F.element_at(F.array(*cases), (n % len(cases) + 1).cast("int"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec_id and a JSON document of each recording, in which keys are missing, null, empty or filled by turns."""
    credits, artists, recordings = (view(spark, sf_dir, n) for n in ("credit", "artist", "recording"))
    n, first = F.col("rec_id"), F.col("pos") == 0
    name = F.concat(F.lit('"name": '), _quoted(F.col("name")), F.lit(', "joinphrase": '), _quoted(F.col("joinphrase")), F.lit(", "))
    who = F.concat(F.lit('"artist": {"id": "'), F.col("artist_id").cast("string"), F.lit('"}'))
    odd_name = F.when(first, _one_of(n, name, F.lit(""), F.lit('"name": null, '), F.lit('"name": "", "joinphrase": " & ", '), name, name, name)).otherwise(name)
    odd_who = F.when(first, _one_of(n, who, who, who, who, F.lit('"x": 1'), F.lit('"artist": null'), F.lit('"artist": {}'))).otherwise(who)
    entry = F.concat(F.lit("{"), odd_name, odd_who, F.lit("}"))
    listed = credits.join(artists, "artist_id").groupBy("rec_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", entry.alias("e")))), lambda x: x["e"]), ", ").alias("entries"))
    rows = recordings.join(listed, "rec_id", "left").withColumn("entries", F.coalesce("entries", F.lit("")))
    tag, number = _quoted(F.col("tag")), n.cast("string")
    keys = (
        _one_of(n, "", '"artist-credit": null', '"artist-credit": []', *(F.concat(F.lit('"artist-credit": ['), "entries", F.lit("]")),) * 3),
        _one_of(n, "", '"tags": null', '"tags": []', F.concat(F.lit('"tags": [{"count": 1}, {"name": null}, {"name": '), tag, F.lit("}]")), '"tags": [{"count": 2}]'),
        _one_of(n, "", '"genres": null', F.concat(F.lit('"genres": [{"name": "b", "count": 1}, {"name": "a"}, {"count": 9}, {"name": "c", "count": null}, {"name": '), tag, F.lit(', "count": 3}]'))),
        _one_of(
            n, "", '"label-info": null', '"label-info": []', '"label-info": [{"label": null}, {"catalog-number": "1"}, {"label": {"name": "X"}}]', '"label-info": [{"label": {"type": null, "name": "N"}}]',
            '"label-info": [{"label": {"type": "Imprint", "name": ""}}, {"label": {"type": "", "name": "M"}}]', '"label-info": [{"label": {"type": "t", "name": null}}]', '"label-info": [{"label": {}}, {"label": {"type": "t", "name": "K"}}]',
        ),
        _one_of(
            n, "", F.concat(F.lit('"relations": [{"type": "wiki", "target-type": "url", "url": {"resource": "http://w/'), number, F.lit('"}}, {"type": "wiki", "target-type": "url", "url": {"resource": "http://v/"}}]')),
            '"relations": [{"type": "", "target-type": "url", "url": {"resource": "u"}}, {"type": "a", "url": {"resource": "u"}}, {"type": "b", "target-type": "url", "url": {}}]', '"relations": null',
        ),
    )
    text = F.concat(F.lit('{"id": "'), number, F.lit('"'), *(F.when(k != "", F.concat(F.lit(", "), k)).otherwise(F.lit("")) for k in keys), F.lit("}"))
    return rows.select("rec_id", text.alias("text"))


def variant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits, tags, genres, label and links of every document, and in which state its tags and labels are."""
    doc = F.col("doc")
    shown = lambda c: F.array_join(c, "|", "?")
    return document_texts(spark, sf_dir).select("rec_id", F.parse_json("text").alias("doc")).select(
        "rec_id", F.array_join(variants.credit_ids(doc), "|").alias("ids"), variants.credit_string(doc).alias("artist"), shown(variants.tag_names(doc)).alias("tags"), shown(variants.genre_names(doc)).alias("genres"),
        variants.first_label(doc).alias("label"), F.try_element_at(variants.link_map(doc), F.lit("wiki")).alias("wiki"), F.cardinality(variants.link_map(doc)).alias("n_links"),
        variants.state_of(doc, "tags").alias("tag_state"), variants.state_of(doc, "label-info").alias("label_state"), variants.has(doc, "artist-credit").alias("has_credits"),
    )


VARIANT_DOCUMENTS_SQL = """
, entry AS (
  SELECT rec_id, pos,
    CASE WHEN pos > 0 OR rec_id % 7 < 4 THEN CAST(artist_id AS VARCHAR) END AS id,
    CASE WHEN pos > 0 OR rec_id % 7 IN (0, 5, 6) THEN name || joinphrase END AS named
  FROM credit JOIN artist USING (artist_id) WHERE rec_id % 6 > 2),
who AS (SELECT rec_id, string_agg(id, '|' ORDER BY pos) AS ids, string_agg(named, '' ORDER BY pos) AS artist FROM entry GROUP BY rec_id)
SELECT r.rec_id, coalesce(ids, '') AS ids, artist, CASE WHEN r.rec_id % 5 = 3 THEN '?|' || tag END AS tags, CASE WHEN r.rec_id % 3 = 2 THEN tag || '|b|a|c' END AS genres,
  CASE r.rec_id % 8 WHEN 4 THEN 'N' WHEN 5 THEN 'M' WHEN 7 THEN 'K' END AS label, CASE WHEN r.rec_id % 4 = 1 THEN 'http://w/' || r.rec_id END AS wiki, CAST(r.rec_id % 4 = 1 AS INTEGER) AS n_links,
  CASE r.rec_id % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' WHEN 2 THEN 'empty' ELSE 'filled' END AS tag_state,
  CASE r.rec_id % 8 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' WHEN 2 THEN 'empty' ELSE 'filled' END AS label_state, r.rec_id % 6 <> 0 AS has_credits
FROM recording r LEFT JOIN who USING (rec_id)"""


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of every release, empty where there are none, the front one, and the path of its file."""
    releases = view(spark, sf_dir, "track_release").select(F.col("release_id").alias("id")).distinct()
    listed = lookup.image_lists(releases, view(spark, sf_dir, "image").withColumnRenamed("release_id", "id"))
    size = F.when(F.col("id") % 2 == 0, F.lit("1200"))
    return listed.select(
        F.col("id").alias("release_id"), F.array_join(F.transform("images", lambda x: F.concat(x["image_id"].cast("string"), F.lit(":"), x["kind"])), "|").alias("images"),
        lookup.front_image(F.col("images"))["image_id"].alias("front_id"), documents.image_path(F.lit("release"), F.col("id").cast("string"), size).alias("path"),
    )


IMAGES_SQL = """
, listed AS (SELECT release_id, string_agg(image_id || ':' || kind, '|' ORDER BY image_id) AS images, min(image_id) FILTER (front AND approved) AS front_id FROM image GROUP BY release_id)
SELECT release_id, coalesce(images, '') AS images, front_id, '/release/' || release_id || '/front-' || CASE WHEN release_id % 2 = 0 THEN '1200' ELSE '500' END AS path
FROM (SELECT DISTINCT release_id FROM track_release) r LEFT JOIN listed USING (release_id)"""


QUERIES: dict[str, Query] = {f.__name__: f for f in (variant_documents, images)}


def sql() -> dict[str, str]:
    return {
        "variant_documents": with_views(VARIANT_DOCUMENTS_SQL, "recording", "credit", "artist"),
        "images": with_views(IMAGES_SQL, "track_release", "image"),
    }
