"""Documents as one VARIANT, recorded pages, lists of images, and division by the rarest group."""

import json
import random

import pytest
from pyspark.sql import functions as F

from trackforge.functions import variants
from trackforge.operators import artists, lookup
from trackforge.plans import document_queries, registry
from trackforge.sources import documents, pages

LISTS = ("artist-credit", "tags", "genres", "label-info", "relations")
DOCUMENTS = {
    "missing": {},
    "null": dict.fromkeys(LISTS),
    "empty": {k: [] for k in LISTS},
    "wrong": {"artist-credit": {"a": 1}, "tags": "x", "genres": 3, "label-info": "", "relations": {}},
    "filled": {
        "artist-credit": [{"name": "A", "joinphrase": " & ", "artist": {"id": "1"}}, {"name": "B", "artist": None}, {"name": "C"}, {"name": None, "joinphrase": "x", "artist": {}}, 5],
        "tags": [{"count": 1}, {"name": None}, {"name": "t"}],
        "genres": [{"name": "a", "count": 1}, {"name": "b"}, {"name": "c", "count": None}, {"name": "d", "count": 3}, {"count": 9}],
        "label-info": [{"label": None}, {"label": {"name": "X"}}, {"label": {"type": None, "name": "N"}}],
        "relations": [
            {"type": "w", "target-type": "url", "url": {"resource": "u1"}}, {"type": "w", "target-type": "url", "url": {"resource": "u2"}},
            {"type": "", "target-type": "url", "url": {"resource": "u3"}}, {"type": "b", "target-type": "url", "url": {}}, {"type": "c", "target-type": "artist", "url": {"resource": "u4"}},
        ],
    },
}


def test_missing_null_and_empty_stay_apart(spark, tmp_path):
    for name, content in DOCUMENTS.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"id": name} | content, indent=1))
    d = F.col("doc")
    read = documents.read_variants(spark, str(tmp_path))
    assert read.schema.simpleString() == "struct<doc:variant>"
    rows = read.select(
        variants.text_at(d, "id"), variants.credit_ids(d), variants.credit_string(d), variants.tag_names(d), variants.genre_names(d), variants.first_label(d), variants.link_map(d), variants.state_of(d, "tags")
    ).collect()
    none = ([], None, None, None, None, {})
    assert {r[0]: tuple(r[1:]) for r in rows} == {
        "missing": (*none, "missing"), "null": (*none, "null"), "empty": (*none, "empty"), "wrong": (*none, "filled"),
        "filled": (["1"], "A & B", [None, "t"], ["d", "a", "b", "c"], "N", {"w": "u1"}, "filled"),
    }


def test_a_file_that_is_no_json_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.read_variants(spark, str(tmp_path)).collect()


def test_texts_of_the_query_are_json(spark, sf_dir):
    """Each of the documents that the query reads, against a plain reading of its text."""
    read = {r.rec_id: json.loads(r.text) for r in document_queries.document_texts(spark, sf_dir).collect()}
    found = {r.rec_id: r for r in document_queries.variant_documents(spark, sf_dir).collect()}
    assert read.keys() == found.keys()
    for key, doc in read.items():
        credits = [c for c in doc.get("artist-credit") or () if "artist" in c]
        assert found[key].ids == "|".join(c["artist"]["id"] for c in credits if c["artist"] and c["artist"].get("id"))
        assert found[key].artist == ("".join(c["name"] + c.get("joinphrase", "") for c in credits if c.get("name")) or None)
        tags = [t["name"] for t in doc.get("tags") or () if "name" in t]
        assert found[key].tags == ("|".join(t or "?" for t in tags) if tags else None)


def _written(folder, recording, offset, n, total=0):
    (folder / recording).mkdir(exist_ok=True)
    releases = [{"id": f"{recording}-{offset + i}"} for i in range(n)]
    (folder / recording / f"{offset}.json").write_text(json.dumps({"release-count": total, "release-offset": offset, "releases": releases}))


@pytest.fixture
def recorded(tmp_path):
    for offset in range(0, 1300, 100):
        _written(tmp_path, "many", offset, 100)
    for offset, n in ((0, 100), (100, 40), (200, 100)):
        _written(tmp_path, "short", offset, n)
    for offset in (0, 200):
        _written(tmp_path, "gap", offset, 100)
    _written(tmp_path, "none", 0, 0)
    _written(tmp_path, "late", 100, 5)
    (tmp_path / "many" / "notes.txt").write_text("no page")
    (tmp_path / "many" / "x.json").write_text("no page either")
    return tmp_path


def test_recorded_pages_are_collected_in_turn(spark, recorded):
    found = {}
    for r in pages.collected_releases(pages.read_pages(spark, f"file://{recorded}")).orderBy("position").collect():
        found.setdefault(r.recording, []).append((r.position, json.loads(r.release)["id"]))
    assert {k: len(v) for k, v in found.items()} == {"many": 1000, "short": 140, "gap": 100}
    assert all(v == [(i, f"{k}-{i}") for i in range(len(v))] for k, v in found.items())


def test_recorded_pages_are_pruned(spark, recorded):
    whole = pages.read_pages(spark, str(recorded))
    assert whole.rdd.getNumPartitions() == whole.count() == 20
    one = whole.filter("recording = 'short'")
    assert one.rdd.getNumPartitions() == 3 and one.agg(F.sum(F.size("releases"))).first()[0] == 240
    some = whole.filter("recording IN ('short', 'gap', 'unknown') AND offset = 200")
    assert some.rdd.getNumPartitions() == 5 and {r.recording for r in some.collect()} == {"short", "gap"}
    assert whole.filter("recording = '../x'").count() == 0 and whole.filter("recording = 'gap' AND recording = 'many'").count() == 0
    assert pages.read_pages(spark, str(recorded), pages_per_partition=8).rdd.getNumPartitions() == 3


def test_broken_pages_fail(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "0.json").write_text("[]")
    with pytest.raises(Exception, match="holds no object"):
        pages.read_pages(spark, str(tmp_path)).collect()


def test_lists_of_images(spark):
    images = spark.createDataFrame([(1, 2, True, True, "f"), (1, 1, True, False, "g"), (2, 5, False, True, "b"), (9, 1, True, True, "n")], "id long, image_id long, front boolean, approved boolean, kind string")
    asked = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x"), (None, "z")], "id long, note string")
    found = lookup.image_lists(asked, images).select("id", "note", F.transform("images", lambda x: x["kind"]), lookup.front_image(F.col("images"))["kind"]).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "x", ["g", "f"], "f"), (1, "y", ["g", "f"], "f"), (2, "x", ["b"], None), (3, "x", [], None), (None, "z", [], None)], key=str)
    assert lookup.image_lists(asked.limit(0), images).count() == 0
    assert lookup.image_lists(asked, images.limit(0)).filter("size(images) = 0").count() == 5


def test_division_against_a_plain_one(spark):
    """Random groups, one artist on a third of all credits, repeated and null rows."""
    r = random.Random(3)
    credits = [(rec, r.choice([0, 0, *range(1, 8)])) for rec in range(120) for _ in range(r.randrange(1, 4))] + [(None, 1), (5, None)]
    groups = [(ask, no, r.choice([0, *range(1, 9)])) for ask in range(60) for no in range(r.randrange(1, 4)) for _ in range(r.randrange(1, 3))]
    groups += [(100, 0, 1), (100, 1, None), (101, None, 1), (102, 0, 1), (102, 0, None), *groups[:9]]
    found = artists.by_group(spark.createDataFrame(groups, "ask_id long, group_no int, artist_id long"), spark.createDataFrame(credits, "rec_id long, artist_id long"))
    expected = set()
    for ask in {g[0] for g in groups if g[1] is not None}:
        sets = [{a for k, n, a in groups if (k, n) == (ask, no)} - {None} for no in {n for k, n, _ in groups if k == ask}]
        expected |= {(ask, rec) for rec, _ in credits if rec is not None and all(any((rec, a) in credits for a in s) for s in sets)}
    rows = list(map(tuple, found.collect()))
    assert len(rows) == len(set(rows)) and set(rows) == expected and any(a == 102 for a, _ in rows)


def test_rarest_group_names_the_candidates(spark):
    """A request for an artist with every recording and one with few meets only the few."""
    credits = spark.range(5000).select(F.col("id").alias("rec_id"), F.explode(F.when(F.col("id") % 1000 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("artist_id"))
    groups = spark.createDataFrame([(a, g, g + 1) for a in range(50) for g in range(2)], "ask_id long, group_no int, artist_id int")
    found = artists.by_group(groups, credits)
    assert found.count() == 250
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_queries_are_registered():
    assert set(document_queries.QUERIES) == set(document_queries.sql()) <= set(registry.queries())
