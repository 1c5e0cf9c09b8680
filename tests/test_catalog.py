"""Choices, cascades, caching and sources on small tables; every query against its SQL; plans of the headline queries."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from trackforge.operators import artists, collaboration, enrich, lookup, ranking
from trackforge.plans import cascade, catalog_queries, registry
from trackforge.sources import catalog, documents
from trackforge.streaming import cache


def connect(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.sql()))
def test_query_equals_sql(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    result = connect(sf_dir).execute(registry.sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in result.fetchall())


def test_browsing_goes_on_after_place_twenty(spark, sf_dir):
    found = catalog_queries.browse_all_releases(spark, sf_dir).groupBy("ask_id", "total").agg(F.max("pos").alias("last")).collect()
    assert any(r.total > 20 for r in found) and all(r.last == min(r.total, 1000) for r in found)


def test_label_is_sought_among_the_first_releases(spark):
    rows = [(1, i, "late" if i == 120 else "never", "Imprint" if i == 120 else None, "Official") for i in range(1, 131)] + [(2, i, f"label {i}", "Imprint" if i > 99 else None, "Bootleg") for i in range(1, 131)]
    releases = spark.createDataFrame(rows, "rec_id long, release_id long, label string, label_type string, status string")
    assert [tuple(r) for r in enrich.label_of(releases).collect()] == [(2, "label 100")]


def test_selection_equals_a_walk(spark):
    r = random.Random(1)
    rows = []
    for k in range(300):
        for place in range(r.randrange(1, 7)):
            suffix = " (Mix)" if k % 5 == 0 else ""
            rows.append((k, 1000 + 100 * k + place, "Song" + suffix, r.choice(["song" + suffix, "other"]), r.randrange(3), r.randrange(2), place, r.random() < 0.5, r.random() < 0.4, r.random() < 0.3))
    df = spark.createDataFrame(rows, "key int, rec_id long, asked string, title string, score int, days int, place int, has_isrc boolean, qualifies boolean, various boolean")
    found = dict(map(tuple, ranking.select_recordings(df, ["key"]).collect()))
    for k in range(300):
        mine = [x for x in rows if x[0] == k]
        exact = lambda x: x[3] != "other"
        chosen = None
        if k % 5 or any(map(exact, mine)):
            held = fallback = None
            for x in sorted(mine, key=lambda x: (-exact(x), -x[4], -x[5], x[6])):
                if x[8]:
                    chosen = held if held and not x[7] else x[1]
                    break
                fallback = fallback or (x[1] if x[9] else None)
                held = held or (x[1] if exact(x) and x[7] else None)
            chosen = chosen or held or fallback
        assert found.get(k) == chosen


def test_best_release_beyond_a_million_places(spark):
    rows = [(1, 50, 1_000_000, "Official"), (1, 40, 3, "Official"), (2, 50, 1_000_001, "Official"), (2, 50, 2_147_483_647, "Official"), (2, 49, 1, "Official"), (3, -20, 2_500_000, None), (3, -30, 7, None)]
    df = spark.createDataFrame(rows, "rec_id long, score10 long, pos int, status string")
    assert sorted((r.rec_id, r.pos) for r in ranking.best_release(df).collect()) == [(1, 1_000_000), (2, 1_000_001), (3, 2_500_000)]


@pytest.fixture(scope="module")
def small(spark):
    recordings = spark.createDataFrame(
        [(1, "Iris", "", "US1", 5, "2012"), (2, "Iris (Live)", "live", None, 5, "2014"), (3, "Duet", "", "US3", None, "1999-05"), (4, "Iris", "karaoke", None, 5, "2013")],
        "rec_id long, title string, disambiguation string, isrc string, length long, first_date string",
    )
    release = "rec_id long, release_id long, title string, date string, status string, primary_type string, secondary_type string, packaging string, various boolean, label string, label_type string, first_date string, pos int"
    releases = spark.createDataFrame(
        [(1, 10, "TRST", "2012", "Official", "Album", "", None, False, "L", None, "2012", 1), (2, 11, "Live Set", "2014", "Official", "Album", "Live", None, False, "M", "Imprint", "2014", 1),
         (3, 12, "Duets", "1999", "Official", "Single", "", None, False, "N", "Imprint", "1999", 1), (4, 13, "Best of Karaoke", "2013", "Official", "Album", "", None, True, "O", "Imprint", "2013", 1)], release,
    )
    credits = spark.createDataFrame([(1, 0, 1, ""), (2, 0, 1, ""), (3, 0, 2, " & "), (3, 1, 3, ""), (4, 0, 4, "")], "rec_id long, pos int, artist_id long, joinphrase string")
    people = spark.createDataFrame([(1, "TR/ST", "Trust", 0), (2, "MӨЯIS BLΛK", "Moris Blak", 0), (3, "The Cure", "Cure", 0), (4, "Sing Along", "SA", 0)], "artist_id long, name string, alias string, nation int")
    return recordings, releases, credits, people


def test_cascade(spark, small):
    asked = spark.createDataFrame(
        [(1, "03-Iris", "TR/ST", None, None, None), (2, "Iris (Live)", "TR/ST", None, None, None), (3, "Iris (Unknown Mix)", "TR/ST", None, None, None), (4, "x", "y", None, None, " us3 "),
         (5, "Duet", "Moris Blak, & The Cure", None, None, None), (6, "", "a", None, None, None), (7, "Iris", None, None, None, None), (8, "Iris", "TR/ST", "No Such Album", 2012, None), (9, "Duet", "MӨЯIS BLΛK", None, None, None)],
        "ask_id long, title string, artist string, album string, year int, isrc string",
    )
    found = {r.ask_id: (r.exact_id, r.fallback_id) for r in cascade.find_recordings(cascade.Catalog(*small), asked).collect()}
    assert found == {1: (1, None), 2: (2, None), 3: (None, 1), 4: (3, None), 5: (3, None), 6: (None, None), 7: (None, None), 8: (1, None), 9: (3, None)}


def test_artist_lookups(spark, small):
    recordings, _, credits, people = small
    asked = spark.createDataFrame([(1, "The Cure", None), (2, "06-Cure", "Duet"), (3, "Nobody", None), (4, " ", None)], "ask_id long, name string, song string")
    found = {r.ask_id: (r.artist_id, r.rec_ids) for r in artists.lookup_artists(asked, people, recordings, credits).collect()}
    assert found == {1: (3, []), 2: (3, [])}
    strict = {r.ask_id: r.rec_ids for r in artists.lookup_artists(asked, people, recordings, credits, always_validate=True).collect()}
    assert strict == {2: [3]}
    assert {r.name for r in artists.artist_names(people.select("artist_id").union(spark.range(90, 91)), people).collect()} == {"TR/ST", "MӨЯIS BLΛK", "The Cure", "Sing Along"}


def test_collaborations(spark, small):
    recordings, _, credits, people = small
    names = spark.createDataFrame([("Trust", 1), ("The Cure", 3), ("Simon & Garfunkel", 7)], "name string, artist_id long")
    asked = spark.createDataFrame(
        [(1, "Simon & Garfunkel", None), (2, "Trust feat. The Cure & Trust", None), (3, "Trust & Nobody Known", None), (4, "Moris Blak & The Cure", "Duet"), (5, "Trust feat. Unknown Person", None), (6, " ", None)],
        "ask_id long, artist string, song string",
    )
    found = {r.ask_id: (r.stage, r.artist_ids, r.artists) for r in collaboration.resolve_collaborations(asked, names, people, recordings, credits).collect()}
    assert found == {1: (1, [7], ["Simon & Garfunkel"]), 2: (2, [1, 3], ["Trust", "The Cure", "Trust"]), 4: (3, [2, 3], ["MӨЯIS BLΛK", "The Cure"]), 5: (4, [1], ["Trust"])}


def test_groups_divide(spark, small):
    groups = spark.createDataFrame([(1, 0, 2), (1, 0, 9), (1, 1, 3), (2, 0, 1), (2, 1, 3)], "ask_id long, group_no int, artist_id long")
    assert list(map(tuple, artists.by_group(groups, small[2]).collect())) == [(1, 3)]


def test_replaced_names(spark):
    df = spark.createDataFrame([('Lil B "The Based God"',), ("Other",)], "n string")
    assert [r.x for r in df.select(lookup.replaced_name(F.col("n")).alias("x")).collect()] == ["Lil B", "Other"]


def test_documents_are_read_with_fixed_schemas(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "r1", "title": "T", "isrcs": [], "artist-credit": [{"name": "A", "artist": {"id": "x"}}], "releases": [{"id": "q", "release-group": {"primary-type": "Album", "secondary-types": []}}]}')
    read = documents.read_documents(spark, str(tmp_path), documents.RECORDING)
    row = read.first()
    assert row.artist_credit[0].artist.id == "x" and row.releases[0].release_group.primary_type == "Album" and row.isrcs == []
    documents.write_documents(read.select("id", "title"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().title == "T"
    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "front.jpg").write_bytes(b"abc")
    assert documents.read_images(spark, str(tmp_path / "i")).first().content == b"abc"


def test_streamed_entries(spark, tmp_path):
    rows = [("k", "2024-01-01 00:10:00", 1, 7200), ("k", "2024-01-01 00:20:00", 2, 60), ("j", "2024-01-01 00:30:00", 3, 7200)]
    df = spark.createDataFrame(rows, "key string, t string, data long, ttl int").select("key", F.to_timestamp("t").alias("written_time"), "data", "ttl")
    df.write.parquet(str(tmp_path / "in"))
    stream = cache.stream_live_entries(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["key"])
    query = stream.writeStream.format("memory").queryName("entries").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert [(r.key, r.data) for r in spark.sql("SELECT * FROM entries").collect()] == [("j", 3)]


@pytest.mark.parametrize("name", ["best_release", "score_recording", "enrich", "search_recordings"])
def test_headline_plans_have_no_products_or_python(spark, sf_dir, name):
    plan = catalog_queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan and "Arrow" not in plan


def test_views_are_whole(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/part.parquet").count()
    assert catalog.view(spark, sf_dir, "recording").count() == n and catalog.view(spark, sf_dir, "track").count() == n


def test_parts_of_any_depth_settle_in_order(spark):
    """Against a plain recursion, for each depth; more than ten parts keep their order."""
    from trackforge.functions.splitting import split_artists

    r = random.Random(6)
    known = {f"artist {c}": i for i, c in enumerate("abcdef")} | {"artist a & artist b": 50}
    marks = [" feat. ", " & ", ", ", " vs. ", " x "]
    strings = ["".join(f"artist {r.choice('abcdefgh')}{r.choice(marks)}" for _ in range(r.randrange(1, 6))) + "artist a" for _ in range(60)]
    names = spark.createDataFrame(list(known.items()), "name string, artist_id long")
    pool, todo = {}, set(strings)
    while todo:
        rows = spark.createDataFrame([(t,) for t in sorted(todo)], "t string").select("t", split_artists(F.col("t")).alias("h")).collect()
        pool |= {x.t: [y.strip() for y in x.h] for x in rows}
        todo = {y for x in rows if len(x.h) > 1 for y in (z.strip() for z in x.h)} - set(pool)

    def walk(parts, depth, most):
        if depth >= most:
            return None
        out = []
        for i, p in enumerate(parts):
            if p in known:
                out.append(([i], p))
                continue
            below = walk(pool[p], depth + 1, most) if len(pool[p]) > 1 else None
            if below is None:
                return None
            out += [([i, *path], name) for path, name in below]
        return out

    asked = spark.createDataFrame(list(enumerate(strings)), "ask_id long, artist string")
    for most in (1, 2, 3, 5):
        found = {}
        for row in collaboration.hierarchical(collaboration.first_parts(asked), names, most).collect():
            found.setdefault(row.ask_id, []).append((row.path, row.name))
        want = {i: w for i, t in enumerate(strings) if len(pool[t]) > 1 and (w := walk(pool[t], 0, most))}
        assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    many = spark.createDataFrame([(1, [i], f"artist {'abcdef'[i % 6]}") for i in range(14)], "ask_id long, path array<int>, name string")
    assert [x.path for x in collaboration.hierarchical(many, names).collect()] == [[i] for i in range(14)]
