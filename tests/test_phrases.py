"""Phrase search against a plain walk, on awkward requests, and its plan."""

import random

from pyspark.sql import functions as F

from trackforge.operators import artists, phrases


def plain_search(values, asked, words_of):
    """{ask: [(key, score)] best first}."""
    values = {(k, f, w) for k, f, t in values if (w := tuple(words_of(t)))}
    counts = {}
    for _, _, words in values:
        for w in set(words):
            counts[w] = counts.get(w, 0) + 1
    weight = lambda words: sum((len(values) // counts[w]).bit_length() for w in words if w in counts)
    stands = lambda p, w: any(w[i : i + len(p)] == p for i in range(len(w) - len(p) + 1))
    out = {}
    for ask, conditions in asked:
        given = {(f, tuple(words_of(p))) for f, p in conditions if p}
        if not given or any(not p for _, p in given):
            continue
        found = {}
        for key in {k for k, _, _ in values}:
            scores = [max((100 * weight(p) // weight(w) for k, g, w in values if k == key and g == f and stands(p, w)), default=None) for f, p in given]
            if None not in scores:
                found[key] = sum(scores) // len(scores)
        out[ask] = sorted(found.items(), key=lambda x: (-x[1], x[0]))
    return out


def conditions(spark, asked):
    return spark.createDataFrame(asked, "ask_id long, conditions array<struct<field: string, phrase: string>>")


def test_phrases_equal_a_plain_walk(spark):
    r = random.Random(3)
    phrase = lambda n: " ".join(r.choice("abcde") for _ in range(n))
    values = [(k, r.choice(["title", "album"]), phrase(r.randrange(1, 7))) for k in range(80) for _ in range(2)]
    values += [(5, "title", "The Night! (of) it"), (6, "title", "the night of"), (7, "title", None), (8, "title", "!!!"), (9, "title", ""), (5, "title", "The Night! (of) it"), (10, "title", "Éa  a")]
    asked = [(i, [(r.choice(["title", "album"]), phrase(r.randrange(1, 5))) for _ in range(r.randrange(1, 4))]) for i in range(120)]
    asked += [(200, [("title", "night of")]), (201, [("title", "of night")]), (202, [("title", "???")]), (203, []), (204, [("title", None), ("album", "")]), (205, [("title", "a"), ("title", "A!")])]
    asked += [(206, [("title", "zebra")]), (207, [("nothing", "a")]), (208, [("title", "a a")]), (209, [("title", "Night (of)"), ("album", None)])]
    index = phrases.PhraseIndex(spark.createDataFrame(values, "key long, field string, text string"))
    fold = str.maketrans("!()?", "    ")
    want = plain_search(values, asked, lambda t: (t or "").translate(fold).lower().replace("é", "e").split())
    for limit, offset in ((1000, 0), (3, 2)):
        found = {}
        for row in index.search(conditions(spark, asked), limit, offset).orderBy("ask_id", "rank").collect():
            found.setdefault(row["ask_id"], []).append((row["key"], row["score"]))
            assert row["total"] == len(want[row["ask_id"]])
        assert found == {a: hits[offset : offset + limit] for a, hits in want.items() if hits[offset : offset + limit]}
    assert {k for k, _ in want[200]} == {5, 6} and not want[201] and dict(want[200])[6] > dict(want[200])[5]


def test_empty_index_and_nobody_asking(spark):
    none = phrases.PhraseIndex(spark.createDataFrame([], "key long, field string, text string"))
    assert none.search(conditions(spark, [(1, [("title", "a")])])).count() == 0
    some = phrases.PhraseIndex(spark.createDataFrame([(1, "title", "a b")], "key long, field string, text string"))
    assert some.search(conditions(spark, [])).count() == 0


def test_score_floor_bites(spark):
    names = spark.createDataFrame([(1, "The Harbour Lights", None), (2, "Harbour", None), (3, "Harbour Lights", "HL")] + [(10 + i, f"The Band {i}", None) for i in range(40)], "artist_id long, name string, alias string")
    index = phrases.artist_phrases(names)
    asked = spark.createDataFrame([(1, "Harbour Lights"), (2, "Harbour"), (3, "Lights"), (4, "hl")], "ask_id long, name string")
    scores = {(r["ask_id"], r["artist_id"]): r["score"] for r in phrases.search_artists(asked, index).collect()}
    assert scores[1, 3] == 100 and 70 <= scores[1, 1] < 100 and scores[2, 2] == 100 and scores[2, 3] < 70 and scores[3, 3] < 70 and scores[4, 3] == 100
    found = artists.find_artist_ids(asked.withColumnRenamed("name", "artist"), names, index=index)
    assert {(r["ask_id"], r["artist_id"]) for r in found.collect()} >= {(1, 3), (2, 2), (4, 3)} and not found.filter("ask_id = 3").count()


def test_no_product_and_pages_cut_before_the_join(spark):
    index = phrases.PhraseIndex(spark.createDataFrame([(i, "title", f"a b {i}") for i in range(50)], "key long, field string, text string"))
    plan = index.search(conditions(spark, [(1, [("title", "a b")])]), 5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


def test_values_are_worked_out_once_and_anchored_conditions_count(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    counted = F.udf(seen, "string").asNondeterministic()
    assert phrases.PhraseIndex(spark.range(20).select(F.col("id").alias("key"), F.lit("title").alias("field"), counted(F.col("id").cast("string")).alias("text"))).n_values == 20
    assert read.value == 20
    index = phrases.PhraseIndex(spark.createDataFrame([(i, f, t) for i in range(30) for f, t in (("title", "hot ring"), ("title", f"hot ring {i}"), ("artist", f"act {i % 3}"))], "key long, field string, text string"))
    asked = [(1, [("title", "hot ring")]), (2, [("title", "ring"), ("artist", "act 1")]), (3, [("title", "hot ring 4"), ("artist", "act 2")]), (4, [("title", "unknown"), ("artist", "act 1")]), (5, [("artist", "act 1"), ("title", "ring")])]
    found = {}
    for r in index.search(spark.createDataFrame(asked, "ask_id long, conditions array<struct<field: string, phrase: string>>")).collect():
        found.setdefault(r.ask_id, {})[r.key] = (r.score, r.total)
    assert found[1] == {i: (100, 30) for i in range(30)} and set(found[2]) == {i for i in range(30) if i % 3 == 1} and found[2] == found[5]
    assert 3 not in found and 4 not in found
