"""Odd rows through every stage of the pipeline: nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

CLASHING = ("log_weight", "gumbel_key", "class_id", "n_links", "contaminated", "n_hit", "spans", "key", "id", "hash", "text_hash", "band", "rank", "part", "toxic_evidence", "quality")
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"
ITEM = "the quick brown otter writes thirteen careful words before it dives under cold water again"
FILTERS = [s for s in corpus_pipeline.STAGES if s[0] != "packing"]


def _good(i):
    return " ".join(f"clear{(i * 7 + j) % 90} sentence{(i + 3 * j) % 70} about{(i * j) % 50}" for j in range(40))


ODD = [(900, None, None, None, None), (901, "s", "en", 0, ""), (902, "s", "en", 3, " \n "), (903, "s", None, None, "word"), (None, None, None, None, None), (None, "s", "en", 5, "stray")]
LONG = (910, "s", "en", 300_000, " ".join(f"long{(i * i) % 9973}" for i in range(30_000)))
PLANTED = [(920, "s", "en", 1, ITEM), (921, "s", "en", 1, "password = hunter22secret and " + _good(5)), (922, "s", "en", 1, _good(1)), (922, "s", "en", 1, _good(1))]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(40, 60)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    """Labels and benchmark without rows."""
    folder = str(tmp_path_factory.mktemp("bare"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def _docs(spark):
    plain = [(i, "s", "en", 10, _good(i)) for i in range(40)] + [(i, "s", "en", 10, f"zz{i} qq xx {i} vv " * 20) for i in range(40, 60)]
    df = spark.createDataFrame([*plain, *ODD, LONG, *PLANTED], COLUMNS)
    return df.select("*", *(F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING))


@pytest.mark.parametrize(("name", "stage"), FILTERS)
def test_filters_on_odd_rows(spark, tables, name, stage):
    docs = _docs(spark)
    after = stage(spark, docs, tables)
    assert after.schema.simpleString() == docs.schema.simpleString()
    rows = after.collect()
    given = sorted((r.doc_id or -1) for r in docs.collect())
    ids = sorted((r.doc_id or -1) for r in rows)
    assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASHING)
    if name == "near_duplicates":  # only what has a copy goes, and one of each stays: the repeated row, and document 1
        assert len({1, 922} & set(ids)) == 1 and set(range(2, 40)) <= set(ids) and 910 in ids
    if name == "decontamination":
        assert ids == [i for i in given if i != 920]
    if name == "secret_scan":
        assert ids == given
        assert all("hunter22secret" not in (r.text or "") for r in rows)
        assert {r.text for r in rows if r.doc_id in (900, 901, 902, 903)} == {None, "", " \n ", "word"}
    if name == "quality_classifier":
        assert len(set(range(40)) & set(ids)) >= 38 and not set(range(40, 60)) <= set(ids)


def test_packing_odd_rows(spark, tables):
    pieces = corpus_pipeline.pack(spark, _docs(spark), tables).collect()
    for key in (900, 901, 910, 920):
        of_one = sorted((p.start, p.length) for p in pieces if p.doc_id == key)
        total = {p.doc_tokens for p in pieces if p.doc_id == key}
        assert len(total) == 1 and sum(n for _, n in of_one) == total.pop()
        assert all(a + n == b for (a, n), (b, _) in zip(of_one, of_one[1:], strict=False))


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_no_documents(spark, tables, name, stage):
    docs = _docs(spark).limit(0)
    after = stage(spark, docs, tables)
    assert after.count() == 0
    if name != "packing":
        assert after.columns == docs.columns


@pytest.mark.parametrize("name", ["quality_classifier", "decontamination"])
def test_no_labels_and_no_benchmark(spark, bare, name):
    """Without labels nothing is known to be bad, without items nothing is contaminated: all stay."""
    docs = _docs(spark)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, bare).count() == docs.count()
