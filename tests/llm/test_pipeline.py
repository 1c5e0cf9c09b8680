"""The pipeline's stages on the smallest tables, and the queries against their SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackforge.llm import queries, secrets


def connect(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted((repr(tuple(r[c] for c in columns)) for r in df.collect()))
    result = connect(sf_dir).execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in result.fetchall())


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if name == "quality_classifier":
            lost = good - {r.doc_id for r in after.select("doc_id").collect()}
            assert len(lost) <= 0.05 * len(good) and after.count() < before
        if name == "packing":
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
            assert {r.doc_id for r in after.select("doc_id").collect()} == ids
        else:
            assert after.columns == columns and after.count() <= docs.count()
        if name == "secret_scan":
            assert secrets.scan(after.select("doc_id", "text")).agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex"))).first()[0] == 0
        docs = after
