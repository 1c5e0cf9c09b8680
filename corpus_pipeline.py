"""The corpus pipeline: five stages, each a Spark job over all that the one before has kept.

Every stage takes nulls in any column, empty and very long texts, repeated rows,
tables without rows, and further columns of any name, which it hands on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackforge.llm import decontamination, near_duplicates, packing, quality, secrets
from trackforge.llm.common import fresh, shared_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; what it rejects goes.

    Without labels all stay.  Columns named as those that the operator adds are set aside meanwhile.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    aside = {c: fresh(docs, f"{c}_of_documents") for c in docs.columns if c.lower() in quality.ADDED}
    return quality.resample(docs.withColumnsRenamed(aside), labels).select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; rows that repeat id and text stay once, texts without words all stay."""
    return near_duplicates.one_of_each(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark's passages do not contaminate; null and empty texts stay, as all do without passages."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets masked and n_chars as it is then; null texts stay as they are."""
    return secrets.redact(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null text is an empty one, whose end id is packed."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]

#: Importance resampling, the random field and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
