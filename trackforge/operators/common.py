"""Cutting of long plans."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one only where a local session names none."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def materialized(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder.

    Later steps read them instead of computing them again, and a lost executor costs no earlier step.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
