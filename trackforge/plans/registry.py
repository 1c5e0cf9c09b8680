"""All queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackforge.plans import cache_queries, cascade_sql, catalog_queries, collaboration_sql, document_queries, phrase_queries, text_queries

_MODULES = (catalog_queries, text_queries, cache_queries, phrase_queries, document_queries, collaboration_sql, cascade_sql)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for m in _MODULES for name, text in m.sql().items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_queries.best_release(spark, sf_dir)
