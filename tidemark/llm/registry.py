"""Registry of the queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, table: str = "documents", sql: str | None = None):
    """Register ``fn(df)`` as a query over the whole of one table."""
    def register(fn: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
