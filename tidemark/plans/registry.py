"""Registry of queries and the test tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads that table, ``t.fixture('EV')`` the view derived from one."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)

    def fixture(self, name: str) -> DataFrame:
        return fixtures.build(self, name)


class StreamTables(Tables):
    """The same tables read as streams of their files."""

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        schema = Tables.__getattr__(self, name).schema
        return self.spark.readStream.schema(schema).parquet(self.path(name))

    def path(self, name: str) -> str:
        """A glob, which a streaming source takes for one file as well as for a folder of files."""
        return f"{self.folder}/{name}.parque[t]"


def query(name: str, sql: str | None = None, using: tuple[str, ...] = ()):
    """Register a query; ``sql`` is its oracle with the fixtures in ``using`` as CTEs."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = fixtures.with_ctes(sql, using)
        return fn
    return register
