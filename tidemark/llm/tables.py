"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A finished write needs its shuffle files no more; Spark removes them at its end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet and read again: the lineage ends here and their size is known."""
    path = shared_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
