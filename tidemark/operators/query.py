"""Plain queries: projection, filters, order, paging, counts, unions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.running import with_row_number

PAGE_SIZE = 50
TOP_K_ROWS = 10_000


def select_all(df: DataFrame) -> DataFrame:
    return df.select("*")


def query_by_param(spark: SparkSession, sql: str, params: Mapping[str, object], **frames: DataFrame) -> DataFrame:
    """Query with bound parameters (``:name``) over named DataFrames (``{name}``)."""
    return spark.sql(sql, args=dict(params), **frames)


def where(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(cond)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def order_desc(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Newest first, NULLs last. ``ties`` let the range partitioning split a frequent value."""
    return df.orderBy(F.desc_nulls_last(column), *ties)


def limit_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def page(df: DataFrame, key: str, offset: int = 0, count: int = PAGE_SIZE, block: Column | None = None) -> DataFrame:
    """Rows ``offset`` .. ``offset + count`` in key order.

    Near pages are a top-k of a few rows per task. A far page would make every task
    keep all rows before it, so it is cut out by row numbers instead, which needs a
    ``block`` of the key.
    """
    if offset + count <= TOP_K_ROWS or block is None:
        return df.orderBy(key).offset(offset).limit(count)
    numbered = with_row_number(df, "_n", [key], block)
    return numbered.filter((F.col("_n") > offset) & (F.col("_n") <= offset + count)).drop("_n").orderBy(key)


def tagged_union(parts: Mapping[tuple, DataFrame], names: tuple[str, ...]) -> DataFrame:
    """Results per tag tuple as one table with the tags as columns."""
    out = None
    for tags, df in parts.items():
        tagged = df.select(*[F.lit(v).alias(n) for n, v in zip(names, tags)], "*")
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("nothing to unite")
    return out
