"""Lines of text files, calls to a function per batch of lines, results back in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import split_lines
from tidemark.operators.running import HOT_ROWS, with_row_number

CALLS_PER_BATCH = 10


def lines_of(docs: DataFrame, key: str, body: str) -> DataFrame:
    """(key, idx, line) for each line of a text column, idx from 0."""
    return docs.select(key, F.posexplode(split_lines(body)).alias("idx", "line"))


def enrich(df: DataFrame, fn: Callable[[list], Sequence], column: str, out: str, out_type: str = "string",
           batch_size: int = CALLS_PER_BATCH, parallelism: int | None = None) -> DataFrame:
    """Call ``fn`` with up to ``batch_size`` values at a time and attach its results.

    The column holds a value, or an array of values whose results come back as an array
    in the same order, so that the lines of a row need not leave it. ``fn`` is shipped to the executors and must return one result per value.
    ``parallelism`` bounds the number of concurrent callers; waiting between calls is
    up to ``fn``. Rows keep their keys, so the order is restored by the caller.
    """
    source = df.repartition(parallelism) if parallelism else df
    listed = isinstance(df.schema[column].dataType, T.ArrayType)
    kind = T._parse_datatype_string(out_type)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(kind) if listed else kind)])

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            values = rows[column].tolist()
            if listed:
                sizes = [0 if v is None else len(v) for v in values]
                values = [x for v in values if v is not None for x in v]
            results = []
            for i in range(0, len(values), batch_size):
                part = values[i:i + batch_size]
                got = list(fn(part))
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} results for {len(part)} values")
                results += got
            if listed:
                ends = list(accumulate(sizes))
                results = [None if v is None else results[e - n:e] for v, n, e in zip(rows[column], sizes, ends)]
            yield rows.assign(**{out: pd.Series(results, index=rows.index, dtype=object)})
    return source.mapInPandas(call, schema)


def throttle_batches(lines: DataFrame, n: int = CALLS_PER_BATCH, key: str = "doc_id", idx: str = "idx") -> DataFrame:
    """Batch number of a line in its file, for lines already numbered from 0."""
    return lines.withColumn("batch", F.floor(F.col(idx) / n))


def throttle_batches_by_order(rows: DataFrame, n: int, keys: Sequence[str], order: Sequence[Column | str],
                              block: Column, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The same for rows that only have an order."""
    return with_row_number(rows, "_n", order, block, keys, hot_rows).withColumn(
        "batch", F.floor((F.col("_n") - 1) / n)).drop("_n")


def joined_lines(lines: Column) -> Column:
    """One text of an array of lines: :func:`ordered_collect` for lines that never left their row."""
    return F.array_join(lines, "\n")


def ordered_collect(lines: DataFrame, key: str, idx: str, value: str, out: str = "text") -> DataFrame:
    """One text per key, its lines in order with newlines between them.

    For lines that came out of one row, whose text therefore fits a row again. Texts
    beyond a row are written by :func:`write_lines_in_order`.
    """
    ordered = F.sort_array(F.collect_list(F.struct(idx, value)))
    return lines.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x[value]), "\n").alias(out))


def write_lines_in_order(lines: DataFrame, path: str, keys: Sequence[str], value: str) -> None:
    """Lines of any length of file as text parts whose names sort in the order of ``keys``."""
    lines.orderBy(*keys).select(value).write.mode("error").text(path)


def list_envelope(df: DataFrame, key: str, block: Column, columns: Sequence[str], page_size: int = 100) -> DataFrame:
    """``{"Documents":[..],"_count":n}`` per page of ``page_size`` rows in key order."""
    numbered = with_row_number(df.select(key, *[c for c in columns if c != key]), "_n", [key], block)
    pages = numbered.withColumn("page", F.floor((F.col("_n") - 1) / page_size))
    docs = F.transform(F.sort_array(F.collect_list(F.struct(F.col("_n"), F.struct(*columns).alias("d")))), lambda x: x["d"])
    body = F.struct(docs.alias("Documents"), F.count(F.lit(1)).alias("_count"))
    return pages.groupBy("page").agg(F.to_json(body).alias("body"), F.count(F.lit(1)).alias("n"))
