"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import create_envelope, split_lines

CAR_SCHEMA = T.StructType(
    [T.StructField("time", T.StringType())]
    + [T.StructField(n, T.FloatType()) for n in (
        "seconds", "latitude", "longitude", "distance", "speed", "steering_angle", "throttle", "rpm",
        "lateral_gs", "acceleration_gs")])

DETECTION_SCHEMA = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax", "confidence")]
    + [T.StructField("class", T.IntegerType()), T.StructField("name", T.StringType())])


def load_full(spark: SparkSession, path: str) -> DataFrame:
    """Full copy of a table kept as parquet."""
    return spark.read.parquet(path)


def load_full_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int,
                   properties: dict[str, str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Full copy of a database table, read in ``partitions`` key ranges at once."""
    options = dict(properties or {}) | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=options)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "error") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Columns are bound by position; the header line is skipped, not matched."""
    return spark.read.schema(schema).option("header", header).option("enforceSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON document per line. Give a schema in production: inference reads the data twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """JSON lines, one folder per value of ``partition_by``."""
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Nested elements; attributes become columns with a leading underscore."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_text(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """One message per line, or one per file with ``whole``."""
    if whole:
        return spark.read.text(path, wholetext=True)
    # lines end at LF or CR LF; a lone CR stays in the line
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.regexp_replace("value", "\r$", "").alias("value"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, idx, line) of files that fit a row each."""
    return (spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
            .select("file", F.posexplode(split_lines("value")).alias("idx", "line")))


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File bytes with path, time and length."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def page_tags(name: Column) -> list[Column]:
    """date, geo and hours from a name like 2025-02-18-US-24.html"""
    pattern = r"(\d{4}-\d{2}-\d{2})-([A-Za-z]+)-(\d+)\.html$"
    return [F.regexp_extract(name, pattern, 1).alias("date"), F.regexp_extract(name, pattern, 2).alias("geo"),
            F.regexp_extract(name, pattern, 3).try_cast("int").alias("hours")]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages with the tags of their file names."""
    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_name"), F.col("value").alias("html"))
    return pages.select(*page_tags(F.col("_name")), "html")


def to_message(df: DataFrame, columns: Sequence[str], out: str = "body", envelope: bool = False) -> DataFrame:
    """Row to JSON text, optionally as a create message."""
    return df.withColumn(out, create_envelope(*columns) if envelope else F.to_json(F.struct(*columns)))


def keyed_rows(requests: DataFrame, partition_key: str, query: str = "query_email", body: str = "body_email",
               out: str = "email") -> DataFrame:
    """Rows with a fixed partition key and a random row key; the value comes from the query, else from the body."""
    return requests.select(
        F.lit(partition_key).alias("partition_key"), F.uuid().alias("row_key"),
        F.coalesce(F.nullif(F.col(query), F.lit("")), F.col(body)).alias(out))


def append_keyed(requests: DataFrame, path: str, partition_key: str, **names: str) -> None:
    keyed_rows(requests, partition_key, **names).write.mode("append").parquet(path)


def route_to_tables(changes: DataFrame, path: str, name: Column, column: str = "target_table",
                    columns: Mapping[str, Sequence[str | Column]] | None = None) -> None:
    """Append each row to the folder of its target table.

    Tables of one schema are written in one job. With ``columns`` every table named there
    gets a schema of its own: the rows of each go through a filter and its columns to
    ``path/target_table=name``; rows of other tables fail the job.
    """
    named = changes.withColumn(column, name)
    if columns is None:
        named.write.mode("append").partitionBy(column).parquet(path)
        return
    known = F.col(column).isin(list(columns))
    stray = named.filter(~F.coalesce(known, F.lit(False))).select(column).first()
    if stray is not None:
        raise ValueError(f"no columns given for table {stray[0]!r}")
    for table, wanted in columns.items():
        named.filter(F.col(column) == table).select(*wanted).write.mode("append").parquet(f"{path}/{column}={table}")
