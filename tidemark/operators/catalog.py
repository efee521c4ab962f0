"""Schemas and tables of the session catalog, with the errors a user expects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class AlreadyExists(ValueError):
    """The schema or table is there already."""


class NotFound(ValueError):
    """The schema or table is missing."""


class NotEmpty(ValueError):
    """The schema still holds tables."""


@dataclass(frozen=True)
class PropertyChanges:
    updated: list[str]
    removed: list[str]
    missing: list[str]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _options(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())


def create_schema(spark: SparkSession, name: str, properties: Mapping[str, str] | None = None,
                  location: str | None = None) -> None:
    if spark.catalog.databaseExists(name):
        raise AlreadyExists(f"schema {name} already exists")
    sql = f"CREATE DATABASE `{name}`"
    if location:
        sql += f" LOCATION {_text(location)}"
    if properties:
        sql += f" WITH DBPROPERTIES ({_options(properties)})"
    spark.sql(sql)


def list_schemas(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def _require_schema(spark: SparkSession, name: str) -> None:
    if not spark.catalog.databaseExists(name):
        raise NotFound(f"schema {name} does not exist")


def drop_schema(spark: SparkSession, name: str) -> None:
    _require_schema(spark, name)
    if list_tables(spark, name):
        raise NotEmpty(f"schema {name} is not empty")
    spark.sql(f"DROP DATABASE `{name}` RESTRICT")


def schema_properties(spark: SparkSession, name: str) -> dict[str, str]:
    _require_schema(spark, name)
    described = spark.sql(f"DESCRIBE DATABASE EXTENDED `{name}`").filter("info_name = 'Properties'").first()
    text = described["info_value"] if described else ""
    pairs = [p.strip("()").split(",", 1) for p in text.strip("()").split("), (")] if text else []
    return {k.strip(): v.strip() for k, v in pairs}


def update_properties(spark: SparkSession, name: str, removals: Sequence[str] = (),
                      updates: Mapping[str, str] | None = None) -> PropertyChanges:
    """Set and remove schema properties; unknown removals are reported as missing."""
    updates = dict(updates or {})
    both = sorted(set(removals) & set(updates))
    if both:
        raise ValueError(f"properties both set and removed: {both}")
    have = schema_properties(spark, name)
    removed = sorted(k for k in set(removals) if k in have)
    if updates:
        spark.sql(f"ALTER DATABASE `{name}` SET DBPROPERTIES ({_options(updates)})")
    if removed:
        spark.sql(f"ALTER DATABASE `{name}` UNSET DBPROPERTIES ({', '.join(map(_text, removed))})")
    return PropertyChanges(sorted(updates), removed, sorted(set(removals) - set(removed)))


def _split(name: str) -> tuple[str, str]:
    schema, _, table = name.rpartition(".")
    return schema or "default", table


def _require_table(spark: SparkSession, name: str) -> None:
    if not table_exists(spark, name):
        raise NotFound(f"table {name} does not exist")


def table_exists(spark: SparkSession, name: str) -> bool:
    schema, table = _split(name)
    return spark.catalog.databaseExists(schema) and spark.catalog.tableExists(f"`{schema}`.`{table}`")


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    _require_schema(spark, schema)
    return sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{schema}`").filter("NOT isTemporary").collect())


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = (),
                 properties: Mapping[str, str] | None = None, location: str | None = None) -> None:
    """Empty parquet table with declared columns; a trailing slash of the location is dropped."""
    db, table = _split(name)
    _require_schema(spark, db)
    if table_exists(spark, name):
        raise AlreadyExists(f"table {name} already exists")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        + (f" COMMENT {_text(f.metadata['comment'])}" if "comment" in f.metadata else "") for f in schema.fields)
    sql = f"CREATE TABLE `{db}`.`{table}` ({columns}) USING parquet"
    if partition_by:
        sql += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if location:
        sql += f" LOCATION {_text(location.rstrip('/'))}"
    if properties:
        sql += f" TBLPROPERTIES ({_options(properties)})"
    spark.sql(sql)


def create_table_as(df: DataFrame, name: str, replace: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Table with the content of a DataFrame; ``replace`` swaps an existing one."""
    if not replace and table_exists(df.sparkSession, name):
        raise AlreadyExists(f"table {name} already exists")
    writer = df.write.format("parquet").mode("overwrite" if replace else "error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    _require_table(spark, name)
    return spark.table(name)


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    _require_table(spark, name)
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Rename inside a schema."""
    _require_table(spark, old)
    if table_exists(spark, new):
        raise AlreadyExists(f"table {new} already exists")
    (db, table), (new_db, new_table) = _split(old), _split(new)
    _require_schema(spark, new_db)
    if db != new_db:
        raise ValueError("a table stays in its schema when renamed")
    spark.sql(f"ALTER TABLE `{db}`.`{table}` RENAME TO `{db}`.`{new_table}`")


def drop_table(spark: SparkSession, name: str) -> None:
    _require_table(spark, name)
    spark.sql(f"DROP TABLE {name}")


def truncate(spark: SparkSession, name: str) -> None:
    """Delete all rows."""
    _require_table(spark, name)
    spark.sql(f"TRUNCATE TABLE {name}")


def recreate(spark: SparkSession, name: str) -> None:
    """Truncate by dropping the table and creating it again with the same columns."""
    df = load_table(spark, name)
    schema = df.schema
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    drop_table(spark, name)
    create_table(spark, name, schema, partitions)


def add_column(spark: SparkSession, table: str, name: str, kind: str, doc: str | None = None) -> None:
    """New nullable column; rows written before read NULL."""
    if name in load_table(spark, table).columns:
        raise AlreadyExists(f"column {name} already exists")
    comment = f" COMMENT {_text(doc)}" if doc else ""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind}{comment})")


def with_column_added(df: DataFrame, name: str, kind: str) -> DataFrame:
    """The same for a DataFrame."""
    return df.withColumn(name, F.lit(None).cast(kind))
