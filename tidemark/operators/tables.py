"""Row changes on tables and the versioned parquet table that stores their result.

Parquet tables take no UPDATE, DELETE or MERGE, so a change is a new state computed
from the old one and written next to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lsn import LSN_DEFAULT
from tidemark.operators.running import id_block, with_row_number

CONTROL_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("last_lsn", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
])


class VersionedTable:
    """``<root>/<name>/v=<n>-<attempt>/`` parquet plus control rows.

    A commit writes the data, then one control row that names it; readers follow the
    newest control row. A write that dies half way is never named, so it stays
    invisible and can be repeated. The control row also carries the last LSN and the
    streaming batch id, which makes both change together with the data. One writer
    per table at a time.

    With ``buckets`` each version is also registered in the session catalog, hashed
    by ``bucket_keys`` into that many buckets. A merge on these keys then reads the
    table in place and shuffles the changes only.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, buckets: int = 0,
                 bucket_keys: Sequence[str] = (), schema: str = "default"):
        if buckets and not bucket_keys:
            raise ValueError("a bucketed table needs its bucket keys")
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.buckets, self.bucket_keys, self.schema = buckets, list(bucket_keys), schema

    def _catalog_name(self, path: str) -> str:
        version, attempt = path.rsplit("/v=", 1)[1].split("-")
        return f"`{self.schema}`.`{self.name}_v{version}_{attempt[:12]}`"

    @property
    def _control(self) -> str:
        return f"{self.root}/{self.name}/control"

    def history(self) -> DataFrame:
        """All control rows."""
        try:
            return self.spark.read.schema(CONTROL_SCHEMA).parquet(self._control)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], CONTROL_SCHEMA)

    def state(self) -> Row | None:
        """Control row of the newest version, None before the first write."""
        return self.history().orderBy(F.desc("version"), F.desc("written_at")).first()

    def load_state(self) -> str:
        """Last processed LSN, all zeros before the first load."""
        state = self.state()
        return state["last_lsn"] if state and state["last_lsn"] else LSN_DEFAULT

    def read(self) -> DataFrame:
        state = self.state()
        if state is None:
            raise ValueError(f"table {self.name} has no data")
        if self.buckets and self.spark.catalog.tableExists(self._catalog_name(state["path"])):
            return self.spark.table(self._catalog_name(state["path"]))
        return self.spark.read.parquet(state["path"])

    def write(self, df: DataFrame, last_lsn: str | None = None, batch_id: int | None = None,
              partition_by: Sequence[str] = ()) -> Row:
        """Write ``df`` as the next version. LSN and batch id carry over when not given."""
        old = self.state()
        version = (old["version"] if old else 0) + 1
        path = f"{self.root}/{self.name}/v={version}-{uuid.uuid4().hex}"
        writer = df.write.mode("error")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.buckets:
            (writer.bucketBy(self.buckets, *self.bucket_keys).sortBy(*self.bucket_keys).format("parquet")
             .option("path", path).saveAsTable(self._catalog_name(path)))
        else:
            writer.parquet(path)
        return self._commit(version, path, last_lsn, batch_id, old)

    def save_state(self, last_lsn: str) -> Row:
        """Move the LSN without new data."""
        old = self.state()
        if old is None:
            raise ValueError(f"table {self.name} has no data")
        return self._commit(old["version"] + 1, old["path"], last_lsn, None, old, old["row_count"])

    def rewrite(self, touching: DataFrame, apply: Callable[[DataFrame], DataFrame], last_lsn: str | None = None,
                batch_id: int | None = None) -> Row:
        """The next version is what ``apply`` makes of the rows; ``touching`` holds the keys it changes, which
        a table that is written whole has no use for."""
        return self.write(apply(self.read()), last_lsn, batch_id)

    def _commit(self, version, path, last_lsn, batch_id, old, rows: int | None = None) -> Row:
        if rows is None:
            rows = self.spark.read.parquet(path).count()
        control = self.spark.range(1).select(
            F.lit(self.name).alias("table"), F.lit(version).cast("bigint").alias("version"),
            F.lit(path).alias("path"),
            F.lit(last_lsn or (old["last_lsn"] if old else LSN_DEFAULT)).alias("last_lsn"),
            F.lit(rows).cast("bigint").alias("row_count"),
            F.lit(batch_id if batch_id is not None else (old["batch_id"] if old else None)).cast("bigint").alias("batch_id"),
            F.current_timestamp().alias("written_at"))
        control.coalesce(1).write.mode("append").parquet(self._control)
        return self.state()


def insert_rows(table: DataFrame, rows: DataFrame, identity: str | None = None, order: Sequence[str] = (),
                block: Column | None = None, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Append rows, filling the identity column and the defaults of absent or NULL columns.

    New ids continue from the largest one in ``order`` of the new rows. ``block`` must not
    decrease along the order; an integer first column of it makes its own blocks. Without
    either the new rows are numbered in one task, which suits literal rows.
    """
    new = rows
    for name, value in (defaults or {}).items():
        new = new.withColumn(name, F.coalesce(F.col(name), value) if name in new.columns else value)
    if identity:
        if block is None:
            whole = order and isinstance(new.schema[order[0]].dataType, T.IntegralType)
            block = id_block(order[0]) if whole else F.lit(0)
        number = with_row_number(new, "_n", list(order), block)
        top = table.agg(F.coalesce(F.max(identity), F.lit(0)).alias("m")).scalar()
        new = number.withColumn(identity, (F.col("_n") + top).cast(table.schema[identity].dataType)).drop("_n")
    for f in table.schema.fields:
        new = new.withColumn(f.name, (F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType))
    return table.unionByName(new.select(*table.columns))


def update_where(table: DataFrame, assign: Mapping[str, Column], cond: Column) -> DataFrame:
    """Rows matching ``cond`` take the new values; all see the old row."""
    return table.select(*[F.when(cond, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
                          for c in table.columns])


def delete_where(table: DataFrame, cond: Column) -> DataFrame:
    """Rows for which ``cond`` is true go; unknown counts as false."""
    return table.filter(~F.coalesce(cond, F.lit(False)))


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows whose key is new; the key must be unique within ``rows``."""
    fresh = rows.join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def kv_upsert(store: DataFrame, log: DataFrame, key: str = "key", seq: str = "seq", op: str = "op",
              delete_op: int = 1) -> DataFrame:
    """Key/value store after a log of writes; the last write of a key wins, a delete removes it."""
    last = log.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).filter("_r = 1")
    kept = store.join(last.select(key), key, "left_anti")
    return kept.unionByName(last.filter(F.col(op) != delete_op).select(*store.columns))


def kv_get(store: DataFrame, key_value: str, key: str = "key") -> DataFrame:
    return store.filter(F.col(key) == F.lit(key_value))


def kv_delete(store: DataFrame, key_value: str, key: str = "key") -> DataFrame:
    return store.filter(F.col(key) != F.lit(key_value))


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Attach the columns of a dimension, NULL for an unknown key. Catalyst broadcasts
    the dimension while it is below its size limit; AQE splits a hot key otherwise."""
    return df.join(dim, key, "left")


def lookup_update(dim: DataFrame, patch: DataFrame, key: str, value: str) -> DataFrame:
    """Patch the values of keys already present; other keys of the patch are ignored."""
    new = patch.select(key, F.col(value).alias("_new"))
    return dim.join(new, key, "left").select(
        *[F.coalesce("_new", value).alias(value) if c == value else F.col(c) for c in dim.columns])


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows that point to no parent; a NULL reference is allowed. The parent key is
    unique, so a parent that many children share is a hot key of one side only, which
    AQE splits."""
    return (child.filter(F.col(child_key).isNotNull())
            .join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti").select(*child.columns))


def fk_valid(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_semi").select(*child.columns)


def key_columns(change_tables: DataFrame, index_columns: DataFrame, instance: str) -> DataFrame:
    """Key column names of a capture instance from the two metadata tables."""
    ids = change_tables.filter(F.col("capture_instance") == instance).select("object_id")
    return index_columns.join(ids, "object_id", "left_semi").select("column_name")


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides and whether they agree."""
    both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
    n = both.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("source_rows"),
                 F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("target_rows"))
    return n.withColumn("status", F.when(F.col("source_rows") == F.col("target_rows"), "equal").otherwise("mismatch"))


def exists_flag(df: DataFrame, cond: Column, name: str = "found") -> DataFrame:
    """One row: is there any row that matches?"""
    return df.agg(F.coalesce(F.bool_or(cond), F.lit(False)).alias(name))


def write_ordered(df: DataFrame, path: str, asc: str, bucket_of: str, buckets: int = 4,
                  partition_by: Sequence[str] = ()) -> None:
    """Write with a sort order inside each file: a column ascending with NULLs first,
    then the hash bucket of another column descending with NULLs last."""
    bucket = F.when(F.col(bucket_of).isNotNull(), F.pmod(F.hash(bucket_of), F.lit(buckets)))
    ordered = df.sortWithinPartitions(*partition_by, F.col(asc).asc_nulls_first(), bucket.desc_nulls_last())
    writer = ordered.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
