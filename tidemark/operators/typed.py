"""Log envelopes whose rows have no known schema: kept whole as VARIANT, landed in tables that derive it.

A table's columns come from the data: integers become BIGINT, other numbers DOUBLE, and a column of several
kinds, or of nulls only, STRING. A later batch may add columns or widen them. Every batch is stored in the
schema it was written with, and read as the widest.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def open_envelope(messages: DataFrame, body: str = "body") -> DataFrame:
    """Other columns, then ``row`` (VARIANT, all fields of the row after the change, or before a delete), ``__op``,
    ``__table``, ``__source_ts_ns``, ``__db``, ``__deleted``, ``__error``.

    Tombstones and errors are marked as by ``cdc.flatten_envelope``; no schema is needed and no field is lost.
    """
    others = [c for c in messages.columns if c != body]
    e = messages.select(*others, F.col(body).alias("_body"), F.try_parse_json(body).alias("_e"))
    get = lambda path, kind: F.try_variant_get("_e", f"$.{path}", kind)
    e = e.select(*others, "_body", get("op", "string").alias("__op"), get("before", "variant").alias("_before"), get("after", "variant").alias("_after"),
                 get("source.table", "string").alias("__table"), get("source.ts_ns", "bigint").alias("__source_ts_ns"),
                 get("source.db", "string").alias("__db"))
    row = F.when(F.col("__op") == "d", F.col("_before")).when(F.col("__op").isNotNull(), F.col("_after"))
    row = F.when(F.schema_of_variant(row).startswith("OBJECT"), row)
    e = e.withColumn("row", row)
    deleted = F.when(F.col("__op") == "d", "true").when(F.col("__op").isNotNull(), "false")
    error = F.when(F.col("_body").isNotNull() & F.col("__op").isNull(), "malformed").when(F.col("__op").isNotNull() & F.col("row").isNull(), "no row")
    return e.select(*others, "row", "__op", "__table", "__source_ts_ns", "__db", deleted.alias("__deleted"), error.alias("__error"))


def settled(kind: T.DataType) -> T.DataType:
    """The type that a derived type is stored as."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, settled(f.dataType)) for f in kind.fields]) if kind.fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(settled(kind.elementType))
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    if isinstance(kind, T.NumericType):
        return T.DoubleType()
    return T.BooleanType() if isinstance(kind, T.BooleanType) else T.StringType()


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of two settled types."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        new = {f.name: f.dataType for f in b.fields}
        fields = [T.StructField(f.name, widest(f.dataType, new[f.name]) if f.name in new else f.dataType) for f in a.fields]
        return T.StructType([*fields, *[T.StructField(n, k) for n, k in new.items() if n not in a.names]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType))
    return T.DoubleType() if isinstance(a, T.NumericType) and isinstance(b, T.NumericType) else T.StringType()


def _derived(text: str) -> T.StructType:
    return settled(T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING")))


def _as(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A stored column in a wider type."""
    if old == new:
        return value
    nested = (T.StructType, T.ArrayType)
    if isinstance(old, nested):
        text = F.to_json(value)
        return F.from_json(text, new) if isinstance(new, nested) else text
    return value.cast(new)


class TypedTables:
    """``<root>/data/table=<name>/schema=<n>/batch=<id>/`` parquet, and ``<root>/schemas``: one row per table and schema.

    A batch that is landed again replaces itself. One writer at a time.
    """

    META = ("__op", "__table", "__source_ts_ns", "__db", "__deleted")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def schemas(self) -> dict[str, list[T.StructType]]:
        """Per table its schemas, each as wide as the one before or wider. The driver holds them: one row per table and change of schema."""
        try:
            rows = self.spark.read.schema("table STRING, n INT, schema STRING").parquet(f"{self.root}/schemas").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        out: dict[str, list[T.StructType]] = {}
        for r in sorted(rows, key=lambda r: (r["table"], r["n"])):
            if r["n"] == len(out.get(r["table"], [])):
                out.setdefault(r["table"], []).append(T.StructType.fromJson(json.loads(r["schema"])))
        return out

    def land(self, log: DataFrame, batch: int | str, name: Column) -> dict[str, int]:
        """Append the rows of opened envelopes (``open_envelope``) to the tables ``name`` says; the number of each table's schema.

        The batch is read once and split by table; tombstones, errors and rows without a table go to ``<root>/rest``.
        """
        staged, rest = f"{self.root}/staged/batch={batch}", f"{self.root}/rest/batch={batch}"
        log = log.withColumn("table", name)
        whole = F.col("row").isNotNull() & F.col("table").isNotNull()
        kept = [c for c in log.columns if c not in ("row", "table")]
        log.select(*kept, "table", "row", whole.alias("whole")).write.mode("overwrite").partitionBy("whole", "table").parquet(staged)
        kind = T.StructType([*[f for f in log.schema.fields if f.name in kept], T.StructField("row", T.VariantType()),
                             T.StructField("whole", T.BooleanType()), T.StructField("table", T.StringType())])
        stored = self.spark.read.schema(kind).parquet(staged)
        stored.filter("NOT whole").drop("whole", "row", "table").write.mode("overwrite").parquet(rest)
        found = stored.filter("whole").groupBy("table").agg(F.schema_of_variant_agg("row").alias("s")).collect()  # one row per table
        known, used = self.schemas(), {}
        for r in found:
            table, before = r["table"], known.get(r["table"], [])
            new = _derived(r["s"])
            now = widest(before[-1], new) if before else new
            if not before or now != before[-1]:
                self.spark.createDataFrame([(table, len(before), json.dumps(now.jsonValue()))], "table STRING, n INT, schema STRING").coalesce(1).write.mode(
                    "append").parquet(f"{self.root}/schemas")
                before = [*before, now]
            used[table] = len(before) - 1
            rows = stored.filter(F.col("whole") & (F.col("table") == table))
            typed = rows.select(F.variant_get("row", "$", now.simpleString()).alias("row"), *kept)
            (typed.select("row.*", *[F.col(c) for c in kept if c not in now.names])
             .write.mode("overwrite").parquet(f"{self.root}/data/{table}/schema={used[table]}/batch={batch}"))
        return used

    def read(self, table: str) -> DataFrame:
        """All rows of a table in its widest schema; columns that a batch did not have are NULL."""
        versions = self.schemas().get(table)
        if not versions:
            raise ValueError(f"table {table} has no data")
        last, out = versions[-1], None
        for n, schema in enumerate(versions):
            try:
                rows = self.spark.read.option("basePath", f"{self.root}/data/{table}").parquet(f"{self.root}/data/{table}/schema={n}")
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            old = {f.name: f.dataType for f in schema.fields}
            meta = [c for c in rows.columns if c not in old and c not in ("schema", "batch")]
            part = rows.select(*[(_as(F.col(f"`{f.name}`"), old[f.name], f.dataType) if f.name in old else F.lit(None).cast(f.dataType)).alias(f.name)
                                 for f in last.fields], *meta)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out


def land_batches(tables: TypedTables, body: str, name: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that lands the envelopes of a stream."""
    return lambda batch, batch_id: tables.land(open_envelope(batch, body), batch_id, name()) and None
