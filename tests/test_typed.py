"""Envelopes without a given schema, and tables that derive and widen theirs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import typed


def bodies(spark, *rows_):
    return spark.createDataFrame([(b if b is None or isinstance(b, str) else json.dumps(b),) for b in rows_], "body STRING")


def change(table, after, op="c", before=None):
    return {"op": op, "before": before, "after": after, "source": {"table": table, "ts_ns": 5, "db": "main"}}


def test_open_envelope(spark):
    opened = typed.open_envelope(bodies(spark, change("t", {"a": 1, "deep": {"x": [1, 2]}}), change("t", None, "d", {"a": 2}), None, "{bad", "{}", "[1]",
                                        change("t", None), change("t", 5), change("t", None, "d")))
    got = opened.select(F.to_json("row").alias("row"), "__op", "__table", "__source_ts_ns", "__db", "__deleted", "__error").collect()
    said = [(r.row and json.loads(r.row), r["__op"], r["__deleted"], r["__error"]) for r in got]
    assert said == [({"a": 1, "deep": {"x": [1, 2]}}, "c", "false", None), ({"a": 2}, "d", "true", None), (None, None, None, None),
                    (None, None, None, "malformed"), (None, None, None, "malformed"), (None, None, None, "malformed"),
                    (None, "c", "false", "no row"), (None, "c", "false", "no row"), (None, "d", "true", "no row")]
    assert {(r["__table"], r["__source_ts_ns"], r["__db"]) for r in got[:2]} == {("t", 5, "main")}


def test_two_tables_of_changing_schema_land_typed(spark, folder):
    tables = typed.TypedTables(spark, folder)
    first = bodies(spark, change("orders", {"id": 1, "price": 5, "tags": ["a"]}), change("orders", {"id": 2, "price": 6, "tags": []}),
                   change("users", {"name": "x", "gone": None}), None, "{bad", change(None, {"lost": 1}))
    second = bodies(spark, change("orders", {"id": 3, "price": 7.25, "new": {"x": True}}), change("users", {"name": 9, "gone": 1}))
    third = bodies(spark, change("orders", {"id": "four", "new": {"x": False, "y": 1}}), change("orders", None, "d", {"id": 1}))
    name = F.col("__table")
    assert tables.land(typed.open_envelope(first), 0, name) == {"orders": 0, "users": 0}
    assert tables.read("orders").schema["price"].dataType == T.LongType() and tables.read("users").schema["gone"].dataType == T.StringType()
    assert tables.land(typed.open_envelope(second), 1, name) == {"orders": 1, "users": 1} or tables.schemas()["users"][-1]["name"].dataType == T.StringType()
    tables.land(typed.open_envelope(third), 2, name)
    orders = tables.read("orders")
    kinds = {f.name: f.dataType for f in orders.schema.fields}
    assert (kinds["id"], kinds["price"], kinds["new"]) == (T.StringType(), T.DoubleType(), T.StructType.fromDDL("x BOOLEAN, y BIGINT"))
    got = [(r.id, r.price, r.tags, r.new and tuple(r.new), r["__op"]) for r in orders.orderBy("__op", "id").collect()]
    assert got == [("1", 5.0, ["a"], None, "c"), ("2", 6.0, [], None, "c"), ("3", 7.25, None, (True, None), "c"), ("four", None, None, (False, 1), "c"),
                   ("1", None, None, None, "d")]
    assert rows(tables.read("users"), "name", "gone") == [("9", "1"), ("x", None)]
    rest = spark.read.parquet(f"{folder}/rest/batch=0")
    assert sorted((r["__error"], r["__table"]) for r in rest.collect() if r["__error"]) == [("malformed", None)] and rest.count() == 3
    before = rows(orders)
    tables.land(typed.open_envelope(third), 2, name)  # the batch again
    assert rows(tables.read("orders")) == before and len(tables.schemas()["orders"]) == 3


def test_stream_lands_batches(spark, folder):
    from tidemark.streaming import core as ST
    bodies(spark, *[change(f"t{i % 2}", {"id": i, f"c{i % 3}": i}) for i in range(12)]).write.parquet(f"{folder}/in")
    tables = typed.TypedTables(spark, f"{folder}/lake")
    for state in ("a", "b"):  # delivered twice
        ST.run_available(spark.readStream.schema("body STRING").parquet(f"{folder}/in"), f"{folder}/{state}", typed.land_batches(tables, "body", lambda: F.col("__table")))
    assert sorted(r.id for t in ("t0", "t1") for r in tables.read(t).collect()) == list(range(12))
    assert tables.read("t0").columns[:4] == ["c0", "c1", "c2", "id"]


def test_widest():
    ddl = lambda text: T.DataType.fromDDL(text)
    both = typed.widest(ddl("a BIGINT, b STRUCT<x: BIGINT>, c ARRAY<BIGINT>, d STRING"), ddl("a DOUBLE, b STRUCT<y: BOOLEAN>, c ARRAY<DOUBLE>, e BIGINT, d BIGINT"))
    assert both == ddl("a DOUBLE, b STRUCT<x: BIGINT, y: BOOLEAN>, c ARRAY<DOUBLE>, d STRING, e BIGINT")
    assert typed.widest(ddl("a STRUCT<x: BIGINT>"), ddl("a BIGINT")) == ddl("a STRING")


def test_no_data(spark, folder):
    tables = typed.TypedTables(spark, folder)
    assert tables.land(typed.open_envelope(bodies(spark, None).limit(0)), 0, F.col("__table")) == {}
    with pytest.raises(ValueError, match="no data"):
        tables.read("orders")
