"""Tables in parts by the hash of the key: a change rewrites what it touches, and only that."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import cdc, sync
from tidemark.operators.hashed import PART, HashedTable
from tidemark.plans.registry import Tables
from tidemark.streaming import core as ST

LOG = f"`{cdc.LSN}` STRING, `{cdc.SEQ}` INT, `{cdc.OP}` INT, k INT, name STRING"


def lsn(n):
    return f"0x{n:020X}"


def files(table):
    """Data files by part, with their times."""
    found = {}
    for folder, _, names in os.walk(table.state()["path"]):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(folder.rsplit("=", 1)[-1], {})[name] = os.stat(f"{folder}/{name}").st_mtime_ns
    return found


@pytest.fixture
def table(spark, folder):
    table = HashedTable(spark, folder, "t", ["k"], 16)
    table.write(spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")), lsn(1))
    return table


def parts(table, keys):
    df = table.spark.createDataFrame([(k,) for k in keys], "k INT")
    return {str(r[0]) for r in df.select(table.part_of(table.stored_schema())).collect()}


def changed(spark, *changes):
    return spark.createDataFrame([(lsn(l), 1, op, k, n) for l, op, k, n in changes], LOG)


def source(log):
    return sync.Source(lambda: None, lambda: log, ["k"])


def test_other_files_stay(spark, table):
    before = files(table)
    assert len(before) == 16
    log = changed(spark, (2, cdc.AFTER, 7, "seven"), (3, cdc.DELETE, 500, None), (4, cdc.INSERT, 5000, "new"), (5, cdc.DELETE, 9999, None))
    got = sync.sync(table, source(log))
    assert (got.action, got.rows, got.last_lsn, got.version) == ("merged", 1000, lsn(5), 2)
    touched, after = parts(table, [7, 500, 5000, 9999]), files(table)
    assert {p for p in before if before[p] != after[p]} == touched and len(touched) < 16
    want = {i: f"n{i}" for i in range(1000) if i != 500} | {7: "seven", 5000: "new"}
    assert dict(rows(table.read())) == want
    assert sync.sync(table, source(log)).action == "unchanged" and files(table) == after


def test_the_scan_is_pruned(table):
    plan = table.read([3, 4])._jdf.queryExecution().executedPlan().toString()
    assert PART in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_part_may_lose_all_rows(spark, table):
    gone = [r.k for r in table.read([2]).collect()]
    sync.sync(table, source(changed(spark, *[(2, cdc.DELETE, k, None) for k in gone])))
    assert table.read([2]).count() == 0 and table.read().count() == 1000 - len(gone) == table.state()["row_count"]
    sync.sync(table, source(changed(spark, (3, cdc.INSERT, gone[0], "back"))))
    assert rows(table.read([2])) == [(gone[0], "back")]


def test_new_columns_are_null_in_other_parts(spark, table):
    batch = changed(spark, (2, cdc.AFTER, 7, "seven")).withColumn("extra", F.lit(1.5))
    ST.merge_batch(table, ["k"])(batch, 0)
    assert table.read().columns == ["k", "name", "extra"]
    assert {(r.k, r.extra) for r in table.read().collect() if r.extra is not None} == {(7, 1.5)} and table.read().count() == 1000
    ST.merge_batch(table, ["k"])(batch.withColumn("name", F.lit("twice")), 0)  # the same batch again
    assert table.state()["version"] == 2 and table.read().filter("name = 'twice'").count() == 0


@pytest.mark.parametrize("step", ["_note", "_exchange", "_commit"])
def test_a_driver_that_dies_on_the_way(spark, table, monkeypatch, step):
    log = changed(spark, (2, cdc.AFTER, 7, "seven"), (3, cdc.DELETE, 500, None))

    def dies(*args, **kwargs):
        raise KeyboardInterrupt
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(HashedTable, step, dies)
        sync.sync(table, source(log))
    again = HashedTable(spark, table.root, "t", ["k"], 16)
    assert again.state()["version"] == (1 if step == "_note" else 2)
    sync.sync(again, source(log))
    assert dict(rows(again.read())) == {i: f"n{i}" for i in range(1000) if i != 500} | {7: "seven"}
    assert again.state()["last_lsn"] == lsn(3) and again.state()["row_count"] == 999


def test_rows_that_leave_the_touched_parts_fail(spark, table):
    keys = spark.createDataFrame([(1,)], "k INT")
    with pytest.raises(Exception, match="left the parts"):
        table.rewrite(keys, lambda current: current.withColumn("k", F.col("k") + 1))
    assert table.read().count() == 1000


def test_edges(spark, folder, table):
    assert table.rewrite(spark.createDataFrame([], "k INT"), lambda current: current, lsn(9))["last_lsn"] == lsn(9)
    empty = HashedTable(spark, folder, "e", ["k"], 4)
    with pytest.raises(ValueError, match="no data"):
        empty.read()
    with pytest.raises(ValueError, match="full load"):
        empty.rewrite(spark.createDataFrame([], "k INT"), lambda current: current)
    with pytest.raises(ValueError, match="keys"):
        HashedTable(spark, folder, "x", [])
    empty.write(table.read().limit(0))
    assert empty.read().count() == 0 == empty.state()["row_count"]
    ST.merge_batch(empty, ["k"])(changed(spark, (2, cdc.INSERT, 1, "one")), 0)
    assert rows(empty.read()) == [(1, "one")]


def test_equals_the_table_that_is_written_whole(spark, folder):
    t = Tables(spark, SMALL)
    table = HashedTable(spark, folder, "orders", ["k"], 8)
    table.write(t.fixture("base"), lsn(1))
    sync.sync(table, sync.Source(lambda: t.fixture("base"), lambda: t.fixture("chg"), ["k"]))
    assert rows(table.read()) == rows(cdc.merge_cdc(t.fixture("base"), t.fixture("chg"), ["k"]))
