"""Merging change logs: expected counts, both modes, properties, the demo scenario."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL, rows
from tidemark.functions import lsn
from tidemark.operators import cdc, sync
from tidemark.operators import tables as TB
from tidemark.operators.tables import VersionedTable
from tidemark.plans import changes as plans
from tidemark.plans.registry import Tables

SCHEMA = f"`{cdc.LSN}` STRING, `{cdc.SEQ}` INT, `{cdc.OP}` INT, k BIGINT, name STRING, amount DOUBLE"
ROW = "k BIGINT, name STRING, amount DOUBLE"


def at(n: int) -> str:
    return f"0x{n:020X}"


def log_of(spark, *changes):
    return spark.createDataFrame([(at(l), s, op, k, n, a) for l, s, op, k, n, a in changes], SCHEMA)


@pytest.fixture(scope="module")
def medium(spark):
    return Tables(spark, MEDIUM)


def counts(df, *by):
    return {tuple(r)[:-1] if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).count().collect()}


def test_expected_numbers(medium):
    base, chg = medium.fixture("base"), medium.fixture("chg")
    assert base.count() == 13500
    assert counts(chg, cdc.OP) == {1: 2300, 2: 1500, 3: 1500, 4: 2550}
    assert counts(plans.latest(medium), cdc.OP) == {1: 2300, 2: 1000, 4: 1800}
    merged = cdc.merge_cdc(base, chg, ["k"])
    assert merged.count() == 13300 == merged.select("k").distinct().count()
    assert merged.filter("amount IS NULL").count() == 750
    assert counts(merged, "status") == {"D": 750, "E": 750, "F": 3765, "N": 300, "O": 3829, "P": 3906}
    assert cdc.merge_cdc(base, plans.latest(medium), ["k"], "strict").count() == 14100
    kept = cdc.apply_cdc(base, chg, ["k"])
    assert (kept.count(), kept.filter("amount IS NULL").count()) == (13300, 0)


def test_strict_fails_on_two_changes_of_a_key(medium):
    with pytest.raises(Exception, match="more than one change for key"):
        cdc.merge_cdc(medium.fixture("base"), medium.fixture("chg"), ["k"], "strict").count()


def test_missing_keys(spark, medium):
    with pytest.raises(ValueError, match="Missing primary key columns"):
        cdc.merge_cdc(medium.fixture("base"), medium.fixture("chg"), ["nope"])
    with pytest.raises(ValueError, match="No primary key columns"):
        cdc.merge_cdc(medium.fixture("base"), medium.fixture("chg"), [])
    with pytest.raises(ValueError, match="No primary key columns"):
        lsn.merge_predicate_text([])
    assert lsn.merge_predicate_text(["a", "b"]) == "s.a = t.a AND s.b = t.b"


def test_modes_differ_where_they_should(spark):
    current = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], ROW)
    log = log_of(spark, (1, 1, 1, 9, "gone", 9.0), (2, 1, 4, 2, None, 5.0), (3, 1, 2, 3, "again", 3.5), (4, 1, 4, 7, "new", 7.0))
    correct = [(1, "a", 1.0), (2, None, 5.0), (3, "again", 3.5), (7, "new", 7.0)]
    assert rows(cdc.merge_cdc(current, log, ["k"])) == correct
    assert rows(cdc.merge_cdc(current, log, ["k"], broadcast_rows=10)) == correct
    assert rows(cdc.merge_cdc(current, log, ["k"], broadcast_rows=2)) == correct
    assert rows(cdc.merge_cdc(current, log, ["k"], "strict")) == correct + [(9, "gone", 9.0)]
    assert rows(cdc.apply_cdc(current, log, ["k"])) == [(1, "a", 1.0), (2, "b", 5.0), (3, "again", 3.5), (7, "new", 7.0)]
    # an insert of a known key is appended
    assert rows(cdc.apply_cdc(current, log, ["k"], "strict")) == [
        (1, "a", 1.0), (2, "b", 5.0), (3, "again", 3.5), (3, "c", 3.0), (7, "new", 7.0)]


@pytest.mark.parametrize("hot_rows", [10**9, 1])
def test_replay(spark, hot_rows):
    current = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], ROW)
    log = log_of(spark, (1, 1, 2, 1, "a2", 1.0), (2, 1, 2, 2, "b2", 1.0), (3, 1, 1, 2, "b2", 1.0), (4, 1, 2, 2, "b3", 1.0),
                 (5, 1, 4, 3, "c2", 1.0), (6, 1, 2, 3, "c3", 1.0), (7, 1, 3, 1, "x", 0.0))
    got = cdc.replay(current, log, ["k"], hot_rows)
    assert rows(got, "k", "name") == [(1, "a"), (1, "a2"), (2, "b3"), (3, "c2"), (3, "c3")]


def test_net_changes(spark):
    log = log_of(spark, (1, 1, 2, 1, "i", 1.0), (2, 1, 1, 1, "d", 1.0),                       # nothing
                 (1, 1, 2, 2, "i", 1.0), (2, 1, 3, 2, "i", 1.0), (2, 1, 4, 2, "u", 1.0),       # insert
                 (1, 1, 1, 3, "d", 1.0), (2, 1, 2, 3, "i", 1.0),                               # update
                 (1, 1, 3, 4, "o", 1.0), (1, 1, 4, 4, "u", 1.0), (2, 1, 1, 4, "u", 1.0),       # delete
                 (1, 1, 4, 5, "u", 1.0))
    got = cdc.net_changes(log, ["k"])
    assert rows(got, "k", F.col(f"`{cdc.OP}`"), "name") == [(2, 2, "u"), (3, 4, "i"), (4, 1, "u"), (5, 4, "u")]
    assert got.columns == log.columns


def random_log(spark, seed: int):
    """A well-formed log on keys 0-30, of which the even ones exist."""
    rnd = random.Random(seed)
    alive, out = set(range(0, 31, 2)), []
    for n in range(1, 200):
        k = rnd.randrange(31)
        if k not in alive:
            out.append((n, 1, 2, k, f"i{n}", float(n)))
            alive.add(k)
        elif rnd.random() < 0.3:
            out.append((n, 1, 1, k, "x", 0.0))
            alive.discard(k)
        else:
            out += [(n, 1, 3, k, "x", 0.0), (n, 1, 4, k, rnd.choice([None, f"u{n}"]), float(n))]
    current = spark.createDataFrame([(k, f"n{k}", float(k)) for k in range(0, 31, 2)], ROW)
    return current, log_of(spark, *out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_properties(spark, seed):
    current, log = random_log(spark, seed)
    state = rows(cdc.merge_cdc(current, log, ["k"]))
    # twice is once
    after = cdc.merge_cdc(current, log, ["k"])
    assert rows(cdc.merge_cdc(after, log, ["k"])) == state
    # in two parts
    first = cdc.merge_cdc(current, cdc.read_changes(log, at(0), at(90)), ["k"])
    assert rows(cdc.merge_cdc(first, cdc.read_changes(log, at(90), at(999), after=True), ["k"])) == state
    # the boundary read twice
    assert rows(cdc.merge_cdc(first, cdc.read_changes(log, at(90), at(999)), ["k"])) == state
    # net changes are enough, also for the strict form
    net = cdc.net_changes(log, ["k"])
    assert rows(cdc.merge_cdc(current, net, ["k"], "strict")) == state
    # row by row
    assert rows(cdc.replay(current, log, ["k"])) == state
    # captured from the two states
    captured = cdc.capture_changes(current, after, ["k"], at(1))
    assert rows(cdc.merge_cdc(current, captured, ["k"])) == state
    # by the separate steps, which keep a value where the update is NULL
    latest = cdc.latest_change(log.filter(f"`{cdc.OP}` <> 3"), ["k"])
    deletes, inserts, updates = cdc.split_ops(latest)
    stepped = cdc.apply_updates(cdc.apply_deletes(current, deletes, ["k"]), updates, ["k"])
    fresh = inserts.select("k", "name", "amount").join(stepped, "k", "left_anti")
    all_rows = TB.union_all(stepped.join(inserts.select("k"), "k", "left_anti"), inserts.select(*current.columns),
                            cdc.unmatched_updates(stepped, updates, ["k"]))
    assert fresh.count() <= inserts.count()
    assert rows(all_rows) == rows(cdc.apply_cdc(current, log, ["k"]))


def test_read_changes(spark):
    log = log_of(spark, (1, 1, 2, 1, "a", 1.0), (2, 1, 3, 1, "a", 1.0), (2, 1, 4, 1, "b", 1.0), (3, 1, 1, 1, "b", 1.0))
    assert cdc.read_changes(log, at(2), at(3)).count() == 2
    assert cdc.read_changes(log, at(2), at(3), after=True).count() == 1
    assert cdc.read_changes(log, at(1), at(3), row_filter="all update old").count() == 4
    with pytest.raises(ValueError, match="older than the change log"):
        cdc.read_changes(log, at(1), at(3), min_lsn=at(2))
    assert cdc.strip_meta(log).columns == ["k", "name", "amount"]


def test_lsn_range_reaches_the_scan(spark, folder, capsys):
    log_of(spark, (1, 1, 2, 1, "a", 1.0)).write.parquet(f"{folder}/log")
    cdc.read_changes(spark.read.parquet(f"{folder}/log"), at(1), at(5)).explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(`__$start_lsn`" in pushed and "LessThanOrEqual(`__$start_lsn`" in pushed


def test_stored_log_is_pruned_by_folder(spark, folder, capsys):
    log = log_of(spark, *[(i << 48, 1, 2, i, f"n{i}", 1.0) for i in range(1, 6)])
    cdc.write_changes(log, f"{folder}/log")
    stored = spark.read.parquet(f"{folder}/log")
    got = cdc.read_changes(stored, at(2 << 48), at(4 << 48))
    assert got.columns == log.columns and rows(got, "k") == [(2,), (3,), (4,)]
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(log_file" in plan and "(log_file" in plan


def test_latest_change_prunes_before_the_shuffle(medium, capsys):
    cdc.latest_change(medium.fixture("chg"), ["k"]).explain()
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_small_change_set_leaves_the_target_unshuffled(spark, medium, capsys):
    base = medium.fixture("base")
    cdc.merge_cdc(base, medium.fixture("chg"), ["k"], broadcast_rows=100_000).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hash" not in plan


def test_large_change_set_is_not_broadcast(spark, medium, capsys, monkeypatch):
    base = medium.fixture("base")
    monkeypatch.setattr(cdc, "BROADCAST_BYTES", 1000)
    cdc.merge_cdc(base, medium.fixture("chg"), ["k"], broadcast_rows=100_000).explain()
    assert "FullOuter" in capsys.readouterr().out


def test_merge_statement():
    text = cdc.merge_statement("lake.orders", "changes", ["k"], ["k", "name"])
    assert text == (
        "MERGE INTO lake.orders AS t USING changes AS s ON s.k = t.k "
        "WHEN MATCHED AND s.`__$operation` = 1 THEN DELETE "
        "WHEN MATCHED AND s.`__$operation` IN (2, 4) THEN UPDATE SET t.`k` = s.`k`, t.`name` = s.`name` "
        "WHEN NOT MATCHED AND s.`__$operation` <> 1 THEN INSERT (`k`, `name`) VALUES (s.`k`, s.`name`)")
    assert "NOT MATCHED THEN INSERT" in cdc.merge_statement("t", "s", ["k"], ["k"], "strict")


def test_merge_into_is_refused_by_a_parquet_table(spark, folder):
    spark.sql(f"CREATE TABLE merge_target ({ROW}) USING parquet LOCATION '{folder}/t'")
    with pytest.raises(Exception, match="(?i)merge into|unsupported"):
        cdc.merge_into("merge_target", log_of(spark, (1, 1, 2, 1, "a", 1.0)), ["k"])
    spark.sql("DROP TABLE merge_target")


def test_lsn_functions(spark):
    df = spark.createDataFrame([("0x0000004400000d280005",), ("0000004400000D280005",), ("0x12",), (None,), ("",)], "h STRING")
    got = df.select("h", F.hex(lsn.lsn_bin("h")).alias("b"), lsn.lsn_hex(lsn.lsn_bin("h")).alias("back")).collect()
    assert [r["b"] for r in got] == ["0000004400000D280005"] * 2 + ["0" * 20] * 3
    assert got[0]["back"] == "0x0000004400000D280005"
    assert df.select(lsn.lsn_hex(F.lit(None).cast("binary")).alias("x")).first()["x"] == lsn.LSN_DEFAULT
    with pytest.raises(Exception, match="No primary key columns found"):
        spark.sql("SELECT CAST(array() AS array<string>) AS ks").select(lsn.merge_predicate("ks")).collect()


def test_envelope(spark):
    bodies = [
        '{"before":null,"after":{"k":1,"name":"a","amount":1.5},"op":"c","source":{"table":"t","ts_ns":1,"db":"m"}}',
        '{"before":{"k":1,"name":"a","amount":1.5},"after":{"k":1,"name":null,"amount":2},"op":"u","source":{"table":"t","ts_ns":2,"db":"m"}}',
        '{"before":{"k":2,"name":"b","amount":2},"after":null,"op":"d","source":{"table":"t","ts_ns":3,"db":"m"}}',
        None]
    broken = spark.createDataFrame([('{"op":',), ('{"op":"t"}',), ('{"after":{"k":7}}',), ('{"op":"d","after":{"k":7}}',)], "body STRING")
    assert [r["__error"] for r in cdc.flatten_envelope(broken, "body", ROW).collect()] == ["malformed", "no row", "malformed", "no row"]
    assert cdc.soft_delete_view(cdc.flatten_envelope(broken, "body", ROW), ["k"]).count() == 0
    flat = cdc.flatten_envelope(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i INT, body STRING"), "body", ROW)
    assert rows(flat.drop("i")) == rows(spark.createDataFrame(
        [(1, "a", 1.5, "c", "t", 1, "m", "false", None), (1, None, 2.0, "u", "t", 2, "m", "false", None),
         (2, "b", 2.0, "d", "t", 3, "m", "true", None), (None,) * 9], flat.drop("i").schema))
    assert rows(cdc.soft_delete_view(flat, ["k"]), "k", "name", "amount") == [(1, None, 2.0)]


# --- the demo scenario: fixed values, whose result is worked out in FIXTURES.md -----------

CUSTOMERS = "CustomerID INT, FirstName STRING, LastName STRING, Email STRING, CreatedDate TIMESTAMP, UpdatedDate TIMESTAMP"
ORDERS = "OrderID INT, CustomerID INT, OrderDate TIMESTAMP, TotalAmount DECIMAL(10,2), Status STRING"
NOW = datetime(2025, 3, 31, 7, 0)


def people(spark, *names):
    data = [(i, f, l, f"{f}.{l}@example.com".lower()) for i, (f, l) in enumerate(names)]
    return spark.createDataFrame(data, "n INT, FirstName STRING, LastName STRING, Email STRING")


def orders(spark, *items):
    return spark.createDataFrame([(i, c, a, s) for i, (c, a, s) in enumerate(items)],
                                 "n INT, CustomerID INT, TotalAmount STRING, Status STRING")


class Scenario:
    """A source database: states of the two tables and their change logs."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.commits = spark, folder, 0
        self.customers = spark.createDataFrame([], CUSTOMERS)
        self.orders = spark.createDataFrame([], ORDERS)
        self.logs = {"Customers": None, "Orders": None}

    def add_customers(self, *names):
        return TB.insert_rows(self.customers, people(self.spark, *names), "CustomerID", ["n"],
                              defaults={"CreatedDate": F.lit(NOW), "UpdatedDate": F.lit(NOW)})

    def add_orders(self, *items):
        return TB.insert_rows(self.orders, orders(self.spark, *items), "OrderID", ["n"], defaults={"OrderDate": F.lit(NOW)})

    def commit(self, customers=None, orders=None):
        self.commits += 1
        for name, key, new in (("Customers", "CustomerID", customers), ("Orders", "OrderID", orders)):
            if new is None:
                continue
            old = getattr(self, name.lower())
            made = cdc.capture_changes(old, new, [key], at(self.commits))
            path = f"{self.folder}/{name}/{self.commits}"
            new.write.parquet(f"{path}/state")
            made.write.parquet(f"{path}/log")
            setattr(self, name.lower(), self.spark.read.schema(old.schema).parquet(f"{path}/state"))
            part = self.spark.read.schema(made.schema).parquet(f"{path}/log")
            self.logs[name] = part if self.logs[name] is None else self.logs[name].unionByName(part)

    def sources(self):
        return {"Customers": sync.Source(lambda: self.customers, lambda: self.logs["Customers"], ["CustomerID"]),
                "Orders": sync.Source(lambda: self.orders, lambda: self.logs["Orders"], ["OrderID"])}


def test_scenario(spark, folder):
    s = Scenario(spark, folder)
    s.commit(customers=s.add_customers(("John", "Smith"), ("Jane", "Doe"), ("Bob", "Johnson"), ("Alice", "Williams"), ("Charlie", "Brown")),
             orders=s.add_orders((1, "125.50", "Completed"), (2, "89.99", "Processing"), (3, "45.25", "Shipped"),
                                 (1, "250.00", "Pending"), (4, "75.30", "Completed")))
    lake = {n: VersionedTable(spark, f"{folder}/lake", n) for n in ("Customers", "Orders")}

    def run():
        return sync.sync_all({n: (lake[n], src) for n, src in s.sources().items()})

    assert lake["Customers"].load_state() == lsn.LSN_DEFAULT
    assert [(r.action, r.rows) for r in run().values()] == [("full", 5), ("full", 5)]
    assert {r["CustomerID"] for r in lake["Customers"].read().collect()} == {1, 2, 3, 4, 5}
    assert [(r.action, r.version) for r in run().values()] == [("unchanged", 1), ("unchanged", 1)]

    # new rows, updates and a delete
    s.commit(customers=s.add_customers(("Michael", "Taylor"), ("Sarah", "Johnson"), ("David", "Miller"), ("Emma", "Wilson"), ("Thomas", "Anderson")),
             orders=s.add_orders((3, "199.99", "Shipped"), (5, "67.50", "Processing"), (2, "145.75", "Completed"),
                                 (4, "320.00", "Pending"), (6, "88.25", "Processing"), (7, "150.49", "Completed"),
                                 (8, "210.75", "Shipped"), (9, "45.99", "Pending"), (10, "175.25", "Processing")))
    assert s.orders.count() == 14
    s.commit(customers=TB.update_where(s.customers, {"Email": F.lit("john.smith.updated@example.com")},
                                       (F.col("FirstName") == "John") & (F.col("LastName") == "Smith")),
             orders=TB.update_where(s.orders, {"Status": F.lit("Delivered")}, F.col("Status") == "Shipped"))
    s.commit(orders=TB.delete_where(s.orders, (F.col("CustomerID") == 5) & (F.col("TotalAmount") < 70)))
    got = run()
    assert [(r.action, r.rows) for r in got.values()] == [("merged", 10), ("merged", 13)]
    assert lake["Customers"].read().filter("CustomerID = 1").first()["Email"] == "john.smith.updated@example.com"
    assert counts(lake["Orders"].read(), "Status") == {"Delivered": 3, "Completed": 4, "Processing": 3, "Pending": 3}

    # second script: a new customer, and the delete of one who has an order
    s.commit(customers=s.add_customers(("Brave", "Sunny")))
    assert s.customers.filter("CustomerID = 11").count() == 1
    gone = (F.col("FirstName") == "Sarah") & (F.col("LastName") == "Johnson")
    enforced = s.customers.filter(gone).join(s.orders, "CustomerID", "left_semi").count()
    assert enforced == 1  # with the key enforced the delete fails and 11 rows stay
    s.commit(customers=TB.delete_where(s.customers, gone))
    assert [(r.action, r.rows) for r in run().values()] == [("merged", 10), ("unchanged", 13)]
    orphans = TB.fk_violations(lake["Orders"].read(), lake["Customers"].read(), "CustomerID", "CustomerID")
    assert rows(orphans, "CustomerID") == [(7,)]

    # delete all
    s.commit(customers=s.customers.limit(0), orders=s.orders.limit(0))
    assert [(r.action, r.rows) for r in run().values()] == [("merged", 0), ("merged", 0)]
    assert [r["version"] for r in lake["Customers"].history().orderBy("version").collect()] == [1, 2, 3, 4]


def test_sync_errors(spark, folder):
    table = VersionedTable(spark, folder, "t")
    with pytest.raises(ValueError, match="capture is not enabled"):
        sync.sync(table, sync.Source(lambda: None, None, ["k"]))
    with pytest.raises(ValueError, match="has no data"):
        table.read()
    with pytest.raises(ValueError, match="has no data"):
        table.save_state(at(1))
    current, log = random_log(spark, 5)
    table.write(current, last_lsn=at(3))
    with pytest.raises(ValueError, match="older than the change log"):
        sync.sync(table, sync.Source(lambda: current, lambda: log, ["k"], min_lsn=at(50)))
    assert table.save_state(at(999))["last_lsn"] == at(999)
    assert sync.sync(table, sync.Source(lambda: current, lambda: log, ["k"])).action == "unchanged"
    assert table.read().count() == current.count()


def test_a_failed_write_stays_invisible(spark, folder):
    table = VersionedTable(spark, folder, "t")
    current, _ = random_log(spark, 6)
    table.write(current)
    with pytest.raises(Exception, match="boom"):
        table.write(current.withColumn("name", F.raise_error(F.lit("boom")).cast("string")))
    assert table.state()["version"] == 1 and rows(table.read()) == rows(current)
    table.write(current.limit(3))
    assert table.state()["version"] == 2 and table.read().count() == 3


def test_bucketed_table_is_merged_in_place(spark, medium, folder, capsys):
    base, chg = medium.fixture("base"), medium.fixture("chg")
    table = VersionedTable(spark, folder, "orders", buckets=4, bucket_keys=["k"])
    table.write(base)
    merged = cdc.merge_cdc(table.read(), chg, ["k"])
    merged.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1  # the changes
    table.write(merged)
    assert rows(table.read()) == rows(cdc.merge_cdc(base, chg, ["k"]))
    assert table.read().inputFiles() and len(table.read().inputFiles()) <= 4
    # another session without the catalog entry still reads the files
    assert VersionedTable(spark, folder, "orders").read().count() == 13300
    with pytest.raises(ValueError, match="bucket keys"):
        VersionedTable(spark, folder, "orders", buckets=4)


def test_bounds_of_a_range_in_any_case(spark):
    log = spark.createDataFrame([("0x0000000000000000ABCD", 2, 1)], "`__$start_lsn` STRING, `__$operation` INT, k INT")
    assert cdc.read_changes(log, "0x0000000000000000abcd", "0X0000000000000000abce").count() == 1
    with pytest.raises(ValueError):
        cdc.read_changes(log, "0xabcd", "0x0000000000000000abce")


def test_columns_only_the_changes_have(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    changes = spark.createDataFrame([("0x01", "0x01", 4, 1, "c", 9)], "`__$start_lsn` STRING, `__$seqval` STRING, `__$operation` INT, k INT, v STRING, w INT")
    with pytest.raises(ValueError, match="w"):
        cdc.merge_cdc(target, changes, ["k"])
    got = cdc.merge_cdc(target, changes, ["k"], new_columns="add")
    assert rows(got, "k", "v", "w") == [(1, "c", 9), (2, "b", None)]


def test_a_target_with_repeated_keys_does_not_grow_the_broadcast(spark):
    target = spark.range(3000).select((F.col("id") % 3).alias("k"), F.lit("n").alias("name"), F.col("id").cast("double").alias("amount"))
    log = log_of(spark, (1, 1, cdc.AFTER, 1, "new", 1.0), (2, 1, cdc.INSERT, 9, "nine", 9.0))
    small = cdc.merge_cdc(target, log, ["k"], broadcast_rows=100)
    assert rows(small) == rows(cdc.merge_cdc(target, log, ["k"]))
    assert small.filter("k = 9").count() == 1 and small.filter("k = 1 AND name = 'new'").count() == 1000
