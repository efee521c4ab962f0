"""File formats, stored tables and their synchronisation, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import catalog, cdc, regression, sync, tables
from tidemark.operators.hashed import HashedTable
from tidemark.operators.running import id_block
from tidemark.operators.tables import VersionedTable
from tidemark.plans import changes, series
from tidemark.plans.basics import scratch
from tidemark.plans.registry import ORACLES, query
from tidemark.plans.streams import streams
from tidemark.sources import files
from tidemark.streaming import core as ST
from tidemark.streaming import replay

CUSTOMER = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                         T.StructField("c_acctbal", T.DoubleType())])
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer"


def customers(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal")


def csv_copy(t, name: str):
    path = scratch(t.spark, name)
    files.write_csv(customers(t), path)
    return files.read_csv(t.spark, path, CUSTOMER)


@query("s4", CUSTOMER_SQL)
def s4(t):
    return csv_copy(t, "s4")


@query("s15", CUSTOMER_SQL)
def s15(t):
    return csv_copy(t, "s15")


@query("s5", "SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(len(embedding) AS INTEGER) AS n FROM embeddings")
def s5(t):
    path = scratch(t.spark, "s5")
    files.write_json(t.embeddings.select("vec_id", F.struct("label", "embedding").alias("code")), path)
    docs = files.read_json_lines(t.spark, path, "vec_id BIGINT, code STRUCT<label: INT, embedding: ARRAY<FLOAT>>")
    return docs.select("vec_id", "code.label", F.col("code.embedding")[0].cast("double").alias("first_value"),
                       F.size("code.embedding").alias("n"))


@query("s16", "SELECT event_type, user_id, event_id, value FROM events")
def s16(t):
    path = scratch(t.spark, "s16")
    rows = t.events.select("event_type", "event_id", "user_id", "value")
    files.write_json(rows, path, ["event_type"])
    return t.spark.read.schema(rows.schema).json(path).select("event_type", "user_id", "event_id", "value")


@query("s8", "SELECT n_nationkey AS id, n_name AS value, 'region' || n_regionkey AS item FROM nation")
def s8(t):
    path = scratch(t.spark, "s8")
    menu = t.nation.select(F.col("n_nationkey").alias("_id"), F.col("n_name").alias("_value"),
                           F.struct(F.concat(F.lit("region"), "n_regionkey").alias("_value")).alias("menuitem"))
    menu.write.format("xml").option("rootTag", "menus").option("rowTag", "menu").save(path)
    back = files.read_xml(t.spark, path, "menu", "_id INT, _value STRING, menuitem STRUCT<_value: STRING>")
    return back.select(F.col("_id").alias("id"), F.col("_value").alias("value"), F.col("menuitem._value").alias("item"))


@query("s10", "SELECT CAST(count(*) AS BIGINT) AS n FROM region")
def s10(t):
    """The bytes of the stored table survive a hex round trip and are a parquet file."""
    raw = files.read_binary(t.spark, f"{t.folder}/region.parque[t]", "*.parquet")
    kept = raw.select(F.unhex(F.hex("content")).alias("back"), "content", "length")
    sound = kept.agg(F.bool_and((F.col("back") == F.col("content")) & (F.length("content") == F.col("length"))
                                & (F.decode(F.substring("content", 1, 4), "UTF-8") == "PAR1")).alias("ok")).scalar()
    return t.region.filter(sound).agg(F.count(F.lit(1)).alias("n"))


@query("s14", "SELECT CAST(25 AS BIGINT) AS n, CAST(25 AS BIGINT) AS known FROM events LIMIT 1")
def s14(t):
    """A stream of the whole table in several files; the rows of the sample are whole rows of it."""
    root = scratch(t.spark, "s14")
    t.events.repartition(4, "event_id").write.parquet(f"{root}/in")
    stream = ST.read_files(t.spark, f"{root}/in", t.events.schema, files_per_trigger=1).drop("partition")
    taken = ST.sample(stream, 25, 60.0, f"{root}/state", f"{root}/data")
    known = taken.distinct().join(t.events, t.events.columns, "left_semi").agg(F.count(F.lit(1))).scalar()
    return taken.agg(F.count(F.lit(1)).alias("n")).withColumn("known", known)


@query("s18", """SELECT 'landing' AS partition_key, CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS email,
  CAST(36 AS INTEGER) AS key_length FROM customer""")
def s18(t):
    path = scratch(t.spark, "s18")
    asked = t.customer.selectExpr("IF(c_nationkey % 2 = 0, c_name, IF(c_nationkey % 3 = 0, '', NULL)) AS query_email",
                                  "c_mktsegment AS body_email")
    files.append_keyed(asked, path, "landing")
    return files.read_parquet(t.spark, path).select("partition_key", "email", F.length("row_key").alias("key_length"))


@query("s20", """SELECT 'orders' AS "table", v AS version, CASE v WHEN 1 THEN '0x00000000000000000000' ELSE (SELECT max(lsn) FROM chg) END
  AS last_lsn, CASE v WHEN 2 THEN CAST(0 AS BIGINT) END AS batch_id,
  CASE v WHEN 1 THEN (SELECT count(*) FROM base) ELSE (SELECT count(*) FROM merged) END AS row_count
FROM (SELECT unnest([CAST(1 AS BIGINT), CAST(2 AS BIGINT)]) AS v)""", using=("base", "chg", "w1", "merged"))
def s20(t):
    root = scratch(t.spark, "s20")
    table, history = VersionedTable(t.spark, root, "orders"), VersionedTable(t.spark, root, "schemas")
    table.write(t.fixture("base"))
    ST.stream_merge(streams(t).fixture("chg"), table, changes.KEYS, f"{root}/state", history=history)
    return ST.offset_table(table)


@query("o4", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def o4(t):
    path = scratch(t.spark, "o4")
    tables.write_ordered(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), path, "o_custkey", "o_orderkey")
    return files.read_parquet(t.spark, path)


@query("d4", """SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey), s_name, 'NEW' FROM supplier""")
def d4(t):
    stored = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    new = t.supplier.select("s_suppkey", F.col("s_name").alias("c_name"))
    return tables.insert_rows(stored, new, "c_custkey", ["s_suppkey"], id_block("s_suppkey"), {"c_mktsegment": F.lit("NEW")})


@query("d13", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS price FROM orders")
def d13(t):
    """Rows written before the column was added read NULL."""
    name = new_schema(t, scratch(t.spark, "d13")) + ".orders"
    even, odd = t.orders.filter("o_orderkey % 2 = 0"), t.orders.filter("o_orderkey % 2 = 1")
    catalog.create_table_as(even.select("o_orderkey"), name)
    catalog.add_column(t.spark, name, "price", "DOUBLE", "price of the order")
    odd.select("o_orderkey", F.col("o_totalprice").alias("price")).write.insertInto(name)
    return catalog.load_table(t.spark, name)


def order_source(t) -> sync.Source:
    return sync.Source(lambda: t.fixture("base"), lambda: t.fixture("chg"), changes.KEYS)


FIRST_LSN = "0x" + "00000000000000000001"


@query("d17", """SELECT '0x00000000000000000000' AS before, (SELECT max(lsn) FROM chg) AS after FROM orders LIMIT 1""", using=("chg",))
def d17(t):
    table = VersionedTable(t.spark, scratch(t.spark, "d17"), "orders")
    before = table.load_state()
    sync.sync(table, order_source(t))
    return t.spark.range(1).select(F.lit(before).alias("before"), F.lit(table.load_state()).alias("after"))


@query("d18", changes.MERGED, using=("base", "chg", "w1", "merged"))
def d18(t):
    """Full copy as of the first LSN, then one incremental run, then one without changes."""
    table = HashedTable(t.spark, scratch(t.spark, "d18"), "orders", changes.KEYS, 8)
    table.write(t.fixture("base"), last_lsn=FIRST_LSN)
    merged, again = sync.sync(table, order_source(t)), sync.sync(table, order_source(t))
    if (merged.action, again.action) != ("merged", "unchanged"):
        raise AssertionError(f"unexpected actions {merged.action}, {again.action}")
    return table.read()


@query("d19", """SELECT 'customer' AS name, 'full' AS action, (SELECT count(*) FROM customer) AS rows
UNION ALL SELECT 'orders', 'merged', (SELECT count(*) FROM merged)""", using=("base", "chg", "w1", "merged"))
def d19(t):
    root = scratch(t.spark, "d19")
    orders, customer = HashedTable(t.spark, root, "orders", changes.KEYS, 8), HashedTable(t.spark, root, "customer", ["c_custkey"], 8)
    orders.write(t.fixture("base"), last_lsn=FIRST_LSN)

    def log():
        return t.customer.select(F.lit(FIRST_LSN).alias(cdc.LSN), F.lit(1).alias(cdc.SEQ), F.lit(cdc.INSERT).alias(cdc.OP), "*")
    got = sync.sync_all({"orders": (orders, order_source(t)),
                         "customer": (customer, sync.Source(lambda: t.customer, log, ["c_custkey"]))})
    return t.spark.createDataFrame([(n, r.action, r.rows) for n, r in got.items()], "name STRING, action STRING, rows BIGINT")


@query("d18_bucketed", changes.MERGED, using=("base", "chg", "w1", "merged"))
def d18_bucketed(t):
    """The same on a table hashed by its key, which the merge reads without a shuffle."""
    root = scratch(t.spark, "d18b")
    table = VersionedTable(t.spark, root, "orders", 8, changes.KEYS, new_schema(t, root))
    table.write(t.fixture("base"), last_lsn=FIRST_LSN)
    sync.sync(table, order_source(t), broadcast_rows=0)
    return table.read()


def new_schema(t, root: str) -> str:
    name = "tidemark_" + root.rsplit("-", 1)[1]
    catalog.create_schema(t.spark, name, location=f"{root}/schema")
    return name


@query("s2", "SELECT c_custkey, c_name FROM customer")
def s2(t):
    name = new_schema(t, scratch(t.spark, "s2")) + ".customer"
    catalog.create_table_as(t.customer.limit(0), name)
    catalog.create_table_as(t.customer.select("c_custkey", "c_name"), name, replace=True)
    return catalog.load_table(t.spark, name)


@query("d7", "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM orders")
def d7(t):
    name = new_schema(t, scratch(t.spark, "d7")) + ".orders"
    catalog.create_table_as(t.orders, name)
    before = catalog.load_table(t.spark, name).count()
    catalog.truncate(t.spark, name)
    return catalog.load_table(t.spark, name).agg(F.lit(before).cast("bigint").alias("before"), F.count(F.lit(1)).alias("after"))


@query("d14", """SELECT 'goods' AS name, count(*) AS n FROM part UNION ALL SELECT 'nation', count(*) FROM nation""")
def d14(t):
    """Create three tables, rename one, drop one, list and count the rest."""
    schema = new_schema(t, scratch(t.spark, "d14"))
    for name in ("nation", "region", "part"):
        catalog.create_table_as(getattr(t, name), f"{schema}.{name}")
    catalog.rename_table(t.spark, f"{schema}.part", f"{schema}.goods")
    catalog.drop_table(t.spark, f"{schema}.region")
    counted = [catalog.load_table(t.spark, f"{schema}.{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"))
               for n in catalog.list_tables(t.spark, schema)]
    return tables.union_all(*counted)


@query("t11", "SELECT o_orderkey, o_totalprice FROM orders")
def t11(t):
    """Replay a stored table a third of its rows at a time, whatever the files."""
    root = scratch(t.spark, "t11")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    files.write_csv(rows.repartition(2), f"{root}/in")
    n = rows.count()
    stream = replay.replay_rows(t.spark, f"{root}/in", rows.schema, max(1, -(-n // 3)), f"{root}/files", "csv")

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")
    replay.run_to_end(stream, f"{root}/state", store)
    stored = t.spark.read.parquet(f"{root}/data")
    sizes = sorted(r["count"] for r in stored.groupBy("batch").count().collect())  # one row per batch
    if len(sizes) > 3 or sizes[1:] != [max(1, -(-n // 3))] * (len(sizes) - 1):
        raise AssertionError(f"batches of {sizes} rows")
    return stored.drop("batch")


@query("l5")
def l5(t):
    path = scratch(t.spark, "l5")
    regression.save_model(series.one_feature(t, False), path)
    return regression.predict(regression.load_model(path), t.lineitem).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


ORACLES["l5"] = ORACLES["l4"]
