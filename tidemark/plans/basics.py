"""Scans, plain queries, table changes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.operators import digests
from tidemark.operators import query as Q
from tidemark.operators import tables as TB
from tidemark.operators.enrich import list_envelope
from tidemark.operators.running import id_block
from tidemark.plans.registry import query
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import files


def scratch(spark, name: str) -> str:
    """New folder for a query that writes, in the folder the cluster shares."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("s1", "SELECT * FROM customer")
def s1(t):
    return files.load_full(t.spark, f"{t.folder}/customer.parquet")


@query("s7", "SELECT * FROM part")
def s7(t):
    path = scratch(t.spark, "s7")
    files.write_parquet(t.part, path)
    return files.read_parquet(t.spark, path)


@query("p1", "SELECT * FROM nation")
def p1(t):
    return Q.select_all(t.nation)


@query("p2", "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND n_chars >= 500")
def p2(t):
    return Q.query_by_param(
        t.spark, "SELECT doc_id, source, n_chars FROM {documents} WHERE lang = :lang AND n_chars >= :size",
        {"lang": "en", "size": 500}, documents=t.documents)


@query("p3", """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice < 100000 AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def p3(t):
    cond = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000)
            & F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return Q.where(t.orders, cond).select("o_orderkey", "o_totalprice")


# The two metadata tables of a change capture, as nations (objects) and suppliers (their columns).
META = """change_tables AS (SELECT 'dbo_' || n_name AS capture_instance, n_nationkey AS object_id FROM nation),
index_columns AS (SELECT s_nationkey AS object_id, s_name AS column_name FROM supplier)"""


def meta(t):
    change_tables = t.nation.select(lsn.capture_instance("n_name").alias("capture_instance"),
                                    F.col("n_nationkey").alias("object_id"))
    index_columns = t.supplier.select(F.col("s_nationkey").alias("object_id"), F.col("s_name").alias("column_name"))
    return change_tables, index_columns


@query("p11", f"""WITH {META} SELECT column_name FROM index_columns
WHERE object_id = (SELECT object_id FROM change_tables WHERE capture_instance = 'dbo_NATION_3')""")
def p11(t):
    change_tables, index_columns = meta(t)
    wanted = change_tables.filter("capture_instance = 'dbo_NATION_3'").select("object_id").scalar()
    return index_columns.filter(F.col("object_id") == wanted).select("column_name")


@query("j10", f"""WITH {META} SELECT column_name FROM index_columns
WHERE object_id IN (SELECT object_id FROM change_tables WHERE capture_instance = 'dbo_NATION_7')""")
def j10(t):
    return TB.key_columns(*meta(t), "dbo_NATION_7")


@query("a12", f"""WITH {META}
SELECT coalesce(bool_or(capture_instance = 'dbo_NATION_4'), false) AS tracked,
       coalesce(bool_or(capture_instance = 'dbo_Missing'), false) AS missing FROM change_tables""")
def a12(t):
    change_tables, _ = meta(t)
    tracked = TB.exists_flag(change_tables, F.col("capture_instance") == "dbo_NATION_4", "tracked")
    missing = TB.exists_flag(change_tables, F.col("capture_instance") == "dbo_Missing", "missing")
    return tracked.withColumn("missing", missing.scalar())


@query("f3", "SELECT n_nationkey, 'dbo_' || n_name AS capture_instance FROM nation")
def f3(t):
    return t.nation.select("n_nationkey", lsn.capture_instance("n_name").alias("capture_instance"))


@query("f4", """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 's.' || c_name || ' = t.' || c_name
  ELSE 's.' || c_name || ' = t.' || c_name || ' AND s.' || c_mktsegment || ' = t.' || c_mktsegment END AS predicate FROM customer""")
def f4(t):
    keys = F.when(F.col("c_nationkey") % 2 == 0, F.array("c_name")).otherwise(F.array("c_name", "c_mktsegment"))
    return t.customer.select("c_custkey", lsn.merge_predicate(keys).alias("predicate"))


@query("a1", """SELECT 'customer' AS side, (SELECT count(*) FROM customer) AS source_rows,
  (SELECT count(DISTINCT c_custkey) FROM customer) AS target_rows,
  CASE WHEN (SELECT count(*) FROM customer) = (SELECT count(DISTINCT c_custkey) FROM customer)
       THEN 'equal' ELSE 'mismatch' END AS status
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM lineitem),
  CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM lineitem) THEN 'equal' ELSE 'mismatch' END""")
def a1(t):
    copy = t.customer.dropDuplicates(["c_custkey"])
    return (TB.reconcile(t.customer, copy).select(F.lit("customer").alias("side"), "*")
            .unionByName(TB.reconcile(t.orders, t.lineitem).select(F.lit("orders").alias("side"), "*")))


@query("a1_keys", """WITH edited AS (SELECT c_custkey + CASE WHEN c_custkey % 97 = 5 THEN 10000000 ELSE 0 END AS c_custkey, c_name,
  CASE WHEN c_custkey % 53 = 1 THEN 'XX' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 101 <> 7)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN b.c_custkey IS NULL THEN 'missing' WHEN a.c_custkey IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM (SELECT c_custkey, c_name, c_mktsegment FROM customer) a FULL OUTER JOIN edited b ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_mktsegment <> b.c_mktsegment OR a.c_name <> b.c_name""")
def a1_keys(t):
    """Which keys differ between the customers and an edited copy."""
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    edited = t.customer.filter("c_custkey % 101 <> 7").selectExpr(
        "c_custkey + IF(c_custkey % 97 = 5, 10000000, 0) AS c_custkey", "c_name", "IF(c_custkey % 53 = 1, 'XX', c_mktsegment) AS c_mktsegment")
    return digests.reconcile_rows(rows, edited, ["c_custkey"]).select("c_custkey", "status")


@query("a2", "SELECT count(*) AS n FROM lineitem")
def a2(t):
    return Q.count_rows(t.lineitem)


@query("a15", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def a15(t):
    return TB.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("o1", "SELECT o_orderkey, o_orderdate FROM orders")
def o1(t):
    return Q.order_desc(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey")


@query("o2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def o2(t):
    return Q.limit_n(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 10)


@query("o3", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def o3(t):
    return Q.page(t.documents.select("doc_id", "source"), "doc_id", 100)


@query("o3_far", "SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT l_orderkey, l_partkey, l_suppkey, "
                 "row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey) AS n FROM lineitem) WHERE n > 30000 AND n <= 30050")
def o3_far(t):
    from tidemark.operators.running import with_row_number
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    numbered = with_row_number(rows, "n", ["l_orderkey", "l_partkey", "l_suppkey"], id_block("l_orderkey", 10_000))
    return numbered.filter("n > 30000 AND n <= 30050").drop("n")


@query("a11", """SELECT page, count(*) AS n, '{"Documents":[' || string_agg(
  '{"doc_id":' || doc_id || ',"source":"' || source || '"}', ',' ORDER BY doc_id) || '],"_count":' || count(*) || '}' AS body
FROM (SELECT doc_id, source, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS page FROM documents) GROUP BY page""")
def a11(t):
    return list_envelope(t.documents, "doc_id", id_block("doc_id", 100_000), ["doc_id", "source"])


@query("j5", """SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_retailprice
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def j5(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    return TB.lookup(lines, dim, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_retailprice")


@query("d20", """WITH patch AS (SELECT l_partkey * 2 AS k, round(max(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1)
SELECT p_partkey, coalesce(price, p_retailprice) AS p_retailprice FROM part LEFT JOIN patch ON p_partkey = k""")
def d20(t):
    patch = t.lineitem.groupBy((F.col("l_partkey") * 2).alias("p_partkey")).agg(
        F.round(F.max("l_extendedprice"), 2).alias("p_retailprice"))
    return TB.lookup_update(t.part.select("p_partkey", "p_retailprice"), patch, "p_partkey", "p_retailprice")


@query("j9", """SELECT 'order without customer' AS violation, o_orderkey AS key FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'customer without event', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def j9(t):
    orphans = TB.fk_violations(t.orders, t.customer, "o_custkey", "c_custkey")
    silent = TB.fk_violations(t.customer, t.events.select("user_id").distinct(), "c_custkey", "user_id")
    return orphans.select(F.lit("order without customer").alias("violation"), F.col("o_orderkey").alias("key")).unionByName(
        silent.select(F.lit("customer without event").alias("violation"), F.col("c_custkey").alias("key")))


@query("j9_valid", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def j9_valid(t):
    return TB.fk_valid(t.customer, t.events.select("user_id").distinct(), "c_custkey", "user_id").select("c_custkey", "c_name")


@query("d5", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def d5(t):
    return TB.update_where(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
                           {"o_orderstatus": F.lit("D"), "o_totalprice": F.col("o_totalprice") + 1},
                           F.col("o_orderstatus") == "P")


@query("d6", "SELECT * FROM orders WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice < 200000, false)")
def d6(t):
    return TB.delete_where(t.orders, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000))


@query("d8", """SELECT doc_id, source FROM documents WHERE lang = 'en'
UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')""")
def d8(t):
    stored = t.documents.filter("lang = 'en'").select("doc_id", "source")
    return TB.insert_if_absent(stored, t.documents.select("doc_id", F.lit("new").alias("source")), ["doc_id"])


@query("d9", """SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM kvlog)
WHERE rn = 1 AND op <> 1""", using=("kvlog",))
def d9(t):
    """The second half of the log meets a store filled by the first."""
    return filled_store(t)


def filled_store(t):
    log = t.fixture("kvlog")
    half = log.agg(F.expr("max(seq) div 2").alias("s")).scalar()
    empty = log.select("key", "value").limit(0)
    return TB.kv_upsert(TB.kv_upsert(empty, log.filter(F.col("seq") <= half)), log.filter(F.col("seq") > half))


KEPT = """SELECT key, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM kvlog)
WHERE rn = 1 AND op <> 1"""


@query("d9_get", KEPT + " AND key = 'user7'", using=("kvlog",))
def d9_get(t):
    return TB.kv_get(filled_store(t), "user7")


@query("d9_delete", KEPT + " AND key <> 'user7'", using=("kvlog",))
def d9_delete(t):
    return TB.kv_delete(filled_store(t), "user7")


@query("d16", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def d16(t):
    path = scratch(t.spark, "d16")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_parquet(rows.repartition("o_orderstatus", F.floor(F.col("o_orderkey") / 1_000_000)), path, ["o_orderstatus"])
    return files.read_parquet(t.spark, path).filter("o_orderstatus = 'O'")


PAGE_NAMES = "'2025-02-' || lpad(cast(1 + page_id % 28 AS string), 2, '0') || '-' || upper(regexp_extract(url, '/([a-z]+)/', 1))"


@query("s11", f"""SELECT page_id, '2025-02-' || lpad(cast(1 + page_id % 28 AS string), 2, '0') AS date,
  upper(regexp_extract(url, '/([a-z]+)/', 1)) AS geo, CAST(4 + page_id % 20 AS INTEGER) AS hours FROM pages
WHERE regexp_extract(url, '/([a-z]+)/', 1) <> ''""")
def s11(t):
    named = t.pages.selectExpr("page_id", f"{PAGE_NAMES} || '-' || cast(4 + page_id % 20 AS string) || '.html' AS name")
    return named.select("page_id", *files.page_tags(F.col("name"))).filter("geo <> ''")
