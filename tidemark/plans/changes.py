"""Change logs on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.operators import cdc, digests, tables, typed
from tidemark.plans.basics import scratch
from tidemark.plans.registry import ORACLES, query
from tidemark.sources import files

KEYS = ["k"]
LOW, HIGH = "0x" + "20000".rjust(20, "0"), "0x" + "69999".rjust(20, "0")
ROW = "k BIGINT, custkey BIGINT, status STRING, amount DOUBLE, odate TIMESTAMP_NTZ"


def plain(df):
    """Change columns under names both engines take."""
    return df.withColumnsRenamed({cdc.LSN: "lsn", cdc.SEQ: "seqval", cdc.OP: "op"})


def latest(t):
    return cdc.latest_change(cdc.read_changes(t.fixture("chg"), "0x" + "0" * 20, "0x" + "f" * 20), KEYS)


@query("s3", f"SELECT * FROM chg WHERE lsn BETWEEN '{LOW}' AND '{HIGH}' AND op <> 3", using=("chg",))
def s3(t):
    """The range is read from a stored log; its bounds may be in lower case."""
    path = scratch(t.spark, "s3")
    cdc.write_changes(t.fixture("chg"), path)
    return plain(cdc.read_changes(t.spark.read.parquet(path), LOW.lower(), HIGH.lower()))


@query("p4", "SELECT CASE op WHEN 1 THEN 'delete' WHEN 2 THEN 'insert' ELSE 'update' END AS kind, lsn, k FROM chg WHERE op <> 3",
       using=("chg",))
def p4(t):
    parts = cdc.split_ops(t.fixture("chg"))
    tagged = [plain(p).select(F.lit(kind).alias("kind"), "lsn", "k")
              for kind, p in zip(("delete", "insert", "update"), parts)]
    return tables.union_all(*tagged)


@query("p5", "SELECT k, custkey, status, amount, odate FROM chg", using=("chg",))
def p5(t):
    return cdc.strip_meta(t.fixture("chg"))


@query("w1", "SELECT * FROM w1", using=("chg", "w1"))
def w1(t):
    return plain(latest(t))


@query("w2", """, pos AS (SELECT *, lsn || '-' || seqval || '-' || op AS p FROM chg WHERE op <> 3),
resets AS (SELECT k, max(p) AS p FROM pos WHERE op IN (1, 4) GROUP BY k)
SELECT * FROM base WHERE k NOT IN (SELECT k FROM resets)
UNION ALL SELECT pos.k, custkey, status, amount, odate FROM pos LEFT JOIN resets ON pos.k = resets.k
WHERE op <> 1 AND (resets.p IS NULL OR pos.p >= resets.p)""", using=("base", "chg"))
def w2(t):
    return cdc.replay(t.fixture("base"), t.fixture("chg"), KEYS)


@query("w3", """, r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC, seqval DESC, op DESC) AS rn,
  first_value(op) OVER (PARTITION BY k ORDER BY lsn, seqval, op) AS f FROM chg WHERE op <> 3)
SELECT lsn, seqval, CASE WHEN f = 2 THEN 2 WHEN f = 1 AND op <> 1 THEN 4 ELSE op END AS op, k, custkey, status, amount, odate
FROM r WHERE rn = 1 AND NOT (f = 2 AND op = 1)""", using=("chg",))
def w3(t):
    return plain(cdc.net_changes(t.fixture("chg"), KEYS))


@query("j1", "SELECT * FROM base WHERE k NOT IN (SELECT k FROM w1 WHERE op = 1)", using=("base", "chg", "w1"))
def j1(t):
    deletes, _, _ = cdc.split_ops(latest(t))
    return cdc.apply_deletes(t.fixture("base"), deletes, KEYS)


@query("j2", """SELECT b.k, coalesce(u.custkey, b.custkey) AS custkey, coalesce(u.status, b.status) AS status,
  coalesce(u.amount, b.amount) AS amount, coalesce(u.odate, b.odate) AS odate
FROM base b LEFT JOIN (SELECT * FROM w1 WHERE op = 4) u ON b.k = u.k""", using=("base", "chg", "w1"))
def j2(t):
    _, _, updates = cdc.split_ops(latest(t))
    return cdc.apply_updates(t.fixture("base"), updates, KEYS)


@query("j3", "SELECT k, custkey, status, amount, odate FROM w1 WHERE op = 4 AND k NOT IN (SELECT k FROM base)",
       using=("base", "chg", "w1"))
def j3(t):
    _, _, updates = cdc.split_ops(latest(t))
    return cdc.unmatched_updates(t.fixture("base"), updates, KEYS)


@query("x1", """SELECT k, custkey, status, amount, odate FROM w1 WHERE op = 2
UNION ALL SELECT k, custkey, status, amount, odate FROM w1 WHERE op = 4 AND k NOT IN (SELECT k FROM base)""",
       using=("base", "chg", "w1"))
def x1(t):
    base = t.fixture("base")
    _, inserts, updates = cdc.split_ops(latest(t))
    return tables.union_all(inserts.select(*base.columns), cdc.unmatched_updates(base, updates, KEYS))


MERGED = "SELECT * FROM merged"
STRICT = """SELECT k, custkey, status, amount, odate FROM w1 WHERE op IN (2, 4) OR k NOT IN (SELECT k FROM base)
UNION ALL SELECT * FROM base WHERE k NOT IN (SELECT k FROM w1)"""


@query("d1", MERGED, using=("base", "chg", "w1", "merged"))
def d1(t):
    return cdc.merge_cdc(t.fixture("base"), t.fixture("chg"), KEYS)


@query("d1_broadcast", MERGED, using=("base", "chg", "w1", "merged"))
def d1_broadcast(t):
    return cdc.merge_cdc(t.fixture("base"), t.fixture("chg"), KEYS, broadcast_rows=200_000)


@query("d1_strict", STRICT, using=("base", "chg", "w1"))
def d1_strict(t):
    return cdc.merge_cdc(t.fixture("base"), latest(t), KEYS, mode="strict")


@query("j4", STRICT, using=("base", "chg", "w1"))
def j4(t):
    return cdc.merge_cdc(t.fixture("base"), latest(t), KEYS, mode="strict")


KEEP = """SELECT w.k, coalesce(w.custkey, b.custkey) AS custkey, coalesce(w.status, b.status) AS status,
  coalesce(w.amount, b.amount) AS amount, coalesce(w.odate, b.odate) AS odate
FROM w1 w LEFT JOIN base b ON w.k = b.k WHERE op IN (2, 4)
UNION ALL SELECT * FROM base WHERE k NOT IN (SELECT k FROM w1)"""


@query("d2", KEEP, using=("base", "chg", "w1"))
def d2(t):
    return cdc.apply_cdc(t.fixture("base"), t.fixture("chg"), KEYS)


@query("d2_strict", KEEP, using=("base", "chg", "w1"))
def d2_strict(t):
    return cdc.apply_cdc(t.fixture("base"), t.fixture("chg"), KEYS, mode="strict")


@query("d2_strict_again", KEEP + " UNION ALL SELECT k, custkey, status, amount, odate FROM w1 WHERE op = 2", using=("base", "chg", "w1"))
def d2_strict_again(t):
    """The strict form doubles its inserts when a range is applied twice; the correct form does not (``d2_again``)."""
    once = cdc.apply_cdc(t.fixture("base"), t.fixture("chg"), KEYS, mode="strict")
    return cdc.apply_cdc(once, t.fixture("chg"), KEYS, mode="strict")


@query("d2_again", KEEP, using=("base", "chg", "w1"))
def d2_again(t):
    once = cdc.apply_cdc(t.fixture("base"), t.fixture("chg"), KEYS)
    return cdc.apply_cdc(once, t.fixture("chg"), KEYS)


SNAPSHOT = """snapshot AS (SELECT o_orderkey AS k, o_custkey AS custkey, o_orderstatus AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS amount, o_orderdate AS odate
  FROM orders WHERE o_orderkey % 10 <> 8)"""


@query("d3", f""", {SNAPSHOT}
SELECT s.*, CASE WHEN s.k IN (SELECT k FROM base) THEN 'update' ELSE 'insert' END AS _action FROM snapshot s
UNION ALL SELECT *, 'delete' FROM base WHERE k NOT IN (SELECT k FROM snapshot)""", using=("base",))
def d3(t):
    snapshot = t.orders.filter("o_orderkey % 10 <> 8").selectExpr(
        "o_orderkey AS k", "o_custkey AS custkey", "o_orderstatus AS status",
        "CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS amount", "o_orderdate AS odate")
    return cdc.replace_delete_unmatched(t.fixture("base"), snapshot, KEYS)


@query("d10", f""", {SNAPSHOT}, pairs AS (SELECT b.k AS bk, s.k AS sk, b, s,
  b.custkey IS DISTINCT FROM s.custkey OR b.status IS DISTINCT FROM s.status
  OR b.amount IS DISTINCT FROM s.amount OR b.odate IS DISTINCT FROM s.odate AS changed
  FROM base b FULL OUTER JOIN snapshot s ON b.k = s.k)
SELECT '0x7' AS lsn, 1 AS seqval, 1 AS op, unnest(b) FROM pairs WHERE sk IS NULL
UNION ALL SELECT '0x7', 1, 2, unnest(s) FROM pairs WHERE bk IS NULL
UNION ALL SELECT '0x7', 1, 3, unnest(b) FROM pairs WHERE bk IS NOT NULL AND sk IS NOT NULL AND changed
UNION ALL SELECT '0x7', 1, 4, unnest(s) FROM pairs WHERE bk IS NOT NULL AND sk IS NOT NULL AND changed""", using=("base",))
def d10(t):
    base = t.fixture("base")
    rows = d3(t).filter("_action <> 'delete'").drop("_action")
    return plain(cdc.capture_changes(base, rows, KEYS, "0x7"))


@query("d10_digests")
def d10_digests(t):
    """The same by digests: only ranges of keys that differ are joined."""
    rows = d3(t).filter("_action <> 'delete'").drop("_action")
    return plain(digests.capture_changes(t.fixture("base"), rows, KEYS, "0x7"))


ORACLES["d10_digests"] = ORACLES["d10"]


def envelopes(t):
    """The change log as envelope messages; a delete is followed by a tombstone."""
    c = plain(t.fixture("chg")).filter("op <> 3")
    row = "named_struct('k', k, 'custkey', custkey, 'status', status, 'amount', amount, 'odate', odate)"
    return c.selectExpr(f"""explode(filter(array(
        to_json(named_struct('before', IF(op = 1, {row}, NULL), 'after', IF(op <> 1, {row}, NULL),
          'op', CASE op WHEN 1 THEN 'd' WHEN 2 THEN 'c' ELSE 'u' END,
          'source', named_struct('table', 'orders', 'ts_ns', CAST(substr(lsn, 3) AS BIGINT) * 10 + seqval, 'db', 'main'))),
        IF(op = 1, NULL, '-')), b -> b IS NULL OR b <> '-')) AS body""")


ENV = """, env AS (SELECT k, custkey, status, amount, odate, CASE op WHEN 1 THEN 'd' WHEN 2 THEN 'c' ELSE 'u' END AS __op,
  'orders' AS __table, CAST(substr(lsn, 3) AS BIGINT) * 10 + seqval AS __source_ts_ns, 'main' AS __db,
  CASE op WHEN 1 THEN 'true' ELSE 'false' END AS __deleted FROM chg WHERE op <> 3)
"""


@query("d12", ENV + """SELECT *, CAST(NULL AS VARCHAR) AS __error FROM env
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM chg WHERE op = 1""", using=("chg",))
def d12(t):
    return cdc.flatten_envelope(envelopes(t), "body", ROW)


@query("d11", ENV + """SELECT * EXCLUDE (rn, __deleted) FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY __source_ts_ns DESC) AS rn FROM env) WHERE rn = 1 AND __deleted <> 'true'""",
       using=("chg",))
def d11(t):
    return cdc.soft_delete_view(cdc.flatten_envelope(envelopes(t), "body", ROW), KEYS)


@query("s19", "SELECT 'lake_main_dbo_orders' || status AS target_table, op, count(*) AS n FROM chg GROUP BY 1, 2",
       using=("chg",))
def s19(t):
    """Written to the folders of the tables and read back."""
    path = scratch(t.spark, "s19")
    name = cdc.target_table(F.lit("main"), F.lit("dbo"), F.concat(F.lit("orders"), "status"), "lake")
    files.route_to_tables(plain(t.fixture("chg")), path, name)
    return t.spark.read.parquet(path).groupBy("target_table", "op").agg(F.count(F.lit(1)).alias("n"))


@query("s19_schemas", """SELECT 'orders' AS target_table, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM chg WHERE op <> 1
UNION ALL SELECT 'removed', count(*), CAST(sum(k) AS BIGINT) FROM chg WHERE op = 1""", using=("chg",))
def s19_schemas(t):
    """Two tables of different schema: the orders, and the keys of removed ones."""
    path = scratch(t.spark, "s19-schemas")
    name = F.when(F.col("op") == 1, "removed").otherwise("orders")
    files.route_to_tables(plain(t.fixture("chg")), path, name, columns={
        "orders": ["k", "custkey", "status", "amount"], "removed": [F.col("k").alias("removed_key"), "lsn"]})
    parts = [t.spark.read.parquet(f"{path}/target_table={table}").agg(
        F.lit(table).alias("target_table"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("total"))
        for table, key in (("orders", "k"), ("removed", "removed_key"))]
    return tables.union_all(*parts)


@query("d12_variant")
def d12_variant(t):
    """The rows without a schema given: opened as VARIANT, then typed by what they hold."""
    log = typed.open_envelope(envelopes(t), "body")
    return log.select(*[F.variant_get("row", f"$.{f.split()[0]}", f.split()[1]).alias(f.split()[0]) for f in ROW.split(", ")],
                      "__op", "__table", "__source_ts_ns", "__db", "__deleted", "__error")


ORACLES["d12_variant"] = ORACLES["d12"]


@query("s19_typed", """SELECT k, custkey, status, amount, op = 1 AS removed, lsn >= '0x00000000000000040000' AS late FROM chg WHERE op <> 3""", using=("chg",))
def s19_typed(t):
    """Two batches of envelopes whose schema nobody gives: the second has a column more, and whole amounts in the first only."""
    tables_ = typed.TypedTables(t.spark, scratch(t.spark, "s19-typed"))
    c = plain(t.fixture("chg")).filter("op <> 3").selectExpr("*", "lsn >= '0x00000000000000040000' AS late")
    for batch, rows in enumerate(("NOT late", "late")):
        extra = ", 'late', late" if batch else ""
        row = f"named_struct('k', k, 'custkey', custkey, 'status', status, 'amount', amount{extra})"
        body = c.filter(rows).selectExpr(f"""to_json(named_struct('before', IF(op = 1, {row}, NULL), 'after', IF(op <> 1, {row}, NULL),
            'op', IF(op = 1, 'd', 'u'), 'source', named_struct('table', 'orders', 'ts_ns', 1, 'db', 'main'))) AS body""")
        tables_.land(typed.open_envelope(body), batch, F.col("__table"))
    got = tables_.read("orders")
    return got.select("k", "custkey", "status", F.col("amount").cast("double").alias("amount"), (F.col("__op") == "d").alias("removed"),
                      F.coalesce("late", F.lit(False)).alias("late"))


@query("a3", """SELECT 'dbo_' || status AS instance, min(lsn) AS min_lsn, (SELECT max(lsn) FROM chg) AS max_lsn
FROM chg GROUP BY 1""", using=("chg",))
def a3(t):
    log = t.fixture("chg").withColumn("instance", lsn.capture_instance("status"))
    return cdc.lsn_bounds(log, "instance")


@query("f1", """SELECT k, CASE WHEN op = 1 THEN '0x00000000000000000000' ELSE lsn END AS hex FROM chg""", using=("chg",))
def f1(t):
    c = plain(t.fixture("chg"))
    return c.select("k", lsn.lsn_hex(F.when(F.col("op") != 1, lsn.lsn_bin("lsn"))).alias("hex"))


@query("f2", """SELECT k, op, CASE WHEN op = 1 THEN '00000000000000000000' ELSE substr(lsn, 3) END AS digits FROM chg""",
       using=("chg",))
def f2(t):
    c = plain(t.fixture("chg"))
    text = F.expr("CASE op WHEN 1 THEN 'bad' WHEN 2 THEN substr(lsn, 3) ELSE lsn END")
    return c.select("k", "op", F.hex(lsn.lsn_bin(text)).alias("digits"))
