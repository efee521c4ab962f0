"""Tables derived from the test tables, once for Spark and once as oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

# name -> (source table, text that runs in both engines)
SHARED = {
    "base": ("orders", """
SELECT o_orderkey AS k, o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS amount, o_orderdate AS odate
FROM {orders} WHERE o_orderkey % 10 <> 9"""),
    "ev": ("events", """
SELECT event_id, ts, 'Module' || cast(user_id % 4 AS string) AS module, event_type AS output,
       CASE WHEN event_id % 13 = 0 THEN '' ELSE props END AS body
FROM {events}"""),
    "rr_req": ("events", """
SELECT event_id AS request_id, user_id, ts FROM {events} WHERE event_type = 'view'"""),
    "sig": ("events", """
SELECT user_id AS series, event_id AS t, value AS measured FROM {events}"""),
    "epi": ("events", """
SELECT user_id AS run, event_id AS t, value AS reward, value / 2 AS v,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS done
FROM {events}"""),
    "trendv": ("events", """
SELECT event_id, event_type || ' ' || cast(user_id AS string) AS name,
       cast(1 + event_id % 9 AS string) || CASE event_id % 3 WHEN 0 THEN 'K+' WHEN 1 THEN 'M+' ELSE '00+' END AS volume,
       cast(1 + event_id % 24 AS string) || CASE event_id % 2 WHEN 0 THEN ' hours ago' ELSE ' minutes ago' END AS started,
       CASE WHEN event_id % 4 = 0 THEN 'Active' ELSE 'Lasted ' || cast(1 + event_id % 11 AS string) || ' hours' END AS lasted,
       'a, b ,c' || cast(event_id % 7 AS string) AS similar_names
FROM {events}"""),
    "box": ("lineitem", """
SELECT l_orderkey AS image,
       ((l_partkey * 1000003 + l_suppkey) * 8 + l_linenumber) * 64 + cast(l_quantity AS bigint) AS id,
       cast(l_quantity * 8 AS double) AS x1, cast(l_partkey % 400 AS double) AS y1,
       cast(l_quantity * 8 + 20 + l_suppkey AS double) AS x2, cast(l_partkey % 400 + 30 + l_partkey % 50 AS double) AS y2,
       cast(l_extendedprice / 110000 AS double) AS score, l_suppkey % 5 AS cls
FROM {lineitem}"""),
    "grid": ("events", """
SELECT cast(0.25 * (1 + event_id % 8) AS double) AS kp, cast(0.025 * (event_id % 9) AS double) AS ki,
       cast(0.25 * (event_id % 5) AS double) AS kd, round(cast(sum(cast(value AS decimal(28,8))) AS double) / count(value), 4) AS reward
FROM {events} GROUP BY 1, 2, 3"""),
    "kvlog": ("events", """
SELECT event_id AS seq, 'user' || cast(user_id AS string) AS key, props AS value,
       CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS op
FROM {events}"""),
    "bytes": ("events", """
SELECT event_id, 3 AS b0, 7 AS b1, 65 + event_id % 26 AS b2, 97 + event_id % 26 AS b3,
       CASE WHEN event_id % 3 = 0 THEN 254 WHEN event_id % 3 = 1 THEN 0 ELSE 98 END AS b4, 99 AS b5, 254 AS b6
FROM {events}"""),
    "anch": ("lineitem", """
SELECT l_orderkey AS image, l_partkey % 80 AS gx, l_suppkey % 80 AS gy, 8 AS stride, l_discount AS dx, l_tax AS dy,
       l_discount * 10 AS lw, l_tax * 10 AS lh
FROM {lineitem}"""),
}

# The documents as files of lines: sentence ends become CR LF, their own breaks stay LF.
LINES_SPARK = "SELECT doc_id, replace(text, '. ', '\\r\\n') AS body FROM {documents}"
LINES_ORACLE = "SELECT doc_id, replace(text, '. ', chr(13) || chr(10)) AS body FROM documents"

CHG_ORACLE = """
SELECT '0x' || lpad(cast(1000 + o_orderkey AS string), 20, '0') AS lsn, 1 AS seqval, 2 AS op, o_orderkey AS k,
       o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS amount, o_orderdate AS odate
FROM orders WHERE o_orderkey % 10 = 9
UNION ALL
SELECT '0x' || lpad(cast(20000 + o_orderkey AS string), 20, '0'), 1, 3, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderkey % 10 = 1
UNION ALL
SELECT '0x' || lpad(cast(20000 + o_orderkey AS string), 20, '0'), 1, 4, o_orderkey, o_custkey, 'D', o_totalprice + 1, o_orderdate
FROM orders WHERE o_orderkey % 10 = 1
UNION ALL
SELECT '0x' || lpad(cast(40000 + o_orderkey AS string), 20, '0'), 1, 4, o_orderkey, o_custkey, 'E', NULL, o_orderdate
FROM orders WHERE o_orderkey % 20 = 1
UNION ALL
SELECT '0x' || lpad(cast(60000 + o_orderkey AS string), 20, '0'), 1, 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderkey % 10 = 2
UNION ALL
SELECT '0x' || lpad(cast(60000 + o_orderkey AS string), 20, '0'), 2, 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderkey % 30 = 9
UNION ALL
SELECT '0x' || lpad(cast(80000 + o_orderkey AS string), 20, '0'), 1, 1, o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate
FROM orders WHERE o_orderkey % 50 = 3
UNION ALL
SELECT '0x' || lpad(cast(80000 + o_orderkey AS string), 20, '0'), 1, 4, o_orderkey + 2000000, o_custkey, 'N', o_totalprice, o_orderdate
FROM orders WHERE o_orderkey % 50 = 4"""

# the same change log from one scan: each order yields the changes it is part of
# (guard, lsn start, seqval, op, key shift, status, amount)
_CHANGES = [
    ("k % 10 = 9", 1000, 1, 2, 0, "status", "amount"),
    ("k % 10 = 1", 20000, 1, 3, 0, "status", "amount"),
    ("k % 10 = 1", 20000, 1, 4, 0, "'D'", "amount + 1"),
    ("k % 20 = 1", 40000, 1, 4, 0, "'E'", "CAST(NULL AS DOUBLE)"),
    ("k % 10 = 2", 60000, 1, 1, 0, "status", "amount"),
    ("k % 30 = 9", 60000, 2, 1, 0, "status", "amount"),
    ("k % 50 = 3", 80000, 1, 1, 1000000, "status", "amount"),
    ("k % 50 = 4", 80000, 1, 4, 2000000, "'N'", "amount"),
]

RR_REP_ORACLE = """
SELECT event_id AS request_id, ts + INTERVAL '5' SECOND AS ts, CASE WHEN event_id % 5 = 0 THEN '{bad' ELSE props END AS result
FROM events WHERE event_type = 'view' AND event_id % 4 <> 0 AND event_id % 3 <> 0
UNION ALL
SELECT event_id, ts + INTERVAL '61' SECOND, props
FROM events WHERE event_type = 'view' AND event_id % 4 <> 0 AND event_id % 3 = 0
UNION ALL
SELECT event_id, ts + INTERVAL '7' SECOND, props
FROM events WHERE event_type = 'view' AND event_id % 20 = 1"""

ORACLE_SQL = {name: text.format(**{source: source}) for name, (source, text) in SHARED.items()} | {
    "chg": CHG_ORACLE, "rr_rep": RR_REP_ORACLE, "lines": LINES_ORACLE,
    "w1": """
SELECT lsn, seqval, op, k, custkey, status, amount, odate FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC, seqval DESC, op DESC) AS rn FROM chg WHERE op <> 3)
WHERE rn = 1""",
    "merged": """
SELECT k, custkey, status, amount, odate FROM w1 WHERE op IN (2, 4)
UNION ALL SELECT * FROM base WHERE k NOT IN (SELECT k FROM w1)""",
}


def with_ctes(sql: str, using: tuple[str, ...]) -> str:
    if not using:
        return sql.strip()
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({ORACLE_SQL[name].strip()})" for name in using) + "\n" + sql.strip()


def _chg(t) -> DataFrame:
    rows = ",\n".join(
        f"IF({guard}, named_struct('__$start_lsn', '0x' || lpad(CAST({start} + k AS STRING), 20, '0'), "
        f"'__$seqval', {seq}, '__$operation', {op}, 'k', k + {shift}, 'custkey', custkey, "
        f"'status', {status}, 'amount', {amount}, 'odate', odate), NULL)"
        for guard, start, seq, op, shift, status, amount in _CHANGES)
    orders = t.orders.selectExpr("o_orderkey AS k", "o_custkey AS custkey", "o_orderstatus AS status",
                                 "o_totalprice AS amount", "o_orderdate AS odate")
    return orders.selectExpr(f"inline(filter(array({rows}), c -> c IS NOT NULL))")


def _rr_rep(t) -> DataFrame:
    views = t.events.filter("event_type = 'view'")
    return views.selectExpr("""inline(filter(array(
        IF(event_id % 4 <> 0 AND event_id % 3 <> 0, named_struct('request_id', event_id, 'ts', ts + INTERVAL '5' SECOND,
           'result', CASE WHEN event_id % 5 = 0 THEN '{bad' ELSE props END), NULL),
        IF(event_id % 4 <> 0 AND event_id % 3 = 0, named_struct('request_id', event_id, 'ts', ts + INTERVAL '61' SECOND,
           'result', props), NULL),
        IF(event_id % 20 = 1, named_struct('request_id', event_id, 'ts', ts + INTERVAL '7' SECOND, 'result', props), NULL)),
        r -> r IS NOT NULL))""")


def build(t, name: str) -> DataFrame:
    """The fixture as a DataFrame."""
    if name == "chg":
        return _chg(t)
    if name == "rr_rep":
        return _rr_rep(t)
    if name == "lines":
        return t.sql(LINES_SPARK, documents=t.documents)
    source, text = SHARED[name]
    return t.sql(text, **{source: getattr(t, source)})
