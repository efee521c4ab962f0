"""Messages, requests and replies, lines of text, on events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.operators import enrich as E
from tidemark.operators import messages as M
from tidemark.operators.running import id_block
from tidemark.plans.registry import query
from tidemark.sources import files

PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("p6", "SELECT * FROM ev WHERE length(body) > 0", using=("ev",))
def p6(t):
    return M.drop_empty(t.fixture("ev"))


@query("p7", """SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN cast(user_id AS string) END AS request_id FROM events
WHERE user_id % 5 <> 0""")
def p7(t):
    rows = t.events.selectExpr("event_id", "CASE user_id % 5 WHEN 0 THEN IF(event_id % 2 = 0, NULL, '') "
                               "ELSE cast(user_id AS string) END AS request_id")
    return M.require_id(rows)


RULES = (
    'FROM /messages/modules/Module1/outputs/* INTO BrokeredEndpoint("/modules/Module2/inputs/input-1")',
    "FROM /messages/modules/Module1/outputs/c* INTO $upstream",
    "FROM /messages/modules/Module2/outputs/purchase INTO $upstream",
)


@query("p8", """SELECT event_id, '/modules/Module2/inputs/input-1' AS sink FROM ev WHERE module = 'Module1'
UNION ALL SELECT event_id, '$upstream' FROM ev WHERE module = 'Module1' AND output LIKE 'c%'
UNION ALL SELECT event_id, '$upstream' FROM ev WHERE module = 'Module2' AND output = 'purchase'""", using=("ev",))
def p8(t):
    return M.route(t.fixture("ev"), RULES).select("event_id", "sink")


@query("p9", "SELECT event_id, module, output FROM ev WHERE output = 'click'", using=("ev",))
def p9(t):
    return M.input_name_filter(t.fixture("ev"), "click", "output").select("event_id", "module", "output")


@query("p10", "SELECT event_id, ts FROM ev WHERE ts > TIMESTAMP '2024-01-03 00:00:00'", using=("ev",))
def p10(t):
    return M.enqueued_after(t.fixture("ev").select("event_id", "ts"), F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))


@query("p12", """SELECT event_id, CASE WHEN event_type = 'view' OR event_type = 'error' THEN 'John Doe' ELSE event_type END AS name,
  CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS timeout FROM events""")
def p12(t):
    rows = t.events.selectExpr(
        "event_id", "CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN '' ELSE event_type END AS name",
        "IF(user_id % 3 = 0, NULL, user_id) AS timeout")
    return M.with_defaults(rows, name="John Doe", timeout=0).withColumn("timeout", F.col("timeout").cast("bigint"))


@query("w7", "SELECT event_id, module, row_number() OVER (PARTITION BY module ORDER BY event_id) AS counter FROM ev",
       using=("ev",))
def w7(t):
    return M.message_counter(t.fixture("ev").select("event_id", "module"), ["event_id"], id_block("event_id"))


@query("t7", """SELECT request_id, ts, result FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts) AS rn FROM rr_rep) WHERE rn = 1""", using=("rr_rep",))
def t7(t):
    return M.reply_once(t.fixture("rr_rep"))


REPLIES = """, hits AS (SELECT q.request_id, min(r.ts) AS replied_at, arg_min(r.result, r.ts) AS result
  FROM rr_req q JOIN rr_rep r ON q.request_id = r.request_id AND r.ts BETWEEN q.ts AND q.ts + INTERVAL '60' SECOND GROUP BY 1)
SELECT q.request_id, q.user_id, q.ts, h.replied_at, h.result, CASE WHEN h.request_id IS NULL THEN 'TIMEOUT' END AS error
FROM rr_req q LEFT JOIN hits h ON q.request_id = h.request_id"""


@query("j6", REPLIES, using=("rr_req", "rr_rep"))
def j6(t):
    return M.request_reply(t.fixture("rr_req"), t.fixture("rr_rep"))


@query("t8", "SELECT event_id, ts FROM ev WHERE ts >= (SELECT max(ts) FROM ev) - INTERVAL '2' HOUR", using=("ev",))
def t8(t):
    return M.expire_late(t.fixture("ev").select("event_id", "ts"), "2 hours")


@query("s17", """SELECT event_id, '{"data":{"event_id":' || event_id || ',"module":"' || module || '","output":"' || output
  || '"},"operation":"create"}' AS message FROM ev""", using=("ev",))
def s17(t):
    rows = files.to_message(t.fixture("ev"), ["event_id", "module", "output"], "message", envelope=True)
    return rows.select("event_id", "message")


@query("f17", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def f17(t):
    body = F.concat(F.col("props"), F.lit('\n{"k": -1}'))
    return t.events.select("event_id", X.first_json_line(body, PROPS)["k"].alias("k"))


@query("f18", """SELECT request_id, ts, CASE WHEN result <> '{bad' THEN CAST(json_extract(result, '$.k') AS BIGINT) END AS k
FROM (SELECT request_id, ts, CASE WHEN result = '{bad' THEN NULL ELSE result END AS result FROM rr_rep)""", using=("rr_rep",))
def f18(t):
    return t.fixture("rr_rep").select("request_id", "ts", X.parse_json_or_default("result", PROPS)["k"].alias("k"))


@query("f19", "SELECT event_id, CAST(user_id AS VARCHAR) AS price FROM events")
def f19(t):
    doc = F.expr("""concat(IF(event_id % 2 = 0, '{"desired":', ''), '{"7908C820":{"value":"', user_id, '"}}',
                    IF(event_id % 2 = 0, ',"version":3}', ''))""")
    return t.events.select("event_id", F.get_json_object(X.json_path_or_root(doc, "desired"), "$['7908C820'].value").alias("price"))


@query("f20", """SELECT event_id, '{"' || event_type || '":"' || user_id || '"}' AS message,
  '{"Tag":{"Serial":"' || event_type || '","Price":"' || user_id || '"}}' AS tag FROM events""")
def f20(t):
    return t.events.select("event_id", X.json_message(F.col("event_type"), "user_id").alias("message"),
                           X.tag_message("event_type", F.col("user_id").cast("string")).alias("tag"))


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"


@query("f21", f"""SELECT doc_id, 'https://search.example/v7/search?q=' || replace(replace(replace(replace(replace(
  url_encode(trim(substr(text, 1, 150), {BLANKS})), '%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*')
  || '&count=50&offset=100&responseFilter=Webpages&safesearch=Strict' AS url FROM documents""")
def f21(t):
    return t.documents.select("doc_id", X.search_text("text", "https://search.example/v7/search", 100).alias("url"))


@query("f22", """SELECT l_orderkey, l_linenumber, l_quantity AS speed, CAST(l_partkey AS DOUBLE) AS throttle,
  CAST(l_suppkey AS DOUBLE) AS rpm, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS acceleration FROM lineitem""")
def f22(t):
    csv = F.concat_ws(",", "l_shipdate", *["l_linenumber"] * 4, "l_quantity", "l_discount", "l_partkey", "l_suppkey",
                      "l_discount", "l_tax")
    return t.lineitem.select("l_orderkey", "l_linenumber", X.split_message(csv).alias("m")).select(
        "l_orderkey", "l_linenumber",
        *[F.col(f"m.{c}").cast("double").alias(c) for c in ("speed", "throttle", "rpm", "acceleration")])


@query("f23", "SELECT event_id, chr(CAST(b2 AS INTEGER)) || chr(CAST(b3 AS INTEGER)) || "
              "CASE WHEN b4 = 98 THEN 'bc' ELSE '' END AS text FROM bytes", using=("bytes",))
def f23(t):
    block = F.array(*[F.col(f"b{i}") for i in range(7)])
    return t.fixture("bytes").select("event_id", X.block_to_text(block).alias("text"))


@query("f24", "SELECT event_id, printf('%02X%02X%02X%02X', b0, b1, b2, b3) AS serial FROM bytes", using=("bytes",))
def f24(t):
    data = F.unhex(F.concat(*[F.lpad(F.hex(f"b{i}"), 2, "0") for i in range(7)]))
    return t.fixture("bytes").select("event_id", X.bytes_to_hex(data, 8).alias("serial"))


@query("f25", "SELECT doc_id, text FROM documents")
def f25(t):
    return t.documents.select("doc_id", X.utf8_decode(X.to_binary("text")).alias("text"))


@query("f34", "SELECT count(*) AS n, count(*) AS full_length, true AS today FROM events")
def f34(t):
    rows = t.events.select(X.random_id().alias("id"), X.now().alias("at"))
    return rows.agg(F.count_distinct("id").alias("n"), F.count_if(F.length("id") == 36).alias("full_length"),
                    F.bool_and(F.to_date("at") == F.current_date()).alias("today"))


@query("f35", """SELECT event_id, hex(encode(event_type)) AS bytes, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
  event_id % 3 = 0 AS was_nan FROM events""")
def f35(t):
    v = F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", F.hex(X.to_binary("event_type")).alias("bytes"), X.nan_to_null(v).alias("value"),
                           F.isnan(v).alias("was_nan"))


LINES_SQL = """, parts AS (SELECT doc_id, string_split_regex(body, '\\r?\\n') AS ls FROM lines)"""


@query("f16", LINES_SQL + " SELECT doc_id, CAST(len(ls) AS INTEGER) AS n, ls[1] AS first_line, ls[len(ls)] AS last_line FROM parts",
       using=("lines",))
def f16(t):
    ls = X.split_lines("body")
    return t.fixture("lines").select("doc_id", F.size(ls).alias("n"), ls[0].alias("first_line"),
                                     F.element_at(ls, -1).alias("last_line"))


@query("s9", LINES_SQL + """ SELECT doc_id, CAST(i - 1 AS INTEGER) AS idx, ls[i] AS line FROM (
  SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM parts)""", using=("lines",))
def s9(t):
    return E.lines_of(t.fixture("lines"), "doc_id", "body")


@query("w8", LINES_SQL + """ SELECT doc_id, (i - 1) // 10 AS batch, count(*) AS n FROM (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i FROM parts) GROUP BY 1, 2""", using=("lines",))
def w8(t):
    batches = E.throttle_batches(E.lines_of(t.fixture("lines"), "doc_id", "body"))
    return batches.groupBy("doc_id", "batch").agg(F.count(F.lit(1)).alias("n"))


@query("a10", LINES_SQL + """ SELECT doc_id, array_to_string(list_transform(ls, lambda x: '[' || x || ']'), chr(10)) AS text FROM parts""",
       using=("lines",))
def a10(t):
    """The lines of a document never leave its row."""
    marked = F.transform(X.split_lines("body"), lambda line: F.concat(F.lit("["), line, F.lit("]")))
    return t.fixture("lines").select("doc_id", E.joined_lines(marked).alias("text"))


@query("a10_apart", LINES_SQL + """ SELECT doc_id, array_to_string(list_transform(ls, lambda x: '[' || x || ']'), chr(10)) AS text FROM parts""",
       using=("lines",))
def a10_apart(t):
    """The same for lines that are rows of their own."""
    marked = E.lines_of(t.fixture("lines"), "doc_id", "body").withColumn("line", F.concat(F.lit("["), "line", F.lit("]")))
    return E.ordered_collect(marked, "doc_id", "idx", "line")


@query("m1", LINES_SQL + """ SELECT doc_id, array_to_string(list_transform(ls, lambda x: reverse(x)), chr(10)) AS text FROM parts""",
       using=("lines",))
def m1(t):
    lines = t.fixture("lines").select("doc_id", X.split_lines("body").alias("lines"))
    answered = E.enrich(lines, lambda values: [v[::-1] for v in values], "lines", "answers")
    return answered.select("doc_id", E.joined_lines(F.col("answers")).alias("text"))
