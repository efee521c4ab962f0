"""Streams of the test tables, run over what is there and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.hashed import HashedTable
from tidemark.plans import changes, fixtures, messages, series
from tidemark.plans.basics import scratch
from tidemark.plans.registry import ORACLES, StreamTables, query
from tidemark.streaming import core as ST
from tidemark.streaming import replay, stateful


def streams(t) -> StreamTables:
    return StreamTables(t.spark, t.folder)


def run(t, name: str, df, partition_by=()):
    """Append a stream to a new folder until its input is used up and read the folder."""
    root = scratch(t.spark, name)
    ST.append_to(df, f"{root}/data", f"{root}/state", partition_by).awaitTermination()
    schema = df.schema
    return t.spark.read.schema(schema).parquet(f"{root}/data")


@query("s12", "SELECT event_type, count(*) AS n, CAST(1 AS BIGINT) AS files FROM events GROUP BY 1")
def s12(t):
    schema = t.events.schema
    stream = ST.read_files(t.spark, streams(t).path("events"), schema)
    got = run(t, "s12", stream.select("event_id", "event_type", "partition"))
    return got.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("partition").alias("files"))


@query("t1")
def t1(t):
    root = scratch(t.spark, "t1")
    ST.stream_cdc(changes.envelopes(streams(t)), "body", changes.ROW, f"{root}/log", f"{root}/state").awaitTermination()
    return t.spark.read.parquet(f"{root}/log")


ORACLES["t1"] = ORACLES["d12"]


@query("t2", changes.MERGED, using=("base", "chg", "w1", "merged"))
def t2(t):
    root = scratch(t.spark, "t2")
    table = HashedTable(t.spark, root, "orders", changes.KEYS, 8)
    table.write(t.fixture("base"))
    ST.stream_merge(streams(t).fixture("chg"), table, changes.KEYS, f"{root}/state", broadcast_rows=200_000)
    return table.read()


@query("t3", "SELECT event_id, ts, module, body FROM ev WHERE output = 'click' AND length(body) > 0", using=("ev",))
def t3(t):
    named = streams(t).fixture("ev").withColumnRenamed("output", "input_name")
    return run(t, "t3", ST.echo(named, "click", lambda df: df.drop("input_name")))


@query("t4", f"""SELECT l_orderkey, l_linenumber, round(s * l_quantity + i, 3) AS prediction, CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS actual
FROM lineitem, {series.REGR}""")
def t4(t):
    model = series.one_feature(t)
    body = F.concat_ws(",", *["l_linenumber"] * 5, "l_extendedprice", "l_tax", "l_quantity", *["l_tax"] * 3)
    stream = streams(t).lineitem.select("l_orderkey", "l_linenumber", body.alias("body"))
    scored = ST.score_stream(stream, model, {"l_quantity": "throttle"}).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"), F.col("actual").cast("double").alias("actual"))
    return run(t, "t4", scored)


@query("t5")
def t5(t):
    root = scratch(t.spark, "t5")
    ST.stream_route(streams(t).fixture("ev"), messages.RULES, f"{root}/data", f"{root}/state").awaitTermination()
    return t.spark.read.parquet(f"{root}/data").select("event_id", "sink")


ORACLES["t5"] = ORACLES["p8"]


@query("t6", messages.REPLIES, using=("rr_req", "rr_rep"))
def t6(t):
    """A closing request and reply far ahead let the watermark pass all real requests."""
    root = scratch(t.spark, "t6")
    frames = []
    for name in ("rr_req", "rr_rep"):
        df = t.fixture(name).withColumn("ts", F.col("ts").cast("timestamp"))
        far = t.fixture("rr_req").agg((F.max("ts") + F.expr("INTERVAL '2' DAY")).cast("timestamp").alias("ts"))
        closing = far.select(*[F.col("ts") if c == "ts" else F.lit(-1 if c == "request_id" else None).cast(df.schema[c].dataType).alias(c)
                               for c in df.columns])
        df.unionByName(closing).write.parquet(f"{root}/{name}")
        frames.append(t.spark.readStream.schema(df.schema).parquet(f"{root}/{name}"))
    out = run(t, "t6", ST.request_reply_stream(*frames))
    return out.filter("request_id <> -1").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "replied_at")})


@query("t9", """SELECT c_custkey, coalesce(v, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (
  SELECT user_id, arg_max(value, event_id) AS v FROM events GROUP BY 1) ON c_custkey = user_id""")
def t9(t):
    root = scratch(t.spark, "t9")
    table = HashedTable(t.spark, root, "balances", ["c_custkey"], 8)
    table.write(t.customer.select("c_custkey", "c_acctbal"))
    patches = streams(t).events.select(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"), "event_id")
    ST.run_available(patches, f"{root}/state", ST.device_state_batch(table, "c_custkey", "c_acctbal", "event_id"))
    return table.read()


def updates(t, name: str, df):
    """Rows a stream in update mode emitted, with the number of their batch."""
    root = scratch(t.spark, name)

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")
    ST.run_available(df, f"{root}/state", store, "update")
    return t.spark.read.parquet(f"{root}/data")


@query("t12", "SELECT l_orderkey AS image, l_returnflag AS name, count(*) AS n FROM lineitem GROUP BY 1, 2")
def t12(t):
    items = streams(t).lineitem.select(F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("name"))
    return updates(t, "t12", ST.queue_counts(items)).groupBy("image", "name").agg(F.max_by("n", "batch").alias("n"))


@query("w7_stream")
def w7_stream(t):
    """The table in order of its ids, replayed in four batches; numbers go on from batch to batch."""
    root = scratch(t.spark, "w7s")
    t.events.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(f"{root}/in")
    n = t.events.count()
    stream = replay.replay_rows(t.spark, f"{root}/in", t.events.schema, max(1, -(-n // 4)), f"{root}/files")
    events = t.sql(fixtures.SHARED["ev"][1], events=stream).select("event_id", "module")

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")
    replay.run_to_end(stateful.number_messages(events, ["event_id"]), f"{root}/state", store)
    return t.spark.read.parquet(f"{root}/data").drop("batch")


ORACLES["w7_stream"] = ORACLES["w7"]


@query("t7_stream", "SELECT DISTINCT request_id FROM rr_rep", using=("rr_rep",))
def t7_stream(t):
    """Which of two replies in one batch is first is up to their arrival, so ids are compared."""
    replies = streams(t).fixture("rr_rep").withColumn("ts", F.col("ts").cast("timestamp"))
    return run(t, "t7", ST.reply_once_stream(replies).select("request_id"))


@query("t8_stream", "SELECT event_id FROM events WHERE event_type <> 'error'")
def t8_stream(t):
    """Errors are sent as messages of an hour ago, all others as messages of now."""
    sent = F.expr("current_timestamp() - IF(event_type = 'error', INTERVAL '1' HOUR, INTERVAL '0' HOUR)")
    return run(t, "t8", ST.expire_late_stream(streams(t).events.withColumn("ts", sent), "10 minutes").select("event_id"))
