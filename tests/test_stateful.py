"""Stateful streams: replies matched on arrival, numbers across batches, replay by rows, restarts."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import messages as M
from tidemark.operators.running import id_block
from tidemark.streaming import replay, stateful

T0 = datetime(2024, 1, 1)
REQ, REP = "request_id INT, user STRING, ts TIMESTAMP", "request_id INT, ts TIMESTAMP, result STRING"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


class Exchange:
    """Requests and replies as folders of files, one file per trigger, and a query over them that can be restarted."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.state = spark, folder, None
        self.put("req", [(-1, "none", at(-100))], REQ)
        self.put("rep", [(-2, at(-100), "none")], REP)

    def put(self, name, values, schema):
        self.spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")
        time.sleep(0.05)

    def run(self):
        """Rows emitted for ids above 0, by batch; ``state`` is the number of rows in the store afterwards."""
        read = lambda name, schema: self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/{name}")
        out, got = stateful.match_replies(read("req", REQ), read("rep", REP), "60 seconds", "10 seconds"), []

        def each(df, batch):
            found = sorted((r.request_id, r.user, r.result, r.error) for r in df.collect() if r.request_id >= 0)
            if found:
                got.append(found)
        query = out.writeStream.option("checkpointLocation", f"{self.folder}/state").foreachBatch(each).start()
        query.processAllAvailable()
        self.state = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        query.stop()
        return got


def test_a_reply_leaves_in_its_own_batch(spark, folder):
    x = Exchange(spark, folder)
    x.put("req", [(1, "a", at(0)), (2, "b", at(5)), (3, "c", at(6))], REQ)
    assert x.run() == []
    x.put("rep", [(1, at(60), "edge"), (2, at(30), "second"), (2, at(29), "first"), (3, at(67), "too late")], REP)
    assert x.run() == [[(1, "a", "edge", None), (2, "b", "first", None)]]  # no closing message, after a restart
    x.put("rep", [(1, at(61), "again")], REP)
    assert x.run() == []
    x.put("req", [(-1, "end", at(9000))], REQ)
    x.put("rep", [(-2, at(9000), "end")], REP)
    assert x.run() == [[(3, "c", None, "TIMEOUT")]]
    x.put("req", [(-3, "end", at(99000))], REQ)
    x.put("rep", [(-4, at(99000), "end")], REP)
    assert x.run() == [] and x.state == 2  # the two that ended it


def test_a_reply_may_come_before_its_request(spark, folder):
    x = Exchange(spark, folder)
    x.put("rep", [(1, at(20), "later"), (1, at(10), "early"), (1, at(1), "before"), (2, at(1), "only before")], REP)
    x.run()
    x.put("req", [(1, "a", at(5)), (2, "b", at(5))], REQ)
    assert x.run() == [[(1, "a", "early", None)]]
    x.put("rep", [(2, at(65), None)], REP)
    assert x.run() == [[(2, "b", None, None)]]


def test_stream_equals_batch(spark, folder):
    import random
    rng, asked, replies = random.Random(4), [], []
    for i in range(200):
        asked.append((i, f"u{i % 7}", at(i)))
        replies += [(i, at(i + rng.choice((0, 1, 30, 60, 61, 90))), f"r{k}") for k in range(rng.randrange(4))]
    replies.append((500, at(50), "nobody"))
    req, rep = spark.createDataFrame(asked, REQ), spark.createDataFrame(replies, REP)
    want = rows(M.request_reply(req, rep), "request_id", "user", "ts", "replied_at", "result", "error")
    far = spark.createDataFrame([(-1, "end", at(9999))], REQ), spark.createDataFrame([(-2, at(9999), "end")], REP)
    for name, df, end in (("req", req, far[0]), ("rep", rep, far[1])):
        df.unionAll(end).coalesce(1).write.parquet(f"{folder}/{name}")
    read = lambda name, schema: spark.readStream.schema(schema).parquet(f"{folder}/{name}")
    out = stateful.match_replies(read("req", REQ), read("rep", REP), "60 seconds", "10 seconds")
    query = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{folder}/out").filter("request_id >= 0")
    assert rows(got, "request_id", "user", "ts", "replied_at", "result", "error") == want


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet").selectExpr("event_id", "IF(event_id % 3 = 0, 'hot', 'm' || user_id % 4) AS module", "ts", "value")


def stored(folder, sizes=None):
    def each(df, batch):
        df.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        if sizes is not None:
            sizes.append(df.sparkSession.read.parquet(f"{folder}/out/batch={batch}").count())
    return each


def test_numbers_go_on_over_batches_and_restarts(spark, events, folder):
    events.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(f"{folder}/in")
    want, n = rows(M.message_counter(events, ["event_id"], id_block("event_id")), "event_id", "module", "counter"), events.count()
    half = 0

    def failing(df, batch):
        nonlocal half
        stored(folder)(df, batch)
        half += 1
        if half == 3:
            raise RuntimeError("stop")

    def numbered():
        return stateful.number_messages(replay.replay_rows(spark, f"{folder}/in", events.schema, n // 5 + 1, f"{folder}/files"), ["event_id"])
    with pytest.raises(Exception, match="stop"):
        replay.run_to_end(numbered(), f"{folder}/state", failing)
    replay.run_to_end(numbered(), f"{folder}/state", stored(folder))  # the third batch is delivered again
    assert rows(spark.read.parquet(f"{folder}/out"), "event_id", "module", "counter") == want


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_rows_per_trigger_whatever_the_files(spark, events, folder, fmt):
    writer = events.repartition(4).write
    if fmt == "csv":
        events = events.select("event_id", "module", "value")
        events.repartition(4).write.option("header", True).csv(f"{folder}/in")
    else:
        writer.option("parquet.block.size", 2048).parquet(f"{folder}/in")
    n = events.count()
    per = n // 7 + 3
    sizes = []
    replay.run_to_end(replay.replay_rows(spark, f"{folder}/in", events.schema, per, f"{folder}/files", fmt), f"{folder}/state", stored(folder, sizes))
    assert sizes == [per] * (n // per) + [n % per] * (n % per > 0)
    assert rows(spark.read.schema(events.schema).parquet(f"{folder}/out"), *events.columns) == rows(events)


def test_a_restart_in_the_middle_of_a_file_loses_and_repeats_nothing(spark, events, folder):
    events.coalesce(1).write.parquet(f"{folder}/in")
    n, sizes = events.count(), []

    def twice(df, batch):
        stored(folder, sizes)(df, batch)
        if len(sizes) == 2:
            raise RuntimeError("stop")
    stream = lambda: replay.replay_rows(spark, f"{folder}/in", events.schema, n // 6, f"{folder}/files")
    with pytest.raises(Exception, match="stop"):
        replay.run_to_end(stream(), f"{folder}/state", twice)
    events.coalesce(1).write.mode("append").parquet(f"{folder}/in")  # files that come later are not part of it
    replay.run_to_end(stream(), f"{folder}/state", stored(folder))
    assert rows(spark.read.schema(events.schema).parquet(f"{folder}/out"), *events.columns) == rows(events)
    batches = spark.read.parquet(f"{folder}/out").groupBy("batch").count().orderBy("batch").collect()
    assert [b["count"] for b in batches][:6] == [n // 6] * 6


def test_replay_edges(spark, events, folder):
    events.limit(0).write.parquet(f"{folder}/in")
    got = []
    replay.run_to_end(replay.replay_rows(spark, f"{folder}/in", events.schema, 5, f"{folder}/files"), f"{folder}/state", lambda df, i: got.append(df.count()))
    assert sum(got) == 0
    with pytest.raises(ValueError, match="at least 1"):
        replay.replay_rows(spark, f"{folder}/in", events.schema, 0, f"{folder}/files")
    with pytest.raises(ValueError, match="avro"):
        replay.replay_rows(spark, f"{folder}/in", events.schema, 1, f"{folder}/files", "avro")
