"""Streams in several batches against their batch form, restarts, timeouts."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import cdc
from tidemark.operators import messages as M
from tidemark.operators import regression as L
from tidemark.operators.tables import VersionedTable
from tidemark.plans import changes as plans
from tidemark.plans.registry import Tables
from tidemark.streaming import core as ST


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SMALL)


def in_files(df, path, n, order):
    """Write ``df`` as ``n`` files whose modification times follow ``order``."""
    rank = F.percent_rank().over(Window.orderBy(*order))
    numbered = df.withColumn("_part", F.floor(rank * n))
    numbered = numbered.withColumn("_part", F.least(F.col("_part"), F.lit(n - 1))).cache()
    for i in range(n):
        numbered.filter(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    numbered.unpersist()


def batches_of(stream, checkpoint, mode="append"):
    """Rows of each batch until the input is used up."""
    got = []
    ST.run_available(stream, checkpoint, lambda df, i: got.append([tuple(r) for r in df.collect()]), mode)
    return got


def test_stream_merge_in_batches(spark, t, folder):
    base, chg = t.fixture("base"), t.fixture("chg")
    in_files(chg, f"{folder}/log", 4, [f"`{cdc.LSN}`", f"`{cdc.SEQ}`", f"`{cdc.OP}`"])
    table, history = VersionedTable(spark, f"{folder}/lake", "orders"), VersionedTable(spark, f"{folder}/lake", "schemas")
    table.write(base)
    stream = spark.readStream.schema(chg.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    ST.stream_merge(stream, table, ["k"], f"{folder}/state", history=history)
    want = rows(cdc.merge_cdc(base, chg, ["k"]))
    assert rows(table.read()) == want
    state = table.state()
    assert (state["version"], state["batch_id"]) == (5, 3)
    assert state["last_lsn"] == chg.agg(F.max(f"`{cdc.LSN}`")).first()[0]
    assert history.read().count() == 1 and history.read().first()["schema"] == chg.schema.simpleString()
    # a restart from the checkpoint finds nothing, a lost checkpoint delivers the batches again: both change nothing
    for checkpoint in ("state", "state2"):
        ST.stream_merge(stream, table, ["k"], f"{folder}/{checkpoint}", broadcast_rows=100_000)
        assert table.state()["version"] == 5 and rows(table.read()) == want
    offsets = ST.offset_table(table).orderBy("version").collect()
    assert [r["batch_id"] for r in offsets] == [None, 0, 1, 2, 3]


def test_schema_history_keeps_changes(spark, folder):
    history = VersionedTable(spark, folder, "schemas")
    a, b = spark.range(1).schema, spark.range(1).withColumn("x", F.lit(1)).schema
    for i, s in enumerate((a, a, b, b, a)):
        ST.record_schema(history, "t", s, i)
    ST.record_schema(history, "other", a, 9)
    assert rows(history.read(), "source_table", "batch_id") == [("other", 9), ("t", 0), ("t", 2), ("t", 4)]


def test_merge_needs_a_full_load(spark, folder):
    table = VersionedTable(spark, folder, "t")
    with pytest.raises(ValueError, match="needs a full load"):
        ST.merge_batch(table, ["k"])(spark.range(1), 0)


def test_stream_cdc_appends_new_files_only(spark, t, folder):
    bodies = plans.envelopes(t)
    want = cdc.flatten_envelope(bodies, "body", plans.ROW)
    half = bodies.withColumn("h", F.coalesce(F.crc32("body"), F.lit(0)) % 2)
    for part in (0, 1):
        half.filter(F.col("h") == part).select("body").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("body STRING").parquet(f"{folder}/in")
        ST.stream_cdc(stream, "body", plans.ROW, f"{folder}/log", f"{folder}/state").awaitTermination()
    log = spark.read.parquet(f"{folder}/log")
    assert rows(log) == rows(want)
    assert rows(cdc.soft_delete_view(log, ["k"])) == rows(cdc.soft_delete_view(want, ["k"]))


def test_replay_one_file_per_batch(spark, folder):
    for i in range(3):
        spark.createDataFrame([(i, f"m{i}")], "i INT, m STRING").coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/in")
        time.sleep(0.05)
    stream = ST.replay(spark, f"{folder}/in", spark.createDataFrame([], "i INT, m STRING").schema)
    got = batches_of(stream.drop("partition"), f"{folder}/state")
    assert got == [[(0, "m0")], [(1, "m1")], [(2, "m2")]]


def test_sample(spark, t, folder):
    t.events.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(t.events.schema).parquet(f"{folder}/in")
    got = ST.sample(stream, 3, 60, f"{folder}/state", f"{folder}/out")
    assert got.count() == 3
    with pytest.raises(TimeoutError):
        ST.sample(stream.filter("event_id < 0"), 1, 1.5, f"{folder}/state2", f"{folder}/out2")


def test_sources_keep_the_partition(spark, t, folder):
    t.events.repartition(3).write.parquet(f"{folder}/in")
    stream = ST.read_files(spark, f"{folder}/in", t.events.schema, files_per_trigger=1)
    got = batches_of(stream.groupBy("partition").count(), f"{folder}/state", "update")
    assert sum(len(b) for b in got) == 3 and sum(r[1] for b in got for r in b) == t.events.count()


def test_echo_and_route(spark, t, folder):
    ev = t.fixture("ev")
    in_files(ev, f"{folder}/in", 2, ["event_id"])
    stream = spark.readStream.schema(ev.schema).parquet(f"{folder}/in")
    echoed = ST.echo(stream.withColumnRenamed("output", "input_name"), "click", lambda df: df.select("event_id", "body"))
    got = sorted(r for b in batches_of(echoed, f"{folder}/s1") for r in b)
    assert got == rows(M.drop_empty(ev).filter("output = 'click'"), "event_id", "body")
    from tidemark.plans.messages import RULES
    ST.stream_route(stream, RULES, f"{folder}/routed", f"{folder}/s2").awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/routed"), "event_id", "sink") == rows(M.route(ev, RULES), "event_id", "sink")


def test_counters_and_queue_counts(spark, t, folder):
    ev = t.fixture("ev")
    in_files(ev, f"{folder}/in", 3, ["event_id"])
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    final = {}
    for b in batches_of(ST.message_counter_stream(stream), f"{folder}/s1", "update"):
        final.update(dict(b))
    assert final == {r[0]: r[1] for r in ev.groupBy("module").count().collect()}
    counts = {}
    for b in batches_of(ST.queue_counts(stream, ["module", "output"]), f"{folder}/s2", "update"):
        counts.update({r[:2]: r[2] for r in b})
    assert counts == {tuple(r)[:2]: r[2] for r in ev.groupBy("module", "output").count().collect()}


def test_device_state(spark, folder):
    dim = spark.createDataFrame([("a", "1"), ("b", "2")], "serial STRING, price STRING")
    patches = spark.createDataFrame([(1, "a", "10"), (2, "zz", "0"), (3, "a", "11"), (4, "b", "20")], "seq INT, serial STRING, price STRING")
    in_files(patches, f"{folder}/in", 4, ["seq"])
    stream = spark.readStream.schema(patches.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    latest = {}
    for b in batches_of(ST.device_state(stream, dim, "serial", "price", "seq"), f"{folder}/s1", "update"):
        latest.update(dict(b))
    assert latest == {"a": "11", "b": "20"}
    table = VersionedTable(spark, f"{folder}/lake", "prices")
    table.write(dim)
    for checkpoint in ("s2", "s3"):
        ST.run_available(stream, f"{folder}/{checkpoint}", ST.device_state_batch(table, "serial", "price", "seq"))
    assert rows(table.read(), "serial", "price") == [("a", "11"), ("b", "20")] and table.state()["version"] == 5


def test_request_reply_stream(spark, folder):
    t0 = datetime(2024, 1, 1)
    # the last request and reply lie far ahead, so the watermark passes all others
    req = spark.createDataFrame([(i, t0 + timedelta(seconds=10 * i)) for i in range(6)] + [(99, t0 + timedelta(days=1))],
                                "request_id INT, ts TIMESTAMP")
    rep = spark.createDataFrame(
        [(0, t0 + timedelta(seconds=60), "edge"), (1, t0 + timedelta(seconds=71), "late"), (2, t0 + timedelta(seconds=25), "ok"),
         (2, t0 + timedelta(seconds=26), "again"), (5, t0 + timedelta(seconds=49), "early"), (98, t0 + timedelta(days=1), "x")],
        "request_id INT, ts TIMESTAMP, result STRING")
    req.coalesce(1).write.parquet(f"{folder}/req")
    rep.coalesce(1).write.parquet(f"{folder}/rep")
    q = spark.readStream.schema(req.schema).parquet(f"{folder}/req")
    r = spark.readStream.schema(rep.schema).parquet(f"{folder}/rep")
    out = ST.request_reply_stream(q, r).select("request_id", "result", "error")
    got = sorted((x for b in batches_of(out, f"{folder}/s1") for x in b), key=str)
    assert got == [(0, "edge", None), (1, None, "TIMEOUT"), (2, "ok", None), (3, None, "TIMEOUT"),
                   (4, None, "TIMEOUT"), (5, None, "TIMEOUT")]


def test_reply_once_stream(spark, folder):
    t0 = datetime(2024, 1, 1)
    for i, (rid, text) in enumerate([(1, "first"), (1, "second"), (2, "other")]):
        spark.createDataFrame([(rid, t0 + timedelta(seconds=i), text)], "request_id INT, ts TIMESTAMP, result STRING").coalesce(1).write.mode(
            "append").parquet(f"{folder}/in")
        time.sleep(0.05)
    schema = "request_id INT, ts TIMESTAMP, result STRING"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    got = [r for b in batches_of(ST.reply_once_stream(stream).select("request_id", "result"), f"{folder}/s") for r in b]
    assert got == [(1, "first"), (2, "other")]


def test_expire_late(spark, folder):
    now = datetime.now()
    df = spark.createDataFrame([(1, now), (2, now - timedelta(hours=1))], "id INT, ts TIMESTAMP")
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    got = [r for b in batches_of(ST.expire_late_stream(stream, "10 minutes").select("id"), f"{folder}/s") for r in b]
    assert got == [(1,)]
    assert rows(M.expire_late(df), "id") == [(1,)]


def test_kafka_is_optional(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ST.read_kafka(spark, "localhost:1", "t", "group")


CAR_ROWS = [(float(i % 9), 1500.0 + 37 * (i % 13), -0.1 + 0.01 * (i % 20)) for i in range(200)]


@pytest.fixture(scope="module")
def car(spark):
    data = [(th, rpm, acc, 3 * th + 0.02 * rpm - 10 * acc + 1) for th, rpm, acc in CAR_ROWS]
    return spark.createDataFrame(data, "throttle DOUBLE, rpm DOUBLE, acceleration DOUBLE, speed DOUBLE")


FEATURES = ["throttle", "rpm", "acceleration"]


@pytest.mark.parametrize("with_mean", [True, False])
def test_regression(spark, car, folder, with_mean):
    model = L.fit_regression(car, "speed", FEATURES, with_mean)
    c = L.coefficients(model, FEATURES)
    assert [c[f] for f in FEATURES + ["intercept"]] == pytest.approx([3, 0.02, -10, 1], abs=1e-6)
    L.save_model(model, f"{folder}/m")
    again = L.load_model(f"{folder}/m")
    scored = L.predict(again, car)
    assert scored.columns == car.columns + ["prediction"]
    m = L.regression_metrics(scored, "speed").first()
    assert m["mae"] < 1e-6 and m["r2"] == pytest.approx(1.0)


def test_scaling(car):
    stats = {r["feature"]: r for r in L.column_stats(car, FEATURES).collect()}
    scaled = L.scale(car, FEATURES)
    after = {r["feature"]: r for r in L.column_stats(scaled, [f + "_scaled" for f in FEATURES]).collect()}
    assert all(r["mean"] == pytest.approx(0, abs=1e-9) and r["stddev"] == pytest.approx(1) for r in after.values())
    plain = L.scale(car, ["rpm"], with_mean=False).first()
    assert plain["rpm_scaled"] == pytest.approx(plain["rpm"] / stats["rpm"]["stddev"])
    assert L.assemble(car, FEATURES).first()["features"].toArray().tolist() == list(CAR_ROWS[0])


def test_score_stream(spark, car, folder):
    model = L.fit_regression(car, "speed", FEATURES)
    body = F.concat_ws(",", *[F.lit("t")] * 5, "speed", F.lit(0), "throttle", "rpm", F.lit(0), "acceleration")
    messages = car.select(body.alias("body")).unionAll(spark.createDataFrame([("",)], "body STRING"))
    messages.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("body STRING").parquet(f"{folder}/in")
    scored = ST.score_stream(stream, model, {f: f for f in FEATURES}).select("prediction", "actual")
    got = [r for b in batches_of(scored, f"{folder}/s") for r in b]
    assert len(got) == 200 and all(p == pytest.approx(a, abs=1e-3) for p, a in got)


def test_sample_takes_several_batches(spark, folder):
    for i in range(3):
        spark.range(10 * i, 10 * i + 10, 1, 1).write.mode("append").parquet(f"{folder}/in")
    stream = ST.read_files(spark, f"{folder}/in", spark.range(1).schema, files_per_trigger=1).drop("partition")
    assert ST.sample(stream, 25, 30.0, f"{folder}/s1", f"{folder}/o1").distinct().count() == 25
    assert ST.sample(stream, 99, 5.0, f"{folder}/s2", f"{folder}/o2").count() == 30
