"""Streams of messages: sources, pass-through, routing, replies, state and merges."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import split_message
from tidemark.operators import cdc, messages
from tidemark.operators.regression import predict
from tidemark.operators.tables import VersionedTable, lookup_update
from tidemark.streaming.stateful import match_replies


def read_kafka(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               start: str = "latest") -> DataFrame:
    """All partitions of a topic as one stream from now on (or from ``earliest``).

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", start))
    if group:
        reader = reader.option("groupIdPrefix", group)
    return reader.load().select(
        F.col("value").alias("body"), "partition", "offset", F.col("timestamp").alias("ts"))


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               files_per_trigger: int | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Files of a folder as a stream; ``partition`` is the file a row came from."""
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).withColumn("partition", F.col("_metadata.file_path"))


def replay(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", header: bool = True) -> DataFrame:
    """One file per trigger, oldest first; the trigger interval sets the rate. ``replay.replay_rows`` goes by rows."""
    return read_files(spark, path, schema, fmt, 1, {"header": str(header).lower()} if fmt == "csv" else None)


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there now through ``foreachBatch``, then stop."""
    query = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(each).trigger(availableNow=True).start())
    query.awaitTermination()


def append_to(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
              available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder with the exactly-once file sink."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def sample(stream: DataFrame, n: int, timeout: float, checkpoint: str, out: str) -> DataFrame:
    """The first ``n`` messages of a stream, or those that came in time; TimeoutError when none did.

    Each batch writes what is still wanted to a folder of its own below ``out``; the
    query is stopped in any case.
    """
    spark = stream.sparkSession
    taken: dict[int, int] = {}

    def take(batch: DataFrame, batch_id: int) -> None:
        wanted = n - sum(taken.values())
        if wanted > 0:
            path = f"{out}/batch={batch_id}"
            batch.limit(wanted).write.mode("overwrite").parquet(path)
            taken[batch_id] = spark.read.schema(batch.schema).parquet(path).count()
    query = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
             .trigger(processingTime="200 milliseconds").start())
    try:
        waited = 0.0
        while sum(taken.values()) < n and waited < timeout:
            if query.awaitTermination(0.2):
                break
            waited += 0.2
    finally:
        query.stop()
    if not sum(taken.values()):
        raise TimeoutError(f"no message within {timeout} s")
    return spark.read.schema(stream.schema).parquet(*[f"{out}/batch={b}" for b in taken])


def stream_cdc(bodies: DataFrame, body: str, row: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append every captured change, flattened, to the log of a lake table."""
    return append_to(cdc.flatten_envelope(bodies, body, row), path, checkpoint)


def merge_batch(table: VersionedTable, keys: Sequence[str], broadcast_rows: int = 0,
                history: VersionedTable | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that merges a batch of changes into a table.

    The batch id is committed together with the data, so a batch that is delivered
    again after a failure is skipped. ``history`` gets one row per schema seen. A column
    that first comes with a change is added to the table. A ``HashedTable`` rewrites only the parts
    with keys of the batch.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        state = table.state()
        if state is not None and state["batch_id"] is not None and state["batch_id"] >= batch_id:
            return
        if state is None:
            raise ValueError(f"table {table.name} needs a full load first")
        batch = batch.persist()  # the source is read once
        try:
            top = batch.agg(F.max(f"`{cdc.LSN}`").alias("l")).first()["l"]
            if top is None:
                return
            if history is not None:
                record_schema(history, table.name, batch.schema, batch_id)
            table.rewrite(batch.select(*keys), lambda current: cdc.merge_cdc(
                current, batch, keys, broadcast_rows=broadcast_rows, new_columns="add"), max(top, state["last_lsn"]), batch_id)
        finally:
            batch.unpersist()
    return merge


def merge_batch_into(target: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """The same by MERGE INTO a lake table with row-level changes. Merging a batch
    twice gives the same rows, so a batch delivered again does no harm."""
    return lambda batch, batch_id: cdc.merge_into(target, batch, keys)


def stream_merge(changes: DataFrame, table: VersionedTable, keys: Sequence[str], checkpoint: str,
                 broadcast_rows: int = 0, history: VersionedTable | None = None) -> None:
    """Merge each micro-batch of changes that is available into ``table``."""
    run_available(changes, checkpoint, merge_batch(table, keys, broadcast_rows, history))


def record_schema(history: VersionedTable, name: str, schema: T.StructType, batch_id: int) -> None:
    """Schema history: a row when the schema of a source table differs from its last one."""
    spark = history.spark
    text = schema.simpleString()
    row = spark.range(1).select(F.lit(name).alias("source_table"), F.lit(text).alias("schema"),
                                F.lit(batch_id).cast("bigint").alias("batch_id"))
    if history.state() is None:
        history.write(row)
        return
    seen = history.read().filter(F.col("source_table") == name)
    last = seen.orderBy(F.desc("batch_id")).first()
    if last is None or last["schema"] != text:
        history.write(history.read().unionByName(row))


def offset_table(table: VersionedTable) -> DataFrame:
    """Progress of a table: one row per commit with its LSN and batch."""
    return table.history().select("table", "version", "last_lsn", "batch_id", "row_count")


def echo(stream: DataFrame, name: str, fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Messages of one named input, body and properties as they are, empty ones dropped."""
    passed = messages.drop_empty(messages.input_name_filter(stream, name))
    return passed.transform(fn) if fn else passed


def score_stream(stream: DataFrame, model: PipelineModel, features: Mapping[str, str], body: str = "body") -> DataFrame:
    """Prediction and actual speed of comma messages. ``features`` maps the model's
    columns to the parts of a message."""
    parts = messages.drop_empty(stream, body).withColumn("_m", split_message(body))
    rows = parts.withColumns({c: F.col("_m")[p].cast("double") for c, p in features.items()})
    return predict(model, rows).withColumn("actual", F.col("_m.speed")).drop("_m", *features)


def stream_route(stream: DataFrame, rules: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Route to several sinks from one read: a folder per sink."""
    return append_to(messages.route(stream, rules), path, checkpoint, ["sink"])


def reply_once_stream(replies: DataFrame, key: str = "request_id", delay: str = "2 minutes") -> DataFrame:
    """The first reply of a request; ids are forgotten once the watermark has passed."""
    return replies.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def request_reply_stream(requests: DataFrame, replies: DataFrame, timeout: str = messages.REPLY_TIMEOUT,
                         delay: str = "10 seconds", key: str = "request_id", result: str = "result") -> DataFrame:
    """Pending requests are state until a reply comes or until the watermark passes the timeout.

    An answered request leaves in the batch of its first reply in time, one without a reply
    with the error TIMEOUT; its state goes with it.
    """
    return match_replies(requests, replies, timeout, delay, key, result)


def expire_late_stream(stream: DataFrame, ttl: str = messages.TIME_TO_LIVE, column: str = "ts") -> DataFrame:
    """Messages older than ``ttl`` at processing time are dropped."""
    return stream.filter(F.col(column) >= F.current_timestamp() - F.expr(f"INTERVAL '{ttl}'"))


def message_counter_stream(stream: DataFrame, key: str = "module") -> DataFrame:
    """Messages seen so far per module, for update mode."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("counter"))


def device_state(patches: DataFrame, known: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Latest patched value per known key, for update mode. The state is one row per key."""
    latest = patches.join(known.select(key), key, "left_semi")
    return latest.groupBy(key).agg(F.max_by(value, order).alias(value))


def device_state_batch(table: VersionedTable, key: str, value: str, order: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that patches a stored lookup table, once per batch id."""
    def patch(batch: DataFrame, batch_id: int) -> None:
        state = table.state()
        if state["batch_id"] is not None and state["batch_id"] >= batch_id:
            return
        last = batch.groupBy(key).agg(F.max_by(value, order).alias(value)).persist()
        try:
            table.rewrite(last.select(key), lambda current: lookup_update(current, last, key, value), batch_id=batch_id)
        finally:
            last.unpersist()
    return patch


def queue_counts(stream: DataFrame, keys: Sequence[str] = ("image", "name")) -> DataFrame:
    """Objects per class of the queue items so far, for update mode."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
