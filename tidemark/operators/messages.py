"""Messages: rows with a body, string properties, a module, an output and a time."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.running import HOT_ROWS, split_hot, with_row_number

REPLY_TIMEOUT = "60 seconds"
TIME_TO_LIVE = "10 seconds"


def drop_empty(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages without a body are not forwarded."""
    return messages.filter(F.length(body) > 0)


def require_id(messages: DataFrame, column: str = "request_id") -> DataFrame:
    """Messages without a correlation id are dropped; an empty text counts as none."""
    c = F.col(column)
    return messages.filter(c.isNotNull() & (c.cast("string") != ""))


def input_name_filter(messages: DataFrame, name: str, column: str = "input_name") -> DataFrame:
    return messages.filter(F.col(column) == name)


def enqueued_after(messages: DataFrame, ts: str | Column, column: str = "ts") -> DataFrame:
    """Only messages after a point in time, exclusive."""
    return messages.filter(F.col(column) > ts)


def _rule(text: str) -> tuple[Column, str]:
    match = re.fullmatch(r"\s*FROM\s+/messages/modules/([^/]+)/outputs/(\S+)\s+INTO\s+(.+?)\s*", text)
    if not match:
        raise ValueError(f"not a route: {text}")
    module, output, sink = match.groups()
    named = re.fullmatch(r'BrokeredEndpoint\("([^"]+)"\)', sink)
    cond = (F.col("module") == module) & F.col("output").rlike("^" + re.escape(output).replace(r"\*", ".*") + "$")
    return cond, named.group(1) if named else sink


def route(messages: DataFrame, rules: Sequence[str]) -> DataFrame:
    """One row per message and matching rule, with its ``sink``.

    ``FROM /messages/modules/M/outputs/O INTO S``, ``*`` in O matches any text. The
    rules become one array expression, so routing needs no join and no shuffle.
    """
    hits = F.array(*[F.when(cond, F.lit(sink)) for cond, sink in map(_rule, rules)])
    return messages.withColumn("sink", F.explode(F.filter(hits, lambda s: s.isNotNull())))


def message_counter(messages: DataFrame, order: Sequence[str], block: Column, key: str = "module",
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Running number of a message within its module."""
    return with_row_number(messages, "counter", order, block, [key], hot_rows)


def reply_once(replies: DataFrame, key: str = "request_id", order: Sequence[str] = ("ts",)) -> DataFrame:
    """The first reply of a request; later ones are ignored."""
    w = Window.partitionBy(key).orderBy(*order)
    return replies.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def request_reply(requests: DataFrame, replies: DataFrame, timeout: str = REPLY_TIMEOUT,
                  key: str = "request_id", result: str = "result", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Each request with its first reply inside the timeout, or with the error TIMEOUT.

    The time limit is inclusive and request ids are unique. Replies meet their request
    on the id with the time range as a residual condition, then the earliest is taken
    per request. A request with more than ``hot_rows`` replies is broadcast to them
    instead (there are at most replies / hot_rows of those), so they stay spread and
    are reduced map-side.
    """
    limit = F.expr(f"INTERVAL '{timeout}'")
    cold, hot = split_hot(replies, [key], hot_rows)

    def reply_side(part: DataFrame) -> DataFrame:
        return part.select(F.col(key).alias("_id"), F.col("ts").alias("_ts"), F.col(result).alias("_result"))
    in_time = (F.col(key) == F.col("_id")) & F.col("_ts").between(F.col("ts"), F.col("ts") + limit)
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_ts", "_result"))).alias("_first")

    def answered(asked: DataFrame, part: DataFrame) -> DataFrame:
        others = [F.any_value(c).alias(c) for c in requests.columns if c != key]
        return asked.join(reply_side(part), in_time, "left").groupBy(key).agg(*others, first)

    if hot is None:
        matched = answered(requests, cold)
    else:
        ids = hot.select(key).distinct()
        busy = requests.join(F.broadcast(ids), key, "left_semi")
        firsts = reply_side(hot).join(F.broadcast(busy.select(key, "ts")), in_time).groupBy(key).agg(first)
        matched = answered(requests.join(F.broadcast(ids), key, "left_anti"), cold).unionByName(
            busy.join(F.broadcast(firsts), key, "left"))
    got = F.col("_first")
    return matched.select(
        *requests.columns, got["_ts"].alias("replied_at"), got["_result"].alias(result),
        F.when(got.isNull(), "TIMEOUT").alias("error"))


def with_defaults(df: DataFrame, **defaults: object) -> DataFrame:
    """Replace a missing or empty value by a default."""
    return df.withColumns({
        c: F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(v)).otherwise(F.col(c))
        for c, v in defaults.items()})


def expire_late(messages: DataFrame, ttl: str = TIME_TO_LIVE, column: str = "ts") -> DataFrame:
    """Messages at most ``ttl`` older than the newest one of the batch."""
    newest = messages.agg(F.max(column)).scalar()
    return messages.filter(F.col(column) >= newest - F.expr(f"INTERVAL '{ttl}'"))
