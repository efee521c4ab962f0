"""Operators with state of their own per key: replies matched on arrival, messages numbered.

The state lives in Spark's state store, one version per micro-batch, so a batch that is repeated after a
failure starts from the same state and gives the same rows. It needs the RocksDB store, which
:func:`use_rocksdb` selects for queries started afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Groups of request ids: few enough that a batch of many ids has many of each, enough to spread them and keep them small.
GROUPS = 4096


def use_rocksdb(spark: SparkSession) -> None:
    if spark.conf.get(_PROVIDER, "") != _ROCKSDB:
        spark.conf.set(_PROVIDER, _ROCKSDB)


def _same(value: object) -> object:
    """A value that can be looked up and is equal where Spark takes two ids as equal."""
    if isinstance(value, float) and value != value:
        return "NaN"
    return tuple(map(_same, value)) if isinstance(value, (list, tuple)) else value


def _plain(value: object) -> object:
    """Rows as tuples: a list state takes no Row inside a value, though it gives them."""
    if isinstance(value, dict):
        return {_plain(k): _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return tuple(_plain(v) for v in value) if isinstance(value, tuple) else value


class ReplyMatcher(StatefulProcessor):
    """Per group of request ids: the pending requests, and the replies that came before theirs.

    A request leaves with the earliest of the replies in time as soon as one is there, and its state
    goes at once. A timer on the watermark lets it leave with TIMEOUT. Replies without a request wait
    until the watermark says that none can come any more. Ids share a group so that calls to the state
    are made per group and batch, not per id; a timer that finds nothing to do is harmless.
    """

    CHUNK = 1000  # rows in one call that appends to a list

    def __init__(self, id_type: T.DataType, ask: T.StructType, result: T.DataType, timeout_us: int):
        self.id_type, self.ask, self.result, self.timeout_us = id_type, ask, result, timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        own = [T.StructField("id", self.id_type), T.StructField("at", T.LongType())]
        self.pending = handle.getListState("pending", T.StructType([*own, T.StructField("ask", self.ask)]))
        self.early = handle.getListState("early", T.StructType([*own, T.StructField("result", self.result)]))

    def _expiry(self, at: int) -> int:
        """Milliseconds of the first watermark after the last reply in time."""
        return (at + self.timeout_us) // 1000 + 1

    def _store(self, state: ListState, old: list[tuple], new: list[tuple], rewrite: bool) -> None:
        """Adds the new rows; where old ones have gone, what is left of them is written again."""
        if rewrite:
            state.clear()
        rows = old + new if rewrite else new
        for low in range(0, len(rows), self.CHUNK):
            state.appendList([_plain(r) for r in rows[low:low + self.CHUNK]])

    def _wake(self, times: list[int], now: int) -> None:
        """A timer at the first of the times, unless one comes before it."""
        if times and not any(now < t <= min(times) for t in list(self.handle.listTimers())):
            self.handle.registerTimer(min(times))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        waiting = {_same(i): (i, at, ask) for i, at, ask in self.pending.get()}
        asked: dict[object, tuple] = {}
        replies: dict[object, dict[int, tuple]] = {}
        for r in rows:
            i, at = _same(r["id"]), r["at"]
            known = waiting.get(i)
            if r["kind"] == 0:
                if known is None:
                    asked.setdefault(i, (r["id"], at, r["ask"]))
            elif known is None or known[1] <= at <= known[1] + self.timeout_us:
                found, reply = replies.setdefault(i, {}), (r["result"] is not None, r["result"], r["id"])
                if at not in found or reply[:2] < found[at][:2]:
                    found[at] = reply
        answered = [i for i in replies if i in waiting]
        for i in answered:
            yield self._answer(waiting.pop(i), replies.pop(i))

        early, known_early, met = [], set(), False
        for i, at, result in self.early.get() if asked or replies else ():
            same = _same(i)
            if same in asked:
                met = True
                replies.setdefault(same, {}).setdefault(at, (result is not None, result, i))
            else:
                early.append((i, at, result))
                known_early.add((same, at))
        pending = []
        for i, request in asked.items():
            in_time = {at: r for at, r in replies.pop(i, {}).items() if request[1] <= at <= request[1] + self.timeout_us}
            if in_time:
                yield self._answer(request, in_time)
            else:
                pending.append(request)
        fresh = [(r[2], at, r[1]) for i, found in replies.items() for at, r in found.items() if (i, at) not in known_early]
        self._store(self.pending, [*waiting.values()], pending, bool(answered))
        self._store(self.early, early, fresh, met)
        self._wake([self._expiry(at) for _, at, _ in pending] + [at // 1000 + 1 for _, at, _ in fresh], timerValues.getCurrentWatermarkInMs())

    def _answer(self, request: tuple, replies: dict[int, tuple]) -> Row:
        first = min(replies)
        return Row(id=request[0], at=request[1], ask=request[2], replied=first, result=replies[first][1], error=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        pending, early = list(self.pending.get()), list(self.early.get())
        waiting = [p for p in pending if self._expiry(p[1]) > now]
        for i, at, ask in pending:
            if self._expiry(at) <= now:
                yield Row(id=i, at=at, ask=ask, replied=None, result=None, error="TIMEOUT")
        later = [e for e in early if e[1] // 1000 + 1 > now]
        self._store(self.pending, waiting, [], len(waiting) < len(pending))
        self._store(self.early, later, [], len(later) < len(early))
        self._wake([self._expiry(at) for _, at, _ in waiting] + [at // 1000 + 1 for _, at, _ in later], now)

    def close(self) -> None:
        pass


def match_replies(requests: DataFrame, replies: DataFrame, timeout: str, delay: str, key: str = "request_id", result: str = "result",
                  groups: int = GROUPS) -> DataFrame:
    """Each request with its first reply inside the timeout, in the batch of that reply, or with TIMEOUT.

    The time limit is inclusive, request ids are unique (of requests with one id that wait together the
    first counts), rows without an id are dropped. The state of a request goes when it is answered or
    when the watermark has passed its limit.

    Ids are dealt to ``groups`` groups by their hash. A task holds the rows that one batch and the state have of
    a group, and rewrites what waits in it when one of them leaves. Like the number of shuffle partitions, it
    cannot change between runs from one checkpoint.
    """
    use_rocksdb(requests.sparkSession)
    others = [c for c in requests.columns if c not in (key, "ts")]
    ask = F.struct(F.lit(True).alias("_"), *others)
    kind = replies.schema[result].dataType
    sides = [
        requests.withWatermark("ts", delay).select(F.col(key).alias("id"), "ts", F.unix_micros("ts").alias("at"), F.lit(0).alias("kind"),
                                                  ask.alias("ask"), F.lit(None).cast(kind).alias("result"))]
    ask_type = sides[0].schema["ask"].dataType
    sides.append(replies.withWatermark("ts", delay).select(
        F.col(key).cast(requests.schema[key].dataType).alias("id"), "ts", F.unix_micros("ts").alias("at"), F.lit(1).alias("kind"),
        F.lit(None).cast(ask_type).alias("ask"), F.col(result).alias("result")))
    rows = sides[0].union(sides[1]).filter("id IS NOT NULL AND ts IS NOT NULL")
    timeout_us = _micros(requests.sparkSession, timeout)
    out = T.StructType([T.StructField("id", requests.schema[key].dataType), T.StructField("at", T.LongType()), T.StructField("ask", ask_type),
                        T.StructField("replied", T.LongType()), T.StructField("result", kind), T.StructField("error", T.StringType())])
    matcher = ReplyMatcher(requests.schema[key].dataType, ask_type, kind, timeout_us)
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    matched = dealt.groupBy("group").transformWithState(matcher, out, "Append", "EventTime")
    at = {key: F.col("id"), "ts": F.timestamp_micros("at")}
    return matched.select(*[at.get(c, F.col(f"ask.`{c}`")).alias(c) for c in requests.columns],
                          F.timestamp_micros("replied").alias("replied_at"), F.col("result").alias(result), "error")


def _micros(spark: SparkSession, interval: str) -> int:
    start = F.timestamp_seconds(F.lit(0))
    return spark.range(1).select(F.unix_micros(start + F.expr(f"INTERVAL '{interval}'"))).first()[0]


class Numbering(StatefulProcessor):
    """Per key: how many rows have been numbered."""

    def __init__(self, order: Sequence[str], name: str):
        self.order, self.name = list(order), name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        seen = self.seen.get()[0] if self.seen.exists() else 0
        self.seen.update((seen + len(batch),))
        batch[self.name] = np.arange(seen + 1, seen + len(batch) + 1)
        yield batch

    def close(self) -> None:
        pass


def number_messages(stream: DataFrame, order: Sequence[str], key: str = "module", name: str = "counter") -> DataFrame:
    """Every message with its number within its key, from 1 on, across batches.

    Messages of a batch are numbered by ``order``, those of later batches go on from there, so a stream that
    delivers them in order gets the numbers of the batch form. A task holds the messages that one batch
    has of a key: the source's rate bounds them.
    """
    use_rocksdb(stream.sparkSession)
    out = T.StructType([*stream.schema.fields, T.StructField(name, T.LongType())])
    return stream.groupBy(key).transformWithStateInPandas(Numbering(order, name), out, "Append", "None")
