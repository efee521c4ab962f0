"""Replies matched in groups of ids: the same rows as id by id, with a few calls to the state per group and batch."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tests.conftest import rows
from tidemark.operators import messages as M
from tidemark.streaming import replay, stateful

TIMEOUT = 60_000_000


class Handle:
    """The state of one group in memory; counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.lists = 0, set(), {}

    def getListState(self, name, schema):
        return self.lists.setdefault(name, Listed(self))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))


class Listed:
    def __init__(self, handle):
        self.handle, self.rows = handle, []

    def get(self):
        self.handle.calls += 1
        return iter(list(self.rows))

    def appendList(self, values):
        self.handle.calls += 1
        self.rows += values

    def clear(self):
        self.handle.calls += 1
        self.rows = []


def started():
    matcher, handle = stateful.ReplyMatcher(T.DoubleType(), T.StructType(), T.StringType(), TIMEOUT), Handle()
    matcher.init(handle)
    return matcher, handle


def batch(matcher, handle, given, watermark):
    """Rows of one batch: first the input, then the timers that the watermark has passed."""
    times, out = TimerValues(-1, watermark), []
    if given:
        out += matcher.handleInputRows((0,), iter(given), times)
    while due := [t for t in sorted(handle.timers) if t <= watermark]:
        out += matcher.handleExpiredTimer((0,), times, ExpiredTimerInfo(due[0]))
        handle.timers.discard(due[0])
    return sorted((str(r.id), r.at, r.ask, r.replied, r.result, r.error) for r in out)


def ask(i, at, who="a"):
    return Row(id=i, at=at, kind=0, ask=(True, who), result=None)


def reply(i, at, result="r"):
    return Row(id=i, at=at, kind=1, ask=None, result=result)


class ById:
    """The rule, one id at a time."""

    def __init__(self):
        self.pending, self.early = {}, {}

    def batch(self, given, watermark):
        out, new = [], {}
        for r in given:
            asks, found = new.setdefault(str(r.id), ([], {}))
            if r.kind == 0:
                asks.append(r)
            else:
                found[r.at] = min(found.get(r.at, (True, "~")), (r.result is not None, r.result))
        for i, (asks, found) in new.items():
            if i not in self.pending and asks:
                found = self.early.pop(i, {}) | found
            if i not in self.pending and not asks:
                self.early[i] = found | self.early.get(i, {})
                continue
            at, who = self.pending.get(i) or (asks[0].at, asks[0].ask)
            in_time = [a for a in found if at <= a <= at + TIMEOUT]
            if in_time:
                self.pending.pop(i, None)
                out.append((i, at, who, min(in_time), found[min(in_time)][1], None))
            else:
                self.pending[i] = at, who
        for i, (at, who) in list(self.pending.items()):
            if (at + TIMEOUT) // 1000 + 1 <= watermark:
                del self.pending[i]
                out.append((i, at, who, None, None, "TIMEOUT"))
        for i, found in list(self.early.items()):
            self.early[i] = {a: r for a, r in found.items() if a // 1000 + 1 > watermark}
        return sorted(out)


@pytest.mark.parametrize("seed", range(8))
def test_rows_of_a_group_are_those_of_each_id(seed):
    rng = random.Random(seed)
    (matcher, handle), want = started(), ById()
    ids = [float("nan"), *map(float, range(12))]
    for k in range(60):
        now = k * 15_000_000
        watermark = max(0, now // 1000 - 10_000)
        given = [rng.choice((ask, reply))(float(rng.choice(ids)), max(watermark * 1000 + 1, now + rng.randrange(-9, 15) * 1_000_000 + rng.randrange(3)),
                                          rng.choice(("x", "y", "z"))) for _ in range(rng.randrange(8))]
        given += [Row(id=1.0, at=now, kind=1, ask=None, result=None)] * rng.randrange(2)
        assert batch(matcher, handle, given, watermark) == want.batch(given, watermark)
        assert {str(i) for i, _, _ in handle.lists["pending"].rows} == set(want.pending)
        assert sorted((str(i), at, r) for i, at, r in handle.lists["early"].rows) == sorted(
            (i, at, r) for i, found in want.early.items() for at, (_, r) in found.items())
    end = batch(matcher, handle, [], 10**9)
    assert end == want.batch([], 10**9) and not handle.timers and not any(s.rows for s in handle.lists.values())


def test_calls_do_not_grow_with_the_ids():
    """Half are answered at once, a quarter later, a quarter never; every request took several calls."""
    matcher, handle = started()
    n = 800
    got = batch(matcher, handle, [ask(float(i), i) for i in range(n)] + [reply(float(i), i + 5) for i in range(0, n, 2)], 0)
    assert len(got) == n // 2
    got = batch(matcher, handle, [reply(float(i), i + 9) for i in range(1, n, 4)], 0)
    assert len(got) == n // 4
    got = batch(matcher, handle, [], 100_000)
    assert [g[-1] for g in got] == ["TIMEOUT"] * (n // 4)
    assert handle.calls < 40


def test_a_stream_in_shared_groups_equals_the_batch_form(spark, folder):
    rng, t0, asked, replies = random.Random(7), datetime(2024, 1, 1), [], []
    for i in range(300):
        asked.append((i, f"u{i % 7}", t0 + timedelta(seconds=i)))
        replies += [(i, t0 + timedelta(seconds=i + rng.choice((0, 1, 8, 30, 60, 61, 90))), f"r{k}") for k in range(rng.randrange(3))]
    end = t0 + timedelta(seconds=9999)
    req, rep = "request_id INT, user STRING, ts TIMESTAMP", "request_id INT, ts TIMESTAMP, result STRING"
    want = rows(M.request_reply(spark.createDataFrame(asked, req), spark.createDataFrame(replies, rep)))
    for name, schema, values, at in (("req", req, [*asked, (-1, "end", end)], 2), ("rep", rep, [*replies, (-2, end, "end")], 1)):
        ordered = spark.createDataFrame(sorted(values, key=lambda r: r[at]), schema)
        ordered.coalesce(1).write.parquet(f"{folder}/{name}")
    stream = lambda name, schema: replay.replay_rows(spark, f"{folder}/{name}", T._parse_datatype_string(schema), 90, f"{folder}/{name}_files")
    out = stateful.match_replies(stream("req", req), stream("rep", rep), "60 seconds", "200 seconds", groups=3)
    replay.run_to_end(out, f"{folder}/state", lambda df, i: df.write.mode("overwrite").parquet(f"{folder}/out/batch={i}"))
    got = spark.read.schema(out.schema).parquet(f"{folder}/out").filter("request_id >= 0")
    assert rows(got, "request_id", "user", "ts", "replied_at", "result", "error") == want
