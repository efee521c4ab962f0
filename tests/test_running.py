"""Long series give the same values as one window over the whole series."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import series as S
from tidemark.operators.running import id_block, running, split_hot, with_group_stats, with_row_number


@pytest.fixture(scope="module")
def steps(spark):
    """A third of all rows belongs to series 0, one series is NULL, values hold NULLs."""
    e = spark.read.parquet(f"{SMALL}/events.parquet")
    return e.select(
        F.expr("CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN NULL ELSE user_id END").alias("series"),
        F.col("event_id").alias("t"), F.expr("CAST(value * 100 AS BIGINT)").alias("x"),
        F.expr("IF(event_id % 7 = 0, NULL, event_type)").alias("label"),
        F.expr("IF(event_type = 'purchase', 1, 0)").alias("done"), F.col("value"))


@pytest.mark.parametrize("hot_rows", [10**9, 50, 0])
@pytest.mark.parametrize("block", [1, 37, 10**6])
def test_running_equals_window(steps, hot_rows, block):
    got = running(steps, ["series"], ["t"], id_block("t", block), sums={"total": F.col("x")},
                  sums_before={"before": F.col("done")}, row_number="n",
                  lag={"prev": (F.col("label"), "none")}, lead={"next": (F.col("x"), -1)}, hot_rows=hot_rows)
    w = Window.partitionBy("series").orderBy("t")
    want = steps.select(
        "*", F.sum("x").over(w).alias("total"),
        F.coalesce(F.sum("done").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.row_number().over(w).alias("n"), F.lag("label", 1, "none").over(w).alias("prev"),
        F.lead("x", 1, -1).over(w).alias("next"))
    names = ["series", "t", "total", "before", "n", "prev", "next"]
    assert rows(got, *names) == rows(want, *names)


def test_row_number_of_the_whole_table(steps):
    got = with_row_number(steps, "n", ["t"], id_block("t", 64))
    want = steps.withColumn("n", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("t")))
    assert rows(got, "t", "n") == rows(want, "t", "n")


def test_split_hot_keeps_every_row(steps):
    cold, hot = split_hot(steps, ["series"], 50)
    assert cold.count() + hot.count() == steps.count()
    assert {r["series"] for r in hot.select("series").distinct().collect()} == {0, None}
    assert split_hot(steps, ["series"], 10**9)[1] is None


@pytest.mark.parametrize("hot_rows", [10**9, 50, 0])
def test_group_stats(steps, hot_rows):
    got = with_group_stats(steps, ["series"], {"m": F.max("x"), "n": F.count(F.lit(1))}, hot_rows)
    w = Window.partitionBy("series")
    want = steps.select("*", F.max("x").over(w).alias("m"), F.count(F.lit(1)).over(w).alias("n"))
    assert rows(got, "series", "t", "m", "n") == rows(want, "series", "t", "m", "n")


@pytest.mark.parametrize("hot_rows", [10**9, 50])
def test_series_operators_on_a_hot_series(steps, hot_rows):
    known = steps.filter("series IS NOT NULL")
    block = id_block("t", 40)
    pid = S.pid_signal(known, "series", "t", "value", block, setpoint=50.0, low=-500, high=500, hot_rows=hot_rows)
    td = S.td_returns(known, "series", "t", block, reward="value", value="value", hot_rows=hot_rows)
    z = S.normalise(known, "series", "value", "z", hot_rows=hot_rows)
    ep = S.with_episode(known, "series", "t", block, hot_rows=hot_rows)
    got = {n: rows(df.select("series", "t", F.round(c, 6))) for n, df, c in
           (("pid", pid, "output"), ("td", td, "advantage"), ("z", z, "z"), ("ep", ep, "episode"))}
    per = {}
    for r in known.orderBy("series", "t").collect():
        per.setdefault(r["series"], []).append(r)
    want = {"pid": [], "td": [], "ep": [], "z": []}
    for series, rs in per.items():
        total = last = 0.0
        episode = 0
        mean = sum(r["value"] for r in rs) / len(rs)
        std = (sum((r["value"] - mean) ** 2 for r in rs) / (len(rs) - 1)) ** 0.5 if len(rs) > 1 else None
        for i, r in enumerate(rs):
            e = 50.0 - r["value"]
            total += e
            want["pid"].append((series, r["t"], max(-500, min(500, e + 0.1 * total + 0.05 * (e - last)))))
            last = e
            nxt = rs[i + 1]["value"] if i + 1 < len(rs) else 0.0
            want["td"].append((series, r["t"], r["value"] + 0.99 * nxt * (1 - r["done"]) - r["value"]))
            want["ep"].append((series, r["t"], episode))
            episode += r["done"]
            want["z"].append((series, r["t"], None if std is None else (r["value"] - mean) / (std + 1e-8)))
    for name, expected in want.items():
        expected.sort()
        assert len(got[name]) == len(expected)
        for a, b in zip(got[name], expected):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-5), name


def test_scores_of_rows_with_missing_features(spark):
    from tidemark.operators import regression as L
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0), (float("nan"), 1.0)], "x DOUBLE, y DOUBLE")
    model = L.fit_regression(df, "y", ["x"])
    got = {str(r.x): r.prediction for r in L.predict(model, df).collect()}
    assert got["2.0"] == pytest.approx(4.0) and got["None"] is None and got["nan"] is None and len(got) == 5
    assert tuple(L.usable_rows(df, "y", ["x"]).first()) == (3, 2)
    assert L.assemble(df, ["x"]).count() == 5


def test_constant_columns(spark):
    from tidemark.operators import regression as L
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (None, 3.0)], "x DOUBLE, prediction DOUBLE")
    assert [r.x_scaled for r in L.scale(df, ["x"]).collect()] == [0.0, 0.0, None]
    assert L.regression_metrics(df.filter("x IS NOT NULL"), "x").first()["r2"] is None
