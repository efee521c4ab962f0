"""Controller and reward series on events, regression on lineitem."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import regression as L
from tidemark.operators import series as S
from tidemark.operators.running import id_block
from tidemark.plans.registry import query


@query("w4", """, e AS (SELECT series, t, 50.0 - measured AS error FROM sig),
p AS (SELECT *, sum(error) OVER (PARTITION BY series ORDER BY t) AS i, lag(error, 1, 0) OVER (PARTITION BY series ORDER BY t) AS l FROM e)
SELECT series, t, round(error, 4) AS error, round(greatest(-200.0, least(200.0, error + 0.1 * i + 0.05 * (error - l))), 4) AS output
FROM p""", using=("sig",))
def w4(t):
    out = S.pid_signal(t.fixture("sig"), "series", "t", "measured", id_block("t"), setpoint=50.0, low=-200.0, high=200.0)
    return out.select("series", "t", F.round("error", 4).alias("error"), F.round("output", 4).alias("output"))


TD = """, n AS (SELECT *, lead(v, 1, 0) OVER (PARTITION BY run ORDER BY t) AS nx FROM epi),
td AS (SELECT run, t, reward + 0.99 * nx * (1 - done) AS returns, reward + 0.99 * nx * (1 - done) - v AS advantage FROM n)"""


def td(t):
    return S.td_returns(t.fixture("epi"), "run", "t", id_block("t"))


@query("w5", TD + " SELECT run, t, round(returns, 6) AS returns, round(advantage, 6) AS advantage FROM td", using=("epi",))
def w5(t):
    return td(t).select("run", "t", F.round("returns", 6).alias("returns"), F.round("advantage", 6).alias("advantage"))


@query("w6", TD + """ SELECT run, t, round((advantage - avg(advantage) OVER (PARTITION BY run))
  / (stddev_samp(advantage) OVER (PARTITION BY run) + 1e-8), 4) AS z FROM td""", using=("epi",))
def w6(t):
    return S.normalise(td(t), "run", "advantage", "z").select("run", "t", F.round("z", 4).alias("z"))


EPISODES = """, ep AS (SELECT run, t, reward, CAST(coalesce(sum(done) OVER (PARTITION BY run ORDER BY t
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS episode FROM epi)"""


def rewards(t):
    steps = S.with_episode(t.fixture("epi"), "run", "t", id_block("t"))
    return S.episode_reward(steps, ["run", "episode"])


@query("a9", EPISODES + " SELECT run, episode, round(sum(reward), 4) AS total_reward, count(*) AS steps FROM ep GROUP BY 1, 2",
       using=("epi",))
def a9(t):
    return rewards(t).withColumn("total_reward", F.round("total_reward", 4))


@query("w9", EPISODES + """ SELECT run, episode, round(sum(reward), 4) AS total_reward, count(*) AS steps FROM ep
WHERE episode % 10 = 0 GROUP BY 1, 2""", using=("epi",))
def w9(t):
    return S.every_nth(rewards(t), 10).withColumn("total_reward", F.round("total_reward", 4))


@query("j7", "SELECT a.kp, b.ki, c.kd FROM (SELECT DISTINCT kp FROM grid) a, (SELECT DISTINCT ki FROM grid) b, "
             "(SELECT DISTINCT kd FROM grid) c", using=("grid",))
def j7(t):
    return S.cross_grid({"kp": F.col("kp"), "ki": F.col("ki"), "kd": F.col("kd")}, t.fixture("grid"))


@query("a6", """SELECT CASE WHEN grouping(kp) = 0 THEN 'kp' WHEN grouping(ki) = 0 THEN 'ki' ELSE 'kd' END AS param,
  coalesce(kp, ki, kd) AS value, round(CAST(sum(CAST(reward AS DECIMAL(28,8))) AS DOUBLE) / count(reward), 4) AS avg_reward FROM grid GROUP BY GROUPING SETS ((kp), (ki), (kd))""",
       using=("grid",))
def a6(t):
    return S.avg_by_param(t.fixture("grid"), ["kp", "ki", "kd"]).withColumn("avg_reward", F.round("avg_reward", 4))


KI = [0.025 * i for i in range(9)]


@query("a7", "SELECT kp, " + ", ".join(
    f"round(coalesce(CAST(sum(CAST(reward AS DECIMAL(28,8))) FILTER (WHERE ki = {v!r}::DOUBLE) AS DOUBLE) "
    f"/ nullif(count(reward) FILTER (WHERE ki = {v!r}::DOUBLE), 0), 0), 4) AS ki{i}" for i, v in enumerate(KI)) + " FROM grid GROUP BY kp",
    using=("grid",))
def a7(t):
    wide = S.grid_pivot(t.fixture("grid"), "kp", "ki", KI)
    return wide.select("kp", *[F.round(F.col(f"`{c}`"), 4).alias(f"ki{i}") for i, c in enumerate(wide.columns[1:])])


@query("a8", """SELECT kp, ki, kd, reward AS best_reward FROM grid WHERE reward > 0 ORDER BY reward DESC, kp, ki, kd LIMIT 1""",
       using=("grid",))
def a8(t):
    return S.best_params(t.fixture("grid"), ["kp", "ki", "kd"], (1.0, 0.1, 0.05))


@query("x3", "SELECT DISTINCT ki FROM grid", using=("grid",))
def x3(t):
    return S.distinct_values(t.fixture("grid"), "ki")


FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("a13", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, round(var_samp({c}), 2) AS variance, "
    f"round(stddev_samp({c}), 4) AS stddev FROM lineitem" for c in FEATURES))
def a13(t):
    s = L.column_stats(t.lineitem, FEATURES)
    return s.select("feature", "n", F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"),
                    F.round("stddev", 4).alias("stddev"))


def _scaled(c: str) -> str:
    return f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem), 4) AS {c}_scaled"


@query("l1", f"SELECT l_orderkey, l_linenumber, {', '.join(map(_scaled, FEATURES))} FROM lineitem")
def l1(t):
    s = L.scale(t.lineitem, FEATURES)
    return s.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_scaled", 4).alias(f"{c}_scaled") for c in FEATURES])


@query("l2", "SELECT l_orderkey, l_linenumber, l_quantity AS f1, l_discount AS f3 FROM lineitem")
def l2(t):
    v = vector_to_array("features")
    return L.assemble(t.lineitem, FEATURES).select("l_orderkey", "l_linenumber", v[0].alias("f1"), v[2].alias("f3"))


def one_feature(t, with_mean: bool = True):
    return L.fit_regression(t.lineitem, "l_extendedprice", ["l_quantity"], with_mean)


REGR = """(SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem)"""


@query("l3", f"SELECT round(s, 4) AS l_quantity, round(i, 3) AS intercept FROM {REGR}")
def l3(t):
    c = L.coefficients(one_feature(t), ["l_quantity"])
    return t.spark.range(1).select(F.round(F.lit(c["l_quantity"]), 4).alias("l_quantity"),
                                   F.round(F.lit(c["intercept"]), 3).alias("intercept"))


@query("l4", f"SELECT l_orderkey, l_linenumber, round(s * l_quantity + i, 3) AS prediction FROM lineitem, {REGR}")
def l4(t):
    return L.predict(one_feature(t, False), t.lineitem).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


@query("a14", """WITH e AS (SELECT l_extendedprice AS y, l_quantity * 1500 - l_extendedprice AS d FROM lineitem)
SELECT round(avg(abs(d)), 4) AS mae, round(avg(d * d), 1) AS mse, round(sqrt(avg(d * d)), 4) AS rmse,
  round(1 - avg(d * d) / var_pop(y), 6) AS r2 FROM e""")
def a14(t):
    scored = t.lineitem.select("l_extendedprice", (F.col("l_quantity") * 1500).alias("prediction"))
    m = L.regression_metrics(scored, "l_extendedprice")
    return m.select(F.round("mae", 4).alias("mae"), F.round("mse", 1).alias("mse"), F.round("rmse", 4).alias("rmse"),
                    F.round("r2", 6).alias("r2"))
