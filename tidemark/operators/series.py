"""Controller and reward series, parameter grids."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.running import HOT_ROWS, running, with_group_stats
from tidemark.session import ensure_checkpoint_dir

VALUE_BLOCKS = 1024
BROADCAST_VALUES = 1_000_000


def pid_signal(df: DataFrame, series: str, order: str, measured: str, block: Column, *, kp: float = 1.0,
               ki: float = 0.1, kd: float = 0.05, setpoint: float = 0.0, low: float = -1.0, high: float = 1.0,
               dt: float = 1.0, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Controller output per step: kp * e + ki * running sum(e * dt) + kd * difference / dt, clamped.

    The error before the first step is 0 and the integral is not bounded.
    """
    e = F.lit(setpoint) - F.col(measured)
    steps = running(df.withColumn("error", e), [series], [order], block,
                    sums={"_integral": F.col("error") * dt}, lag={"_last": (F.col("error"), 0.0)},
                    hot_rows=hot_rows)
    raw = (F.lit(kp) * F.col("error") + F.lit(ki) * F.col("_integral")
           + F.lit(kd) * (F.col("error") - F.col("_last")) / dt)
    return steps.withColumn("output", F.greatest(F.lit(low), F.least(F.lit(high), raw))).drop("_integral", "_last")


def td_returns(df: DataFrame, run: str, order: str, block: Column, gamma: float = 0.99,
               reward: str = "reward", value: str = "v", done: str = "done", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``returns = r + gamma * V(next step) * (1 - done)`` and ``advantage = returns - V``.

    The next step is the next one of the run, also across episodes; the last one uses 0.
    """
    steps = running(df, [run], [order], block, lead={"_next": (F.col(value), 0.0)}, hot_rows=hot_rows)
    ret = F.col(reward) + F.lit(gamma) * F.col("_next") * (1 - F.col(done))
    return steps.withColumn("returns", ret).withColumn("advantage", F.col("returns") - F.col(value)).drop("_next")


def normalise(df: DataFrame, run: str, column: str, out: str, eps: float = 1e-8,
              hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``(x - mean) / (sample standard deviation + eps)`` within a run."""
    stats = with_group_stats(df, [run], {"_mean": F.avg(column), "_std": F.stddev_samp(column)}, hot_rows)
    return stats.withColumn(
        out, (F.col(column) - F.col("_mean")) / (F.col("_std") + F.lit(eps))).drop("_mean", "_std")


def with_episode(df: DataFrame, run: str, order: str, block: Column, done: str = "done",
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Episode number within a run: the number of finished episodes before the step."""
    return running(df, [run], [order], block, sums_before={"episode": F.col(done).cast("bigint")}, hot_rows=hot_rows)


def episode_reward(df: DataFrame, keys: Sequence[str], reward: str = "reward") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(reward).alias("total_reward"), F.count(F.lit(1)).alias("steps"))


def every_nth(df: DataFrame, n: int, episode: str = "episode") -> DataFrame:
    """Report rows: each n-th episode."""
    return df.filter(F.pmod(F.col(episode), F.lit(n)) == 0)


def numbered_values(source: DataFrame, value: Column, name: str) -> DataFrame:
    """The distinct values of a column, NULL aside, numbered from 0 without gaps: ``name`` and ``_i``.

    Values are numbered inside blocks of their hashes, and the counts of earlier blocks are added; a task
    holds a block.
    """
    values = source.select(value.alias(name)).filter(F.col(name).isNotNull()).distinct()
    values = values.withColumn("_block", F.pmod(F.xxhash64(name), F.lit(VALUE_BLOCKS)))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = values.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).select(  # a row per block
        "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(name)) - 1
    return values.withColumn("_in", inside).join(F.broadcast(sizes), "_block").select(name, (F.col("_first") + F.col("_in")).alias("_i"))


def cross_grid(params: Mapping[str, Column], source: DataFrame) -> DataFrame:
    """Every combination of the distinct values of some columns of ``source``.

    Values are numbered once per parameter. A combination is a number below the product of their counts, and its
    digits, in the mixed base of the counts, are looked up as the values. So no row holds a set
    of values, and the product is cut into tasks like any range. A list of values is broadcast up to a million of them.
    """
    spark = source.sparkSession
    ensure_checkpoint_dir(spark)
    lists = {n: numbered_values(source, c, n).checkpoint() for n, c in params.items()}
    sizes = {n: v.count() for n, v in lists.items()}
    total = math.prod(sizes.values())
    if total >= 1 << 63:
        raise ValueError(f"{total} combinations")
    out, stride = spark.range(total), 1
    for n, size in reversed(sizes.items()):
        digit = F.pmod(F.call_function("div", F.col("id"), F.lit(stride).cast("bigint")), F.lit(max(size, 1)).cast("bigint"))
        values = F.broadcast(lists[n]) if size <= BROADCAST_VALUES else lists[n]
        out = out.join(values, digit == F.col("_i")).drop("_i")
        stride *= size
    return out.select(*params)


def exact_mean(column: str, digits: int = 8) -> Column:
    """Mean of a double column from an exact sum of its values at ``digits`` decimals, so that the
    order of the rows does not change it."""
    return F.sum(F.col(column).cast(f"decimal(28,{digits})")).cast("double") / F.count(column)


def avg_by_param(grid: DataFrame, params: Sequence[str], reward: str = "reward") -> DataFrame:
    """Mean reward per value of each parameter, all in one pass."""
    pairs = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("double").alias("value")) for p in params])
    return (grid.select(F.explode(pairs).alias("p"), reward)
            .groupBy(F.col("p.param").alias("param"), F.col("p.value").alias("value"))
            .agg(exact_mean(reward).alias("avg_reward")))


def grid_pivot(grid: DataFrame, row: str, column: str, values: Sequence[float], reward: str = "reward") -> DataFrame:
    """Matrix of mean rewards, 0 where there is none. ``values`` are the columns wanted."""
    return grid.groupBy(row).pivot(column, list(values)).agg(exact_mean(reward)).fillna(0.0)


def best_params(grid: DataFrame, params: Sequence[str], initial: Sequence[float],
                reward: str = "reward") -> DataFrame:
    """Parameters with the highest reward in one row.

    The first in parameter order wins a tie, and a reward must beat 0; otherwise the
    initial parameters stay with reward 0.
    """
    first = F.struct(F.col(reward).alias("r"), *[(-F.col(p)).alias(f"n{i}") for i, p in enumerate(params)])
    row = F.struct(F.col(reward).alias("best_reward"), *[F.col(p).cast("double").alias(p) for p in params])
    best = grid.agg(F.max_by(F.when(F.col(reward) > 0, row), F.when(F.col(reward) > 0, first)).alias("b"))
    return best.select(
        *[F.coalesce(F.col("b")[p], F.lit(float(i))).alias(p) for p, i in zip(params, initial)],
        F.coalesce(F.col("b.best_reward"), F.lit(0.0)).alias("best_reward"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Unique values, sorted."""
    return df.select(column).distinct().orderBy(column)
