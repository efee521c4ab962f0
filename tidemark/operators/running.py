"""Running values, neighbours and row numbers over series of any length.

``Window.partitionBy(series)`` sorts a whole series in one task, so a series that
holds a third of the table makes one task do a third of the work. Series up to
``HOT_ROWS`` rows take that window, which is one shuffle. A longer one is cut into
blocks by a column that grows with the order (an id range, an hour): rows are
numbered and summed inside their block, one row per block carries the totals, and
the totals of the blocks before are added back by an equi join on (series, block).
The block is computed from the row itself, so a task that is run again after a
lost executor puts every row into the same block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "_rn_block"
_GROUP = "_rn_group"


def id_block(column: str | Column, rows: int = 1_000_000) -> Column:
    """Block of a dense integer order column: at most ``rows`` rows per block."""
    c = F.col(column) if isinstance(column, str) else column
    return F.call_function("div", c, F.lit(rows))


HOT_ROWS = 5_000_000


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the groups with at most ``hot_rows`` rows, and the rest (None when empty).

    One count over the key columns alone decides; ``None`` skips it where the groups
    are known to be small. The list of hot keys has at most rows / hot_rows entries; it
    is broadcast where that is few (``hot_rows`` of a million or more) and joined as
    Catalyst sees fit otherwise.
    """
    if hot_rows is None:
        return df, None
    hot = df.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(
        *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)])
    if hot.isEmpty():
        return df, None
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])
    listed = F.broadcast(hot) if hot_rows >= 1_000_000 else hot
    return df.join(listed, match, "left_anti"), df.join(listed, match, "left_semi")


def with_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column],
                     hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Attach aggregates of a row's group to the row.

    Groups up to ``hot_rows`` rows use a window, which is one shuffle. The statistics
    of larger groups are few, so they are aggregated map-side and broadcast back and
    the rows of a hot group stay spread.
    """
    cold, hot = split_hot(df, keys, hot_rows)
    w = Window.partitionBy(*keys)
    out = cold.select(*df.columns, *[e.over(w).alias(n) for n, e in stats.items()])
    if hot is None:
        return out
    rows = hot.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        *[e.alias(n) for n, e in stats.items()])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    listed = F.broadcast(rows) if hot_rows >= 1_000_000 else rows
    return out.unionByName(hot.join(listed, match).select(*df.columns, *stats))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    block: Column,
    *,
    sums: Mapping[str, Column] | None = None,
    sums_before: Mapping[str, Column] | None = None,
    row_number: str | None = None,
    lag: Mapping[str, tuple[Column, object]] | None = None,
    lead: Mapping[str, tuple[Column, object]] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add running columns to ``df``.

    ``order`` is ascending and must be total within a key; ``block`` must not
    decrease along it. ``sums`` include the current row, ``sums_before`` do not.
    ``lag`` and ``lead`` map an output name to (value, default at the end).
    Without ``keys`` the whole table is one series and is always cut into blocks.
    """
    spec = dict(sums=dict(sums or {}), before=dict(sums_before or {}), row_number=row_number,
                lag=dict(lag or {}), lead=dict(lead or {}))
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if not keys:
        return _blocked(df, [], order, block, **spec)
    short, long = split_hot(df, keys, hot_rows)
    out = _windowed(short, keys, order, **spec)
    return out if long is None else out.unionByName(_blocked(long, keys, order, block, **spec))


def _windowed(df, keys, order, *, sums, before, row_number, lag, lead) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    if row_number:
        out[row_number] = F.row_number().over(w).cast("bigint")
    out |= {n: F.coalesce(F.sum(e).over(upto), F.lit(0)) for n, e in sums.items()}
    out |= {n: F.coalesce(F.sum(e).over(prior), F.lit(0)) for n, e in before.items()}
    out |= {n: F.lag(e, 1, d).over(w) for n, (e, d) in lag.items()}
    out |= {n: F.lead(e, 1, d).over(w) for n, (e, d) in lead.items()}
    return df.select(*df.columns, *[e.alias(n) for n, e in out.items()])


def _blocked(df, keys, order, block, *, sums, before, row_number, lag, lead) -> DataFrame:
    position = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])

    tagged = df.withColumn(_BLOCK, block).withColumn(
        _GROUP, F.struct(*[F.col(k) for k in keys], F.col(_BLOCK)))
    totals = {**sums, **before}

    summary = [F.count(F.lit(1)).alias("_rows")]
    summary += [F.sum(e).alias(f"_sum_{n}") for n, e in totals.items()]
    summary += [F.max_by(F.struct(e.alias("v")), position).alias(f"_last_{n}") for n, (e, _) in lag.items()]
    summary += [F.min_by(F.struct(e.alias("v")), position).alias(f"_first_{n}") for n, (e, _) in lead.items()]
    per_block = tagged.groupBy(_GROUP).agg(*summary)
    across = Window.partitionBy(*[F.col(f"{_GROUP}.{k}") for k in keys]).orderBy(F.col(f"{_GROUP}.{_BLOCK}"))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        _GROUP,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_sum_{n}").over(earlier).alias(f"_off_{n}") for n in totals],
        *[F.lag(f"_last_{n}").over(across).alias(f"_prev_{n}") for n in lag],
        *[F.lead(f"_first_{n}").over(across).alias(f"_next_{n}") for n in lead],
    )

    within = Window.partitionBy(_GROUP).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    prior = within.rowsBetween(Window.unboundedPreceding, -1)
    local = {}
    if row_number:
        local["_pos"] = F.row_number().over(within)
    local |= {f"_run_{n}": F.sum(e).over(upto) for n, e in sums.items()}
    local |= {f"_run_{n}": F.sum(e).over(prior) for n, e in before.items()}
    local |= {f"_lag_{n}": F.lag(F.struct(e.alias("v"))).over(within) for n, (e, _) in lag.items()}
    local |= {f"_lead_{n}": F.lead(F.struct(e.alias("v"))).over(within) for n, (e, _) in lead.items()}
    joined = tagged.withColumns(local).join(offsets, _GROUP)

    zero = F.lit(0)
    out = {}
    if row_number:
        out[row_number] = (F.col("_pos") + F.col("_rows_before")).cast("bigint")
    for n in totals:
        out[n] = F.coalesce(f"_run_{n}", zero) + F.coalesce(f"_off_{n}", zero)
    for n, (_, default) in lag.items():
        near = F.coalesce(f"_lag_{n}", f"_prev_{n}")
        out[n] = F.when(near.isNull(), F.lit(default)).otherwise(near["v"])
    for n, (_, default) in lead.items():
        near = F.coalesce(f"_lead_{n}", f"_next_{n}")
        out[n] = F.when(near.isNull(), F.lit(default)).otherwise(near["v"])
    return joined.select(*df.columns, *[e.alias(n) for n, e in out.items()])


def with_row_number(df: DataFrame, name: str, order: Sequence[Column | str], block: Column,
                    keys: Sequence[str] = (), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """1-based row number over the whole table, or per ``keys``."""
    return running(df, list(keys), order, block, row_number=name, hot_rows=hot_rows)
