"""Comparing two tables by trees of digests, so that only ranges of keys that differ are joined.

A row lies at the hash of its key; its digest is two hashes of all its values. A node is a range of
hashes with the number of its rows and the sums of their digests, which do not depend on the order of rows.
Nodes of two trees are compared from the top, and below a node that agrees nothing is looked at. Rows in
the ranges that are left are compared themselves, so a collision of digests can hide a difference (with
a chance of about 2**-128), but never make one up.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.session import ensure_checkpoint_dir

#: Bits of the hash per level: a node has up to 256 children.
FAN_BITS = 8
#: Rows that a lowest range holds on average.
RANGE_ROWS = 4
_SEEDS = (b"first", b"second")


@dataclass(frozen=True)
class DigestTree:
    """Levels of nodes from the top: node, n, a, b. It may be kept and compared with a later state of the table."""

    keys: tuple[str, ...]
    types: tuple[tuple[str, str], ...]
    levels: tuple[DataFrame, ...]

    @property
    def depth(self) -> int:
        return len(self.levels)


def _place(keys: Sequence[str], types: dict[str, str], depth: int) -> Column:
    """Number of the lowest range of a row: the first bits of the hash of its key."""
    key = F.xxhash64(*[c for k in keys for c in (F.col(f"`{k}`").cast(types[k]), F.col(f"`{k}`").isNull())])
    return F.shiftrightunsigned(key, 64 - FAN_BITS * depth)


def _depth(rows: int) -> int:
    return max(1, min(7, math.ceil(math.log2(max(rows, 1) / RANGE_ROWS + 1) / FAN_BITS)))


def digest_tree(rows: DataFrame, keys: Sequence[str], depth: int | None = None, types: dict[str, str] | None = None) -> DigestTree:
    """The tree over ``rows``. Trees to compare need the same keys, depth and column types (``types``, by name)."""
    types = types or {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    depth = depth or _depth(rows.count())
    ensure_checkpoint_dir(rows.sparkSession)
    values = [c for n, kind in sorted(types.items()) for c in (F.col(f"`{n}`").cast(kind), F.col(f"`{n}`").isNull())]
    digests = [F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)").alias(name) for seed, name in zip(_SEEDS, "ab")]
    sums = [F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")]
    nodes = rows.select(_place(keys, types, depth).alias("node"), F.lit(1).cast("bigint").alias("n"), *digests).groupBy("node").agg(*sums)
    levels = [nodes.checkpoint()]
    while len(levels) < depth:
        levels.append(levels[-1].groupBy(F.shiftrightunsigned("node", FAN_BITS).alias("node")).agg(*sums).checkpoint())
    return DigestTree(tuple(keys), tuple(sorted(types.items())), tuple(reversed(levels)))


def differing_ranges(one: DigestTree, two: DigestTree) -> DataFrame:
    """The lowest ranges (``node``) whose digests differ, found level by level."""
    if (one.keys, one.types, one.depth) != (two.keys, two.types, two.depth):
        raise ValueError("trees of different keys, columns or depth cannot be compared")
    above = None
    for left, right in zip(one.levels, two.levels):
        if above is not None:
            parent = F.shiftrightunsigned("node", FAN_BITS)
            left, right = (x.join(above.withColumnRenamed("node", "_up"), parent == F.col("_up"), "left_semi") for x in (left, right))
        both = left.select("node", *[F.col(c).alias(f"_{c}") for c in "nab"]).join(right, "node", "full_outer")
        same = reduce(lambda x, y: x & y, [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in "nab"])
        above = both.filter(~same).select("node").checkpoint()
    return above


def in_ranges(rows: DataFrame, tree: DigestTree, ranges: DataFrame) -> DataFrame:
    """The rows that lie in some lowest ranges of a tree."""
    return rows.join(ranges.withColumnRenamed("node", "__node"), _place(tree.keys, dict(tree.types), tree.depth) == F.col("__node"), "left_semi")


def _differing_rows(one: DataFrame, two: DataFrame, keys: Sequence[str], depth: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in the ranges that differ."""
    types = {f.name: f.dataType.simpleString() for f in one.schema.fields}
    if set(types) != set(two.columns):
        raise ValueError(f"tables of different columns: {sorted(types)} and {sorted(two.columns)}")
    depth = depth or _depth(one.count())
    trees = [digest_tree(x, keys, depth, types) for x in (one, two)]
    ranges = differing_ranges(*trees)
    return in_ranges(one, trees[0], ranges), in_ranges(two, trees[1], ranges)


def reconcile_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], depth: int | None = None) -> DataFrame:
    """Keys on which two tables differ: status ``missing`` (in the target), ``extra`` or ``changed``, and how many rows each side
    has that the other has not.

    Rows count as often as they occur, nulls are equal, no key needs to be unique. Columns are compared in
    the types of the source.
    """
    one, two = _differing_rows(source, target, keys, depth)
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in source.schema.fields]
    both = one.select(*columns, F.lit(1).alias("_n")).unionByName(two.select(*columns, F.lit(-1).alias("_n")))
    left = both.groupBy(*[F.col(f"`{c}`") for c in source.columns]).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    counted = left.groupBy(*keys).agg(F.sum(F.greatest("_n", F.lit(0))).alias("source_rows"), F.sum(-F.least("_n", F.lit(0))).alias("target_rows"))
    status = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    return counted.withColumn("status", status)


def capture_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], lsn: str | Column, depth: int | None = None) -> DataFrame:
    """:func:`cdc.capture_changes` that joins only the ranges of keys that differ; keys are unique on both sides."""
    cdc._check_keys(keys, before, after)
    one, two = _differing_rows(before, after, keys, depth)
    return cdc.capture_changes(one, two, keys, lsn)
