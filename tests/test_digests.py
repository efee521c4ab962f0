"""Comparison by digest trees and grids by index arithmetic."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.operators import cdc, digests
from tidemark.operators import series as S
from tidemark.plans.registry import Tables

SCHEMA = "k BIGINT, name STRING, amount DOUBLE"


def table(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def brute(one, two):
    out = []
    for k in {r[0] for r in one + two}:
        a, b = sorted((r for r in one if r[0] == k), key=str), sorted((r for r in two if r[0] == k), key=str)
        more = [r for r in set(a) | set(b) if a.count(r) != b.count(r)]
        n, m = (sum(max(0, x.count(r) - y.count(r)) for r in more) for x, y in ((a, b), (b, a)))
        if more:
            out.append((k, n, m, "missing" if not m else "extra" if not n else "changed"))
    return sorted(out, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("depth", [None, 1, 3])
def test_reconcile_names_the_keys(spark, depth):
    rng = random.Random(5)
    one = [(i, f"n{rng.randrange(50)}", rng.choice((None, 1.5, -0.0, float(i)))) for i in range(400)] + [(7, "twice", 1.0), (7, "twice", 1.0), (None, "x", 1.0)]
    two = [r for r in one if rng.random() > 0.05]
    two = [(k, "edited", a) if rng.random() < 0.05 else (k, n, None if rng.random() < 0.03 else a) for k, n, a in two] + [(5000, "new", None), (7, "twice", 1.0)]
    got = digests.reconcile_rows(table(spark, one), table(spark, two), ["k"], depth)
    assert rows(got, "k", "source_rows", "target_rows", "status") == brute(one, two)


def test_nulls_do_not_move_between_columns(spark):
    one = spark.createDataFrame([(1, None, "a"), (2, "a", None)], "k INT, x STRING, y STRING")
    two = spark.createDataFrame([(1, "a", None), (2, "a", None)], "k INT, x STRING, y STRING")
    assert rows(digests.reconcile_rows(one, two, ["k"]), "k", "status") == [(1, "changed")]


def test_equal_and_empty_tables(spark):
    one = table(spark, [(i, "n", float(i)) for i in range(300)])
    assert digests.reconcile_rows(one, one.repartition(7), ["k"]).collect() == []
    assert digests.reconcile_rows(one.limit(0), one.limit(0), ["k"]).collect() == []
    assert digests.reconcile_rows(one, one.limit(0), ["k"]).filter("status = 'missing'").count() == 300
    assert digests.reconcile_rows(one.limit(0), one, ["k"]).filter("status = 'extra'").count() == 300
    cast = one.withColumn("k", F.col("k").cast("int"))
    assert digests.reconcile_rows(one, cast, ["k"]).collect() == []
    with pytest.raises(ValueError, match="different columns"):
        digests.reconcile_rows(one, one.drop("name"), ["k"])


def test_only_ranges_that_differ_are_read(spark):
    one = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").cast("double").alias("amount"))
    two = one.withColumn("name", F.when(F.col("k") % 1000 == 1, "edited").otherwise(F.col("name")))  # 0.1 % of the keys
    left, right = digests._differing_rows(one, two, ["k"])
    assert 20 <= left.count() == right.count() <= 20 * 6 * digests.RANGE_ROWS
    assert digests.reconcile_rows(one, two, ["k"]).count() == 20


def test_a_kept_tree_is_compared_with_a_later_state(spark):
    one = table(spark, [(i, "n", 0.0) for i in range(500)])
    kept = digests.digest_tree(one, ["k"], 2)
    later = one.filter("k <> 17")
    ranges = digests.differing_ranges(kept, digests.digest_tree(later, ["k"], 2, dict(kept.types)))
    assert ranges.count() == 1 and 17 in {r.k for r in digests.in_ranges(one, kept, ranges).collect()}
    with pytest.raises(ValueError, match="cannot be compared"):
        digests.differing_ranges(kept, digests.digest_tree(later, ["k"], 1))


def test_captured_changes_are_the_same(spark):
    t = Tables(spark, SMALL)
    before = t.fixture("base")
    after = cdc.merge_cdc(before, t.fixture("chg"), ["k"])
    assert rows(digests.capture_changes(before, after, ["k"], "0x1")) == rows(cdc.capture_changes(before, after, ["k"], "0x1"))


def test_grid_by_index_arithmetic(spark):
    source = spark.createDataFrame([(1.0, "a", 5), (2.0, None, 5), (None, "b", 6), (1.0, "c", 7)], "x DOUBLE, y STRING, z INT")
    got = S.cross_grid({"x": F.col("x"), "y": F.col("y"), "z": F.col("z")}, source)
    assert got.columns == ["x", "y", "z"]
    assert rows(got) == sorted((x, y, z) for x in (1.0, 2.0) for y in "abc" for z in (5, 6, 7))
    assert S.cross_grid({"x": F.col("x"), "y": F.lit(None).cast("string")}, source).count() == 0
    assert S.cross_grid({"x": F.col("x")}, source.limit(0)).count() == 0


def test_grid_of_many_values(spark):
    source = spark.range(100_000).select("id", (F.col("id") % 3).alias("few"))
    numbers = S.numbered_values(source, F.col("id"), "id").agg(F.count_distinct("_i"), F.min("_i"), F.max("_i")).first()
    assert tuple(numbers) == (100_000, 0, 99_999)
    got = S.cross_grid({"a": F.col("id"), "b": F.col("few")}, source)
    assert tuple(got.agg(F.count("*"), F.count_distinct("a", "b")).first()) == (300_000, 300_000)
    with pytest.raises(ValueError, match="combinations"):
        S.cross_grid({c: F.col("id") for c in "abcd"}, source)
