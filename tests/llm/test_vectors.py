"""Whitening and hard negatives against plain numpy, on the small tables and on planted cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM
from tidemark.llm import hard_negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{MEDIUM}/embeddings.parquet")


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def whitened_brute(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    y = x - s / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], e[::-1], u[:, ::-1], y, v


def test_whitening_equals_numpy(table):
    rows = sorted((r.vec_id, r.embedding) for r in table.collect() if usable(r.embedding))
    n, deviation, e, u, y, v = whitened_brute([r[1] for r in rows])
    at = {i: k for k, (i, _) in enumerate(rows)}
    got = whitening.embedding_whitening(table).collect()
    assert len(got) == 8 * n
    signs = {}
    for r in got:
        k, c = at[r.vec_id], r.component - 1
        want = float(y[k] @ u[:, c] / np.sqrt(e[c]))
        sign = signs.setdefault(c, 1 if (r.whitened > 0) == (want > 0) else -1)
        assert r.whitened * sign == pytest.approx(want, abs=1e-8)
        assert (r.n, r.deviation) == (n, deviation[k])
        assert r.explained == pytest.approx(e[c] / np.trace(v), rel=1e-10)
        assert r.identity_error < 1e-10


def test_eigenvectors_to_double_precision():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 7, 30, 65):
        x = rng.normal(size=(3 * d, d)) * np.logspace(0, -5, d)
        values, vectors = whitening.eigen(x.T @ x)
        true = np.linalg.svd(x, compute_uv=False) ** 2
        assert np.allclose(values, true, rtol=1e-5) and np.all(np.diff(values) <= 0)
        assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13
        assert np.abs(x.T @ x @ vectors - vectors * values).max() < 1e-12 * values[0]


def test_cholesky_stops_at_the_rank():
    x = np.array([[1.0, 2, 3, 4], [2, 4, 6, 8], [0, 1, 0, 1]])
    factor, order = whitening.cholesky(x.T @ x)
    assert factor.shape == (4, 2) and np.allclose(factor @ factor.T, (x.T @ x)[np.ix_(order, order)])


def test_whitening_edges(spark):
    rows = [(1, [1.0, 2.0, 0.0], 1), (1, [1.0, 2.0, 0.0], 1), (2, [0.5, None, 1.0], 1), (3, None, 1), (4, [NAN, 0.0, 0.0], 1), (5, [INF, 0.0, 0.0], 1),
            (None, [3.0, -1.0, 0.0], None), (6, [], 1), (7, [1.0], 1), (8, [0.25, 0.5, 0.0], 2)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("v", "n", "high", "low", "i", "j", "whitened", "dim")})
    got = whitening.embedding_whitening(table).collect()
    ids = sorted(str(r.vec_id) for r in got)
    assert ids == sorted(["1", "1", "8", "None"] * 2)  # two directions vary, the third does not
    n, deviation, e, u, y, v = whitened_brute([[1, 2, 0], [1, 2, 0], [3, -1, 0], [0.25, 0.5, 0]])
    assert {r.n for r in got} == {4} and {r.deviation for r in got if r.vec_id == 1} == {deviation[0]}
    assert whitening.embedding_whitening(table.limit(0)).collect() == []
    assert whitening.embedding_whitening(table.filter("vec_id = 1")).collect() == []  # equal rows, no variance
    big = spark.createDataFrame([(i, [3e38 * (-1) ** i, 1e30 * i, 0.5], 1) for i in range(4)], SCHEMA)
    assert all(r.deviation is None for r in whitening.embedding_whitening(big).collect())


def test_whitening_does_not_depend_on_the_split(table):
    a, b = whitening.fit(table), whitening.fit(table.repartition(7))
    assert a.sums == b.sums and (a.values == b.values).all() and (a.components == b.components).all()


def negatives_brute(rows, every=50):
    rows = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [int(np.floor(np.float64(x) * 256)) for x in v])
            for i, v, label in rows if label is not None and usable(v)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, label, v in rows:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if len(v) == len(w)]
        good = sorted([s for s in scored if s[2] == label and s[1] != i], key=order)[:5]
        for p, j, _ in good:
            bad = sorted([s for s in scored if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p], key=order)[:3]
            out += [(i, j, k + 1, b[1], p, b[0]) for k, b in enumerate(bad)]
    return sorted(out, key=str)


def mined(table):
    return sorted(map(tuple, hard_negatives.hard_negatives(table).collect()), key=str)


def test_hard_negatives_equal_brute_force(table):
    want = negatives_brute([tuple(r) for r in table.select("vec_id", "embedding", "label").collect()])
    assert mined(table) == want and len(want) > 50


def test_hard_negatives_in_small_blocks(table):
    relabel = lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    small = sorted(map(tuple, hard_negatives.mine(table, relabel=relabel, block_entries=1).collect()), key=str)
    assert small == mined(table)


@pytest.mark.parametrize("dim", [1, 2, 3, 5, 8, 33])
def test_hard_negatives_on_ties_and_odd_lengths(spark, dim):
    rng = random.Random(dim)
    rows = [(i, [rng.choice((0.0, 0.004, 0.5, 1.0, -0.25)) for _ in range(dim)], rng.randrange(3)) for i in range(300)]
    rows += [(None, [0.5] * dim, 1), (50, [0.5] * dim, 2)] + [(1000 + i, [0.5] * dim, i % 2) for i in range(200)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert mined(table) == negatives_brute([tuple(r) for r in table.collect()])


def test_hard_negative_edges(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], None), (4, None, 2), (5, [None, 1.0], 2),
            (6, [NAN, 1.0], 2), (8, [INF, 1.0], 2), (9, [], 2), (None, [0.8, 0.8], 3), (50, [], 2), (100, [1.0, 0.0, 0.0], 4), (10, [0.9, 0.5], 2)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "v", "dim", "number", "block", "place", "at", "n")})
    assert mined(table) == negatives_brute(rows)
    assert mined(table.limit(0)) == []
    assert mined(table.filter("vec_id = 0")) == []
    big = spark.createDataFrame([(i, [3e38, 1.0], i % 2) for i in range(0, 200, 25)], SCHEMA)
    assert all(r[4] == (1 << 63) - 1 for r in mined(big))


def test_bounds_hold_and_pass_rows_over():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 4)).repeat(16, axis=1)
    x = np.floor(256 * (centres[rng.integers(0, 20, 2000)] + 0.05 * rng.normal(size=(2000, 64)))).astype(np.int64)
    block = hard_negatives.Block(np.arange(2000), np.zeros(2000, bool), np.zeros(2000, np.int64), x)
    exact, rows, left = x @ x[0], np.arange(2000), []
    for bound in block.bounds(x[0]):
        low, high = bound(rows)
        assert (low <= exact).all() and (exact <= high).all()
        left.append(int((high >= np.sort(low)[-5]).sum()))
    assert left == sorted(left, reverse=True) and left[-1] < 300
