"""The minimum-covariance-determinant estimate against numpy, and who is rejected by it."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import quality_rules as rules

N = rules.DIMS


def covariance(x):
    c = np.cov(x.T, bias=True) * rules.CONSISTENCY
    c[np.arange(N), np.arange(N)] += np.square(rules.FLOORS)
    return c


def distances(x, mean, cov):
    z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
    return (z * z).sum(axis=0)


def nearest(x, mean, cov):
    """The rows up to the step of distance in which 75 % of them are reached."""
    step = np.floor(rules.BINS * np.log1p(distances(x, mean, cov)))
    last = np.sort(step)[int(np.ceil(rules.SHARE * len(x))) - 1]
    return x[step <= last]


def concentrated(x, mean, cov, steps):
    for _ in range(steps):
        inner = nearest(x, mean, cov)
        mean, cov = inner.mean(axis=0), covariance(inner)
    return mean, cov


def best_of_starts(x):
    q = np.percentile(np.trunc(x * 100), [25, 50, 75], axis=0) / 100
    middle, spread = q[1], np.maximum((q[2] - q[0]) / 1.349, rules.FLOORS)
    z = (x - middle) / spread
    length = np.sqrt((z * z).sum(axis=1, keepdims=True))
    found = []
    for u in (None, np.divide(z, length, out=np.zeros_like(z), where=length > 0), np.tanh(z)):
        if u is not None:
            u = np.round(u * rules.UNIT) / rules.UNIT
        shape = np.eye(N) if u is None else u.T @ u / len(x)
        start = shape * np.outer(spread, spread) + np.diag(np.square(rules.FLOORS))
        found.append(concentrated(x, middle, start, rules.STEPS))
    return min(found, key=lambda f: np.linalg.slogdet(f[1])[1])


def random_starts(x, tries=60, seed=1):
    """The usual search: small random subsets, concentrated until nothing changes."""
    rng = np.random.default_rng(seed)
    logs = []
    for _ in range(tries):
        part = x[rng.choice(len(x), N + 1, replace=False)]
        _, cov = concentrated(x, part.mean(axis=0), covariance(part), 12)
        logs.append(np.linalg.slogdet(cov)[1])
    return min(logs)


def frame(spark, groups):
    rows = [(g, *map(int, row)) for g, x in groups.items() for row in x]
    return spark.createDataFrame(rows, "g string, " + ", ".join(f"x{i} long" for i in range(N)))


@pytest.fixture(scope="module")
def groups():
    """Integer vectors: correlated ones, ones with a cluster of outliers, constant ones, few ones."""
    rng = np.random.default_rng(3)
    mixing = np.eye(N) + 0.6 * rng.normal(size=(N, N))
    plain = rng.normal(size=(400, N)) @ mixing
    planted = np.vstack([rng.normal(size=(300, N)) @ mixing, 0.3 * rng.normal(size=(90, N)) + 6.0])
    tails = rng.standard_t(2, size=(250, N)) @ mixing
    sets = {"plain": plain, "planted": planted, "tails": tails, "constant": np.full((50, N), 2.5), "few": plain[:3], "one": plain[:1]}
    return {g: np.round(np.abs(x) * rules.UNIT).astype(np.int64) if g == "constant" else np.round((x + 20) * rules.UNIT).astype(np.int64)
            for g, x in sets.items()}


def test_estimates_equal_numpy_and_reach_the_smallest_determinant(spark, groups):
    got = {r.g: r for r in rules.minimum_determinants(frame(spark, groups)).collect()}
    assert got.keys() == groups.keys()
    for g, rows in groups.items():
        x = rows / rules.UNIT
        mean, cov = best_of_starts(x)
        factor = np.linalg.cholesky(cov)
        assert np.allclose([got[g][f"m{i}"] for i in range(N)], mean, rtol=1e-6, atol=1e-6), g
        assert np.allclose([got[g][f"l{i}{j}"] for i in range(N) for j in range(i + 1)], [factor[i, j] for i in range(N) for j in range(i + 1)], atol=1e-5), g
        assert abs(got[g].log_det - np.linalg.slogdet(cov)[1]) < 1e-5, g
        if len(rows) > 50:
            assert got[g].log_det <= random_starts(x) + 0.05, g


def test_a_cluster_of_outliers_does_not_move_the_estimate(spark, groups):
    x = groups["planted"] / rules.UNIT
    r = rules.minimum_determinants(frame(spark, {"planted": groups["planted"]})).first()
    factor = np.zeros((N, N))
    for i in range(N):
        for j in range(i + 1):
            factor[i, j] = r[f"l{i}{j}"]
    d2 = distances(x, np.array([r[f"m{i}"] for i in range(N)]), factor @ factor.T)
    assert (d2[300:] > rules.LIMIT).all() and (d2[:300] > rules.LIMIT).mean() < 0.05


def test_estimates_do_not_depend_on_the_split(spark, groups):
    rows = frame(spark, groups)
    one, two = (sorted(rules.minimum_determinants(r).collect()) for r in (rows.coalesce(1), rows.orderBy(F.rand(5)).repartition(7)))
    assert one == two


def test_kept_equals_numpy(spark):
    """Every verdict on the small documents, with the estimate of the group that judges the row."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = rules.judge(docs).collect()
    informs = {(r._lang, r._source): r.informs for r in rows}
    assert len(informs) > 1
    members = collections.defaultdict(list)
    for r in rows:
        for g in r.informs if not r.base_failed else ():
            members[g].append([r[f"x{i}"] for i in range(N)])
    estimates = {g: best_of_starts(np.array(x) / rules.UNIT) for g, x in members.items()}
    for r in rows:
        if r.g is None:  # every row of its language and source fails the plain limits
            assert r.base_failed and not r.kept
            continue
        d2 = distances(np.array([[r[f"x{i}"] for i in range(N)]]) / rules.UNIT, *estimates[r.g])[0]
        assert r.d2 == pytest.approx(d2, rel=1e-4, abs=1e-6)
        assert r.kept == (not r.base_failed and d2 <= rules.LIMIT)
