"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Each entry c of a vector becomes the integer ``floor(scale * c)``; an offset added to all of them would
cancel in every result, so none is. One pass gives the sums, a second the products of the entries around the rounded means. Both are added up as integers, on the map
side first, so the covariance does not depend on the order of rows and is rounded once. The driver holds
one matrix of dimensions squared: its Cholesky factor with diagonal pivots, whose columns Jacobi rotations
make orthogonal. Norms of the rotated columns are the roots of the eigenvalues, the normalised columns
are the components; the covariance itself is never rotated, so small eigenvalues keep their digits.

Defined results: a vector that is null or holds a null or non-finite entry is left out; vectors of another
length than the most frequent (of equally frequent ones the longest) are left out too; entries beyond
64 bits count as the nearest long; directions without variance have no component, so a table of equal rows gives
no rows, as an empty table does; a row with a null id keeps it; repeated rows count each; extra columns are
ignored; ``deviation`` is null where the exact number does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.vectors import matrix, usable

SCALE = 1024
COMPONENTS = 8
#: Pivots up to this share of the largest variance, times the dimensions, count as no variance.
TINY = float(np.finfo(float).eps)
_LONG = 2.0 ** 63
_LOW = 1 << 60


@dataclass(frozen=True)
class Whitening:
    """What a fit knows: rows, integer centre, exact sums around it, eigenvalues falling, components as columns."""

    n: int
    dim: int
    scale: int
    centre: np.ndarray
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    components: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of centred entries."""
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ (self.components / np.sqrt(self.values))


def cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor and order of the rows, taking the largest remaining diagonal first; columns stop at the rank."""
    a, d = v.copy(), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    limit = TINY * d * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= limit:
            return factor[:, :k], order
        for x in (a, factor):
            x[[k, p]] = x[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, as rounds of pairs that share no column."""
    ring = np.arange(n + n % 2)
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        a, b = ring[:half], ring[half:][::-1]
        real = (a < n) & (b < n)
        yield np.minimum(a, b)[real], np.maximum(a, b)[real]
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated in pairs until all are orthogonal to double precision."""
    x, small = factor.copy(), TINY * np.sqrt(max(len(factor), 1))
    for _ in range(sweeps):
        turned = False
        for i, j in _rounds(x.shape[1]):
            a, b = x[:, i], x[:, j]
            p, q, r = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(r) > small * np.sqrt(p * q)
            if not turn.any():
                continue
            turned = True
            i, j, p, q, r = i[turn], j[turn], p[turn], q[turn], r[turn]
            zeta = (q - p) / (2 * r)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            a, b = x[:, i].copy(), x[:, j].copy()
            x[:, i], x[:, j] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return x


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit eigenvectors as columns, of a positive semidefinite matrix."""
    factor, order = cholesky(v)
    x = jacobi(factor)
    norms = np.sqrt((x * x).sum(0))
    fall = np.argsort(-norms, kind="stable")
    out = np.empty_like(x)
    out[order] = x / norms
    return norms[fall] ** 2, out[:, fall]


def _entries(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * c), held within 64 bits, as doubles, which hold every such integer."""
    return np.clip(np.floor(matrix(column, dim).astype(np.float64) * scale), -_LONG, _LONG)


def _products(x: np.ndarray) -> np.ndarray:
    """x.T @ x in integers: by doubles where they are exact, else by Python's integers."""
    most = np.abs(x).max(initial=0.0)
    if most * most * len(x) < 2.0 ** 53:
        return (x.T @ x).astype(np.int64).astype(object)
    whole = np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
    return whole.T @ whole


def _sums(x: np.ndarray) -> np.ndarray:
    if np.abs(x).max(initial=0.0) * len(x) < 2.0 ** 53:
        return x.sum(0).astype(np.int64).astype(object)
    return np.array([sum(map(int, column)) for column in x.T], object)


def _wide(values: list[int]) -> list[pa.Array]:
    """Integers of any size as two columns that add up without loss: multiples of 2**60, and the rest."""
    kind = pa.decimal128(38, 0)
    return [pa.array([v // _LOW for v in values], kind), pa.array([v % _LOW for v in values], kind)]


_WIDE = "high decimal(38,0), low decimal(38,0)"


def _added(parts: DataFrame, *keys: str) -> dict:
    """The exact totals by key; few keys, since they count dimensions."""
    rows = parts.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {tuple(r[k] for k in keys): int(r["high"]) * _LOW + int(r["low"]) for r in rows}


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = rows[vector_col]
    return rows.filter(usable(vector)).select(rows[id_col].cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None without any. The driver receives sums by dimension only."""
    vectors = _vectors(rows, id_col, vector_col)
    sizes = vectors.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes or not sizes[0]["dim"]:
        return None
    dim, n = int(sizes[0]["dim"]), int(sizes[0]["count"])
    same = vectors.filter(F.size("v") == dim).select("v")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, object)
        for batch in batches:
            total = total + _sums(_entries(batch.column(0), dim, scale))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), *_wide(list(total))], names=["i", "high", "low"])

    first = _added(same.mapInArrow(sums, f"i int, {_WIDE}"), "i")
    centre = np.array([float((2 * first[(i,)] + n) // (2 * n)) for i in range(dim)])
    upper = np.triu_indices(dim)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, line = np.zeros(len(upper[0]), object), np.zeros(dim, object)
        for batch in batches:
            x = _entries(batch.column(0), dim, scale) - centre
            total, line = total + _products(x)[upper], line + _sums(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(upper[0], np.full(dim, -1)), pa.int32()),
                                          pa.array(np.append(upper[1], np.arange(dim)), pa.int32()), *_wide([*total, *line])],
                                         names=["i", "j", "high", "low"])

    found = _added(same.mapInArrow(scatter, f"i int, j int, {_WIDE}"), "i", "j")
    around = [found[(-1, j)] for j in range(dim)]
    v = np.zeros((dim, dim))
    for i, j in zip(*upper):
        v[i, j] = v[j, i] = (n * found[(int(i), int(j))] - around[i] * around[j]) / (n * n)  # integers divided once
    values, components = eigen(v)
    return Whitening(n, dim, scale, centre, tuple(around), float(np.trace(v)), values[:most], components[:, :most])


def identity_error(rows: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    k = len(model.values)
    same = rows.filter(usable(rows[vector_col])).select(rows[vector_col].cast("array<double>").alias("v")).filter(F.size("v") == model.dim)

    def moments(shift: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, products = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                w = model.project(_entries(batch.column(0), model.dim, model.scale) - model.centre) - shift
                sums, products = sums + w.sum(0), products + w.T @ w
            i, j = (x.ravel() for x in np.indices((k + 1, k)))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.append(products.ravel(), sums))],
                                             names=["i", "j", "x"])
        out = np.zeros((k + 1, k))
        for i, j, x in same.mapInArrow(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x")).collect():
            out[i, j] = x / model.n
        return out
    shift = moments(np.zeros(k))[k]
    return float(np.abs(moments(shift)[:k] - np.eye(k)).max(initial=0.0))


def _deviation(x: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over dimensions of (n * x - S) ** 2, the same for entries taken around any centre."""
    most = (model.n * np.abs(x).max(initial=0.0) + max(map(abs, model.sums))) ** 2 * model.dim
    if most < 2.0 ** 62:
        wide = x.astype(np.int64) * model.n - np.array(model.sums, np.int64)
        return pa.array((wide * wide).sum(1), pa.int64())
    exact = (sum((model.n * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x)
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, deviation and ``whitened`` (array of double by falling eigenvalue) of every usable row of the fit's length."""
    vectors = _vectors(rows, id_col, vector_col)
    schema = "vec_id long, deviation long, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _entries(batch.column(1), model.dim, model.scale) - model.centre
            w = model.project(x)
            at = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), _deviation(x, model), pa.ListArray.from_arrays(pa.array(at), pa.array(w.ravel()))],
                                             names=["vec_id", "deviation", "whitened"])
    return vectors.filter(F.size("v") == model.dim).mapInArrow(run, schema)


@query("op12_embedding_whitening", "embeddings")
def embedding_whitening(embeddings: DataFrame) -> DataFrame:
    model = fit(embeddings)
    out = whiten(embeddings, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, shares, error = 0, [0.0], 0.0
    if model is not None:
        n, shares, error = model.n, [float(e) / model.trace for e in model.values] or [0.0], identity_error(embeddings, model)
    explained = F.get(F.array(*[F.lit(s) for s in shares]), F.col("at"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(error).alias("identity_error"))
