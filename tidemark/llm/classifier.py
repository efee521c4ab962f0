"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades; ordered thresholds turn the score s into
P(grade <= k) = sigmoid(threshold_k - s). Grades from the labels: 0 toxic, 1 bad, 2 good (toxic lowest, so
that many signs of it only lower the score further). A text is kept if P(grade = 2) reaches ``MIN_TAIL``.

Features are hashed lower-case runs of letters and digits (log of their count), hashed word endings in
signs, and bins of a few shares (signs, capitals, repeated words and lines, lengths). The model is fitted
on the driver from at most ``MAX_ROWS`` labelled documents, those with the smallest hashes of their ids, one row of each;
only their features come to the driver. Features that are not associated with a grade there (``MIN_Z``) get
weight 0, so that long texts do not gather noise.

Defined results: a null text counts as empty; a text without a letter or digit is rejected; several
labels of a document count as the worst of them, null labels are left out; with labels of fewer than two
grades nothing else is rejected; every row gives one row; extra columns are ignored by ``rate`` and
kept by ``select_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import small
from tidemark.llm.registry import QUERIES
from tidemark.llm.text import whole
from tidemark.llm.words import SEPARATOR, chunks, split_words

MAX_ROWS = 4096
BITS = 18
MIN_TAIL = 0.5
STEPS = 150
RIDGE = 1e-4
MIN_Z = 5.0

_NOT_TERM = np.ones(256, bool)
_NOT_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SIGN = _NOT_TERM & ~SEPARATOR
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of the distinct hashes of each text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return t[at], h[at], np.diff(np.append(at, len(t)))


def feature_rows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the features of some texts, and the number of terms of each text."""
    n = len(bounds) - 1
    terms = split_words(data, bounds, _NOT_TERM)
    row, term, count = _distinct(terms.hashes(0, lower=True), terms.first)
    rows, columns, values = [row], [term >> np.uint64(64 - BITS)], [np.log1p(count)]
    words = split_words(data, bounds)
    lines = split_words(data, bounds, _NEWLINE)
    line_text, _, _ = _distinct(lines.hashes(0), lines.first)
    n_bytes, n_words, n_terms = np.maximum(np.diff(bounds), 1), np.maximum(words.counts(), 1), terms.counts()
    distinct_terms = np.bincount(row, minlength=n)
    distinct_lines = np.bincount(line_text, minlength=n)
    spread = lambda x, steps: np.clip(np.round(np.sqrt(x) * steps), 0, 255).astype(np.uint64)
    shares = [spread(_per_text(_SIGN[data], bounds) / n_bytes, 20), spread(_per_text(_UPPER[data], bounds) / n_bytes, 10),
              spread(distinct_terms / np.maximum(n_terms, 1), 10), spread(distinct_lines / np.maximum(lines.counts(), 1), 10),
              np.minimum(np.log2(n_words), 20).astype(np.uint64), spread(_per_text(~SEPARATOR[data], bounds) / n_words, 6)]
    for i, bins in enumerate(shares):
        key = (np.uint64(i + 1) << np.uint64(32)) | bins
        rows.append(np.arange(n))
        columns.append((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
        values.append(np.full(n, 2.0))
    return np.concatenate(rows), np.concatenate(columns).astype(np.int64), np.concatenate(values), n_terms


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # increasing; empty if nothing was learnt

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, steps: int = STEPS,
                ridge: float = RIDGE) -> Model:
    """Maximum likelihood with a ridge, by Adam on all rows; grades are 0 .. K and may leave some out."""
    if len(np.unique(grade)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(0))
    n, top = len(grade), int(grade.max())
    use = _associated(row, column, grade)[column]
    row, value = row[use], value[use]
    names, column = np.unique(column[use], return_inverse=True)
    # thresholds as the first one and logs of the gaps, so that they stay ordered
    x = np.zeros(len(names) + top)
    grown = [np.zeros_like(x), np.zeros_like(x)]
    for step in range(1, steps + 1):
        w, cuts = x[:-top], np.concatenate([x[-top:][:1], x[-top:][:1] + np.cumsum(np.exp(x[-top:][1:]))])
        score = np.bincount(row, weights=w[column] * value, minlength=n)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -50, 50)))  # P(grade <= k)
        edge = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        at = np.arange(n)
        high, low = edge[at, grade + 1], edge[at, grade]
        p = np.maximum(high - low, 1e-12)
        slope = edge * (1 - edge)
        d_cut = np.zeros((n, top + 2))
        d_cut[at, grade + 1] = slope[at, grade + 1] / p
        d_cut[at, grade] -= slope[at, grade] / p
        d_score = -(slope[at, grade + 1] - slope[at, grade]) / p
        g_w = -np.bincount(column, weights=d_score[row] * value, minlength=len(names)) / n + ridge * w
        d = -d_cut[:, 1:-1].mean(axis=0)
        g_gap = [d.sum(), *[d[k:].sum() * np.exp(x[len(w) + k]) for k in range(1, top)]]
        g = np.concatenate([g_w, g_gap])
        grown[0] = 0.9 * grown[0] + 0.1 * g
        grown[1] = 0.99 * grown[1] + 0.01 * g * g
        x = x - 0.1 * (grown[0] / (1 - 0.9 ** step)) / (np.sqrt(grown[1] / (1 - 0.99 ** step)) + 1e-8)
    cuts = np.concatenate([x[-top:][:1], x[-top:][:1] + np.cumsum(np.exp(x[-top:][1:]))])
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = x[:-top]
    return Model(weights, cuts)


def _associated(row: np.ndarray, column: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """Whether a feature found in five or more texts is in more or fewer texts of a grade than by chance."""
    dim, n = 1 << BITS, len(grade)
    found = np.bincount(column, minlength=dim)
    use = np.zeros(dim, bool)
    for k in range(int(grade.max())):
        share = (grade == k).mean()
        hits = np.bincount(column, weights=grade[row] == k, minlength=dim)
        spread = np.sqrt(np.maximum(found * share * (1 - share) * (1 - np.minimum(found / n, 1)), 1e-9))
        use |= (np.abs(hits - found * share) >= MIN_Z * spread) & (found >= 5)
    return use


def _scores(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row, column, value, n_terms = feature_rows(data, bounds)
    n = len(bounds) - 1
    return np.bincount(row, weights=model.weights[column] * value, minlength=n), n_terms


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> Model:
    """Fit on labelled documents; ``labels`` has the id, quality (0 or 1) and toxic (0 or 1)."""
    worst = (labels.filter("quality IS NOT NULL").groupBy(F.col(id_col).cast("long").alias("_id"))
             .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")))
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") < 1, 1).otherwise(2)
    chosen = (worst.select("_id", grade.alias("grade"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))  # at most max_rows rows, so it may be broadcast
    text = whole(docs[text_col])
    rows = (docs.join(F.broadcast(chosen), docs[id_col].cast("long") == F.col("_id")).groupBy("_id", "grade")
            .agg(F.min_by(text, F.xxhash64(text)).alias("text")))  # repeated rows weigh and cost as one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(2)):
                row, column, value, _ = feature_rows(data, bounds)
                order = np.argsort(row, kind="stable")
                at = np.append(0, np.cumsum(np.bincount(row, minlength=high - low))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(at, x[order]) for x in (column.astype(np.int32), value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], batch.column(1)[low:high], *lists],
                                                 names=["id", "grade", "columns", "values"])
    found = rows.select("_id", "grade", "text").mapInArrow(
        run, "id long, grade int, columns array<int>, values array<float>")
    sample = found.toArrow().sort_by("id")  # features of max_rows documents
    grades = sample["grade"].to_numpy()
    lengths = np.array([len(x) for x in sample["columns"]], np.int64)
    flat = lambda name, kind: sample[name].combine_chunks().flatten().to_numpy().astype(kind) if len(sample) else np.zeros(0, kind)
    return fit_ordinal(np.repeat(np.arange(len(grades)), lengths), flat("columns", np.int64), flat("values", float), grades.astype(np.int64))


def rate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", min_tail: float = MIN_TAIL,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``keep`` columns, score, expected_grade, tail_probability (of the highest grade), kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(batch.num_columns - 1)):
                score, n_terms = _scores(model, data, bounds)
                tails = model.tails(score)
                last = tails[:, -1] if tails.shape[1] else np.ones(len(score))
                out = [np.round(score, 6), np.round(tails.sum(axis=1), 6), np.round(last, 6), (last >= min_tail) & (n_terms > 0)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i)[low:high] for i in range(batch.num_columns - 1)], *map(pa.array, out)],
                                                 names=[*names, "score", "expected_grade", "tail_probability", "kept"])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), *[docs[c].alias(f"_{c}") for c in keep], whole(docs[text_col]).alias("_rated text"))
    names = rows.columns[:-1]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, score double, expected_grade double, tail_probability double, kept boolean")


def select_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that the classifier keeps, with their columns."""
    rated = rate(docs, fit(docs, labels, id_col, text_col), id_col, text_col, keep=tuple(docs.columns))
    return rated.filter("kept").select(*[F.col(f"_{c}").alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return rate(documents, fit(documents, spark.read.parquet(f"{folder}/labels.parquet")))


QUERIES["op8_quality_classifier"] = quality_classifier
