"""Hard negatives: rows of other labels that score high with an anchor, yet clearly below a positive.

Vectors are integers, ``floor(scale * x)``; a score is an inner product. An anchor's positives are its
best other rows of its own label; for each positive the best rows of other labels whose score lies between
``low`` and ``high`` hundredths of the positive's are returned.

Rows lie in blocks; the anchors, a stated query set, come to every block of theirs and are handled as
they stream by, so a task holds one block. A block keeps, for every row and on several levels, the mean and
the deviation of each segment of the vector. For segments of length l the inner product is within
``l * (mean * mean -+ deviation * deviation)``, so two small products bound a score from both sides. Whole
vectors are bounded first; a row that may still matter is bounded on finer segments, and only what is
left is scored exactly. A row is passed over only if its upper bound is below the lower bounds of enough
others, or its bounds lie outside the window, so nothing is lost.

Positives are sought in blocks of the anchor's label, negatives in blocks of all rows. Rows go to
blocks by the hash of a row number, so no label, id or vector gathers in one.

Defined results: a row with a null label, a null vector or a null or non-finite component takes no part;
vectors are compared with those of their own length; a row whose id is null is never an anchor, may be
chosen, and comes after all ids of its score; rows with the anchor's id are not its positives; repeated rows
count each, and each repeated anchor returns its own; an anchor without positives or negatives returns
no row; extra columns are ignored; an empty table gives an empty result; entries and scores beyond 64
bits count as the nearest long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.tables import written
from tidemark.llm.vectors import matrix, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
#: Entries in a block of rows: how much a task holds, and how often the anchors are copied.
BLOCK_ENTRIES = 1 << 17
#: Segments per vector, level by level.
LEVELS = (1, 4, 16)
_LONG = (1 << 63) - 1


def segments(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment, both times the root of its length, so that products need no weights."""
    cuts = np.linspace(0, x.shape[1], parts + 1).astype(int)
    length = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / length
    apart = x - np.repeat(mean, length, axis=1)
    return mean * np.sqrt(length), np.sqrt(np.add.reduceat(apart * apart, cuts[:-1], axis=1))


def _products(rows: np.ndarray, of: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of a vector with some rows; of most of them they are cheaper by taking all."""
    return (of @ vector)[rows] if 2 * len(rows) > len(of) else of[rows] @ vector


@dataclass
class Block:
    """Rows that lie together, with their summaries."""

    ids: np.ndarray
    none: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __post_init__(self) -> None:
        self.doubles = x = self.vectors.astype(np.float64)
        self.levels = [(p, *segments(x, p)) for p in LEVELS if 2 * p <= x.shape[1]]
        self.norms = np.sqrt((x * x).sum(1))
        self.most = float(np.abs(x).max(initial=0.0)) * max(x.shape[1], 1)

    def scores(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Inner products of integers as longs: by doubles where they are exact, else by Python's integers."""
        x = vector.astype(np.float64)
        if self.most * np.abs(x).max(initial=0.0) < 2.0 ** 53:
            return _products(rows, self.doubles, x).astype(np.int64)
        whole = [int(v) for v in vector]
        exact = (sum(int(a) * b for a, b in zip(row, whole)) for row in self.vectors[rows])
        return np.array([max(-_LONG - 1, min(_LONG, e)) for e in exact], np.int64)

    def bounds(self, vector: np.ndarray) -> list[Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]]:
        """Per level: what bounds the scores of some rows from below and above, rounding included."""
        x = vector.astype(np.float64)[None, :]
        norm = float(np.sqrt((x * x).sum()))

        def level(parts: int, mean: np.ndarray, apart: np.ndarray):
            m, d = (v[0] for v in segments(x, parts))

            def of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                middle, reach = _products(rows, mean, m), _products(rows, apart, d)
                reach = reach + 1e-9 * (1 + norm * self.norms[rows])
                return middle - reach, middle + reach
            return of
        return [level(*one) for one in self.levels]

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the k highest scores; ties by id, null last."""
        keep = np.arange(len(rows))
        if len(rows) > 4 * k:
            keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return keep[np.lexsort((self.ids[rows[keep]], self.none[rows[keep]], ~scores[keep]))[:k]]

    def positives(self, anchor: int, label: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of the anchor's label with another id, and their scores."""
        rows = np.flatnonzero((self.labels == label) & (self.none | (self.ids != anchor)))
        for bound in self.bounds(vector):
            if len(rows) <= k:
                break
            low, high = bound(rows)
            rows = rows[high >= np.partition(low, len(low) - k)[len(low) - k]]
        scores = self.scores(rows, vector)
        at = self.best(rows, scores, k)
        return rows[at], scores[at]

    def negatives(self, label: int, vector: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores, its k best rows of other labels, and their scores."""
        rows = np.flatnonzero(self.labels != label)
        for bound in self.bounds(vector):
            low, high = bound(rows)
            use = np.zeros(len(rows), bool)
            for least, most in windows:
                sure = low[(low >= least) & (high <= most)]
                least = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else least
                use |= (high >= least) & (low <= most)
            rows = rows[use]
        scores = self.scores(rows, vector)
        found = []
        for least, most in windows:
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            at = inside[self.best(rows[inside], scores[inside], k)] if len(inside) else inside
            found.append((rows[at], scores[at]))
        return found


def window(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest integer score between ``low`` and ``high`` hundredths of a positive's."""
    return -(-low * positive // 100), high * positive // 100


def _streamed(handle, names: list[str]):
    """Rows sorted by block and kind (0 rows, 1 anchors): a block is built when its first anchor comes.

    ``handle(block, anchor as a dict, vector)`` gives lists of values by column.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)] if len(keys) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                part, (*now, kind) = batch.slice(a, b - a), keys[a]
                if key != now:
                    key, held, block = now, [], None
                if not kind:
                    held.append(part)
                    continue
                if not held:
                    continue
                if block is None:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    ids = rows["id"]
                    block = Block(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(), rows["label"].to_numpy(), matrix(rows["v"], int(now[1])))
                vectors = matrix(part.column(7), int(now[1]))
                out: list[list] = [[] for _ in names]
                for anchor, vector in zip(part.drop_columns(["v"]).to_pylist(), vectors):
                    for column, values in zip(out, handle(block, anchor, vector)):
                        column += values
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "positive" else pa.int64()) for c, n in zip(out, names)], names=names)
    return run


def _visited(rows: DataFrame, anchors: DataFrame, keys: list[Column], handle, schema: str, parts: int) -> DataFrame:
    """Both sides laid out by block, and the anchors handled at each."""
    shape = lambda df, kind, number, at: df.select(
        *keys, F.lit(kind).cast("long").alias("kind"), "id", "label", number.alias("number"), "v", at.alias("at"))
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    both = shape(rows, 0, F.lit(None).cast("long"), none).union(shape(anchors, 1, F.col("number"), F.col("at")))
    names = [c.split()[0] for c in schema.split(", ")]
    places = ["place", "dim", "block"]
    return both.repartition(parts, *places).sortWithinPartitions(*places, "kind").mapInArrow(_streamed(handle, names), schema)


def mine(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", every: int = 50,
         scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block_entries: int = BLOCK_ENTRIES, relabel: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``every`` divides. ``relabel(id, label)`` may give another label.
    """
    spark = rows.sparkSession
    vector, doc_id, label = rows[vector_col], rows[id_col].cast("long"), rows[label_col].cast("long")
    ready = rows.filter(rows[label_col].isNotNull() & usable(vector)).select(
        doc_id.alias("id"), (relabel(doc_id, label) if relabel else label).alias("label"),
        F.transform(vector.cast("array<double>"), lambda c: F.floor(c * scale)).alias("v"))
    ready = written(ready.withColumn("dim", F.size("v").cast("long")).withColumn("number", F.monotonically_increasing_id()), "vectors")
    # blocks per label and length, and per length: as many as hold the rows at about block_entries each
    per = F.greatest(F.lit(64), F.floor(F.lit(block_entries) / F.greatest("dim", F.lit(1)))).cast("long")
    sizes = written(ready.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "label-sizes")
    near = sizes.withColumn("blocks", F.ceil(F.col("n") / per)).select(F.col("label").alias("_l"), F.col("dim").alias("_d"), "blocks")
    far = sizes.groupBy("dim").agg(F.sum("n").alias("n")).select(F.col("dim").alias("_d"), F.ceil(F.col("n") / per).alias("blocks"))
    count = sizes.agg(F.sum(F.ceil(F.col("n") / per))).first()[0] or 0
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    parts = int(min(max(count, 1), 1 << 14))
    chosen = F.pmod(F.xxhash64("number"), F.col("blocks"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    no_window = F.array().cast("array<struct<low:bigint,high:bigint>>")
    anchors = ready.filter(F.pmod("id", F.lit(every)) == 0).withColumn("at", no_window)

    in_label = lambda df, block: df.join(near, (df.label == F.col("_l")) & (df.dim == F.col("_d"))).withColumn("block", block)
    keys = [F.col("label").alias("place"), "dim", "block"]

    def find_positives(block: Block, anchor: dict, vector: np.ndarray):
        at, scores = block.positives(anchor["id"], anchor["label"], vector, positives)
        ids = [None if block.none[i] else int(block.ids[i]) for i in at]
        return [anchor["number"]] * len(at), ids, scores.tolist()
    found = _visited(in_label(ready, chosen), in_label(anchors, each), keys, find_positives,
                     "number long, positive_id long, positive_score long", parts)
    ranked = Window.partitionBy("number").orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last())
    found = written(found.withColumn("positive", F.row_number().over(ranked)).filter(F.col("positive") <= positives), "positives")

    score = F.col("positive_score").cast("decimal(38,0)")  # the window in whole numbers of hundredths
    bound = F.struct(F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    windows = found.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("positive", bound.alias("b")))).alias("w")).select(
        "number", F.transform("w", lambda w: w.b).alias("at"))
    asking = anchors.drop("at").join(windows, "number")
    over_all = lambda df, block: df.join(far, df.dim == F.col("_d")).withColumn("block", block)
    keys = [F.lit(0).cast("long").alias("place"), "dim", "block"]

    def find_negatives(block: Block, anchor: dict, vector: np.ndarray):
        out: tuple[list, ...] = ([], [], [], [])
        for i, (at, scores) in enumerate(block.negatives(anchor["label"], vector, [(w["low"], w["high"]) for w in anchor["at"]], negatives)):
            for column, values in zip(out, ([anchor["number"]] * len(at), [i + 1] * len(at),
                                            [None if block.none[j] else int(block.ids[j]) for j in at], scores.tolist())):
                column += values
        return out
    taken = _visited(over_all(ready, chosen), over_all(asking, each), keys, find_negatives,
                     "number long, positive int, negative_id long, negative_score long", parts)
    ranked = Window.partitionBy("number", "positive").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    taken = taken.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
    named = found.join(anchors.select("number", F.col("id").alias("anchor_id")), "number")
    return taken.join(named, ["number", "positive"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * c::DOUBLE) FOR c IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 3
"""


@query("op13_hard_negatives", "embeddings", SQL)
def hard_negatives(embeddings: DataFrame) -> DataFrame:
    return mine(embeddings, relabel=lambda i, label: F.when(F.coalesce(i % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label))
