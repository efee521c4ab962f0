"""Repeated passages across documents: seed and extend.

Seeds are winnowed anchors: of the seven 7-word grams of every 13-word window the one with the smallest
hash, so equal windows have equal anchors. Documents are joined on anchors that occur in more than one
document. A shared anchor is extended both ways over the run of windows that have chosen it; runs that
are equal in two documents are decided as a whole, by the smallest document that has them. What is left
(the first document of each kind of run, and the ends of passages, where runs differ) is extended window
by window. Covered windows are merged into maximal repeats.

Equality is that of two 64-bit hashes of the word sequences; anchors only propose. Nothing lists pairs:
every step takes the smallest document of a key, with partial sums on the map side, and answers go back
by joins of narrow rows that AQE can split on a hot key.

Defined results: a null text has no words; a text of fewer than 13 words repeats nothing; rows with equal
ids are not repeats of each other; a null id counts as larger than all others; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import small
from tidemark.llm.registry import query
from tidemark.llm.tables import written
from tidemark.llm.text import whole
from tidemark.llm.words import Words, chunks, mix, powers, split_words, window_hashes

LENGTH = 13
GRAM = 7
_LAST = (1 << 63) - 1


class Runs:
    """Runs of windows with one anchor in some texts: text, first window in it, number of windows, anchor."""

    def __init__(self, words: Words, length: int, gram: int):
        self.first = words.first
        self.length = length
        self.hashes = words.hashes(0)
        grams = window_hashes(self.hashes, gram)
        span = length - gram + 1
        n = max(len(self.hashes) - length + 1, 0)
        best, offset = grams[:n].copy(), np.zeros(n, np.int64)
        for k in range(1, span):
            smaller = grams[k:k + n] < best
            best = np.where(smaller, grams[k:k + n], best)
            offset[smaller] = k
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))[:n]
        inside = np.arange(n) + length <= self.first[1:][text]
        self.at = np.flatnonzero(inside)  # windows, as numbers of their first words
        text, anchor = text[inside], self.at + offset[inside]
        new = np.ones(len(self.at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        self.start = self.at[begin]  # first window of each run
        self.text = text[begin]
        self.low = self.start - self.first[self.text]
        self.count = np.diff(np.append(begin, len(self.at)))
        self.anchor = best[self.start]

    def run_hashes(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of all the words of each run."""
        out = []
        for seed in (0, 1):
            h = self.hashes if seed == 0 else words.hashes(1)
            up, down = powers(len(h) + 1, seed)
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * up[:len(h)], out=sums[1:])
            end = self.start + self.count + self.length - 1
            out.append(mix(mix((sums[end] - sums[self.start]) * down[self.start]) + self.count.astype(np.uint64)))
        return out[0], out[1]


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every start and count, joined."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(docs[text_col])
    return docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)).alias("doc_id"),
                       F.xxhash64(text).alias("tie"), text.alias("t"))


def _pick(column: pa.ListArray, runs_text: np.ndarray, runs_low: np.ndarray) -> np.ndarray:
    """Which runs are in the lists of their texts."""
    owner = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
    listed = owner.astype(np.int64) << 32 | column.flatten().to_numpy().astype(np.int64)
    return np.isin(runs_text.astype(np.int64) << 32 | runs_low, listed)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, tie (a hash of the text), low, high: covered words [low, high) of a text, not yet merged."""
    texts = _texts(docs, id_col, text_col)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(1)):
                runs = Runs(split_words(data, bounds), length, gram)
                ids = batch.column(0)[low:high].to_numpy()
                yield pa.RecordBatch.from_arrays([_long(runs.anchor), pa.array(ids[runs.text]), pa.array(runs.low.astype(np.int32))],
                                                 names=["anchor", "doc_id", "low"])

    seeds = texts.select("doc_id", "t").mapInArrow(anchors, "anchor long, doc_id long, low int")
    least = lambda rows, *keys: rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = written(least(seeds, "anchor").filter("least < most").select("anchor"), "anchors")
    seeded = written(seeds.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("low").alias("at")), "seeds")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(2)):
                words = split_words(data, bounds)
                found = Runs(words, length, gram)
                use = _pick(batch.column(3)[low:high], found.text, found.low)
                a, b = found.run_hashes(words)
                ids, ties = (batch.column(i)[low:high].to_numpy()[found.text[use]] for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [_long(a[use]), _long(b[use]), pa.array(ids), pa.array(ties), pa.array(found.low[use].astype(np.int32)),
                     pa.array(found.count[use].astype(np.int32))], names=["a", "b", "doc_id", "tie", "low", "n"])

    kinds = written(texts.join(seeded, "doc_id").select("doc_id", "tie", "t", "at")
                    .mapInArrow(runs, "a long, b long, doc_id long, tie long, low int, n int"), "runs")
    first = written(least(kinds, "a", "b").filter("least < most").select("a", "b", "least"), "first-runs")
    kinds = written(kinds.join(first, ["a", "b"], "left").select(
        "doc_id", "tie", "low", "n", (F.col("least") < F.col("doc_id")).alias("known")), "known-runs")
    known = kinds.filter("known").select("doc_id", "tie", "low", (F.col("low") + F.col("n") + length - 1).alias("high"))
    open_runs = kinds.filter("known IS NULL OR NOT known").groupBy("doc_id").agg(F.collect_set("low").alias("at"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(2)):
                words = split_words(data, bounds)
                found = Runs(words, length, gram)
                use = _pick(batch.column(3)[low:high], found.text, found.low)
                at = _ragged(found.start[use], found.count[use])
                text = np.repeat(found.text[use], found.count[use])
                a, b = window_hashes(found.hashes, length, 0), window_hashes(words.hashes(1), length, 1)
                ids, ties = (batch.column(i)[low:high].to_numpy()[text] for i in (0, 1))
                yield pa.RecordBatch.from_arrays([_long(a[at]), _long(b[at]), pa.array(ids), pa.array(ties),
                                                  pa.array((at - found.first[text]).astype(np.int32))],
                                                 names=["a", "b", "doc_id", "tie", "low"])

    single = written(texts.join(open_runs, "doc_id").select("doc_id", "tie", "t", "at")
                     .mapInArrow(windows, "a long, b long, doc_id long, tie long, low int"), "windows")
    first = written(least(single, "a", "b").filter("least < most").select("a", "b", "least"), "first-windows")
    late = single.join(first, ["a", "b"]).filter("least < doc_id").select("doc_id", "tie", "low", (F.col("low") + length).alias("high"))
    return known.union(late)


def _spans(found: DataFrame) -> DataFrame:
    """One row per text with its covered parts, sorted; a text has at most one part per window."""
    return found.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("parts"))


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, low, high: maximal runs of repeated words, each of ``length`` words or more."""
    spans = _spans(repeats(docs, id_col, text_col, length))
    merged = F.aggregate("parts", F.array().cast("array<struct<low:int,high:int>>"), lambda a, p: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1).high >= p.low),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1).low.alias("low"), F.greatest(F.element_at(a, -1).high, p.high).alias("high"))))).otherwise(
        F.concat(a, F.array(F.struct(p.low.alias("low"), p.high.alias("high"))))))
    return spans.select(F.nullif("doc_id", F.lit(_LAST)).alias("doc_id"), F.inline(merged))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by spaces (``kept_text``), or their sha256 (``kept_sha256``)."""
    spans = written(_spans(repeats(docs, id_col, text_col, length)), "spans")
    spans = spans.select("doc_id", "tie", F.col("parts.low").alias("low"), F.col("parts.high").alias("high"))
    rows = _texts(docs, id_col, text_col).join(spans, ["doc_id", "tie"], "left").select("doc_id", "t", "low", "high")
    name = "kept_sha256" if digest else "kept_text"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sizes, gone, out = [], [], []
            for text, low, high in zip(*(batch.column(i) for i in (1, 2, 3))):
                words = text.as_buffer().to_pybytes().split()
                sizes.append(len(words))
                if low.is_valid:
                    marks = np.zeros(len(words) + 1, np.int64)
                    np.add.at(marks, low.values.to_numpy(), 1)
                    np.add.at(marks, high.values.to_numpy(), -1)
                    words = list(compress(words, np.cumsum(marks[:-1]) == 0))
                gone.append(sizes[-1] - len(words))
                kept = b" ".join(words)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", name])
    return (rows.mapInArrow(cut, f"doc_id long, n_words long, n_removed long, {name} string")
            .withColumn("doc_id", F.nullif("doc_id", F.lit(_LAST))))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM w) WHERE least < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM late) GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(ws) AS n, coalesce(len(ps), 0) AS g,
                CASE WHEN ps IS NULL THEN array_to_string(ws, ' ') END AS whole FROM d LEFT JOIN gone USING (doc_id)),
word AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d
                                               WHERE doc_id IN (SELECT doc_id FROM gone))),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM word
         ANTI JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, n AS n_words, g AS n_removed, sha256(coalesce(whole, t, '')) AS kept_sha256 FROM kept LEFT JOIN rest USING (doc_id)
"""


@query("op3_substring_dedup", sql=SQL)
def substring_dedup(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents, digest=True)
