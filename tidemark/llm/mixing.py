"""Mixing sources to target weights.

The words of each source are packed, document after document, into blocks of ``block`` words. Output
shards draw how many blocks they take from each source from a multinomial; a source's slots are
numbered over the shards, and slot i takes block ``permutation(i mod blocks)`` of pass ``i div blocks``,
so a block is taken once per pass. The draws of all shards differ a little from the targets; what a
source has drawn beyond its target goes to those short of theirs, so that totals are met to a block.
Blocks are joined to the slots by their number.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share as many words as
there are; a target stops at ``most`` times its source's words, and the excess is shared again by weight.

The driver holds one row per source. Draws and permutations depend on the seed, shard, source and pass
only, so a lost task repeats them and reruns agree.

Defined results: a null text has no words, is never taken and gives taken 0; null is a source; an empty
table gives an empty result; repeated rows are documents of their own in ``mix``, and those equal in id
and text are one document in ``mixed_documents``; extra columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import small
from tidemark.llm.registry import query
from tidemark.llm.tables import written
from tidemark.llm.text import SPACE, let, row_key, whole
from tidemark.llm.words import chunks, mix as scramble, split_words

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BLOCK = 64
SHARD_SLOTS = 1 << 14
MOST_TASKS = 1 << 14
SEED = 20240611


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Words to take from each source."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: float(most * n) for s, n in order}
    left, out, free = float(sum(n for _, n in order)), {}, [s for s, _ in order]
    while free:
        share = left / sum(weight[s] for s in free)
        full = [s for s in free if share * weight[s] > limit[s]]
        if not full:
            return out | {s: share * weight[s] for s in free}
        for s in full:
            out[s] = limit[s]
            left -= limit[s]
        free = [s for s in free if s not in out]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 .. size - 1: four Feistel rounds, walked until inside the range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = np.asarray(index, np.uint64).copy()
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> shift, x & mask
        for r in range(4):
            salt = np.uint64((key + 0x9E3779B97F4A7C15 * (r + 1)) % (1 << 64))
            left, right = right, left ^ (scramble(right ^ salt) & mask)
        out[todo] = (left << shift) | right
        todo = out >= np.uint64(size)
    return out.astype(np.int64)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size in words, and a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in small(iter([batch])):
                sizes = [split_words(data, bounds).counts() for _, _, data, bounds in chunks(rows.column(3))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(np.concatenate(sizes or [np.zeros(0, np.int64)]), pa.int64())],
                    names=["doc_id", "source", "tie", "size"])
    text = whole(docs[text_col])
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"),
                       F.xxhash64(text).alias("tie"), text.alias("t"))
    return rows.mapInArrow(run, "doc_id long, source string, tie long, size long")


def _packed(sized: DataFrame) -> DataFrame:
    """Adds ``start``, the words of the source before the document, by running sums on two levels."""
    n = max(1, math.isqrt(max(sized.count(), 1)))
    rows = sized.withColumn("chunk", F.pmod(F.xxhash64(F.coalesce("doc_id", "tie")), F.lit(n)))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("words")).select(
        F.col("source").alias("_s"), F.col("chunk").alias("_c"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c")))
            .select("doc_id", "source", "tie", "size", (F.col("base") + F.col("inner")).alias("start")))


def _slots(spark: SparkSession, plan: list[tuple[int, int]], seed: int, shard_slots: int) -> DataFrame:
    """shard, s, block, pass: which block of which source each slot takes. ``plan``: slots and blocks by source."""
    want = np.array([k for k, _ in plan], np.int64)
    total = int(want.sum())
    shards = max(1, -(-total // shard_slots))
    chance = want / max(total, 1)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = [np.random.Generator(np.random.Philox(key=seed, counter=int(j))).multinomial(
                min(shard_slots, total - int(j) * shard_slots), chance) for j in frame["id"]]
            found = [(j, s, int(n)) for j, row in zip(frame["id"], counts) for s, n in enumerate(row) if n]
            yield pd.DataFrame(found, columns=["shard", "s", "n"])

    if not total:
        return spark.createDataFrame([], "shard long, s int, block long, pass int")
    drawn = spark.range(0, shards, 1, min(shards, 4096)).mapInPandas(draw, "shard long, s int, n long")
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = written(drawn.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "draws")
    got = np.zeros(len(plan), np.int64)
    for s, n in drawn.groupBy("s").agg(F.sum("n")).collect():  # one row per source
        got[s] = n
    moves = _moves(got, want)
    blocks = np.array([b for _, b in plan], np.int64)

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, s, n, first in zip(frame["shard"], frame["s"], frame["n"], frame["first"]):
                for low in range(int(first), int(first + n), 1 << 18):
                    index = np.arange(low, min(low + (1 << 18), first + n))
                    source = np.full(len(index), s)
                    for a, lo, hi, b, to in moves.get(int(s), ()):
                        here = (index >= lo) & (index < hi) & (source == a)
                        source[here], index[here] = b, index[here] - lo + to
                    for own in np.unique(source):
                        mine = index[source == own]
                        for turn in np.unique(mine // blocks[own]):
                            now = mine[mine // blocks[own] == turn]
                            key = seed * 1_000_003 + int(own) * 8191 + int(turn)
                            yield pd.DataFrame({"shard": shard, "s": own, "block": permuted(now % blocks[own], int(blocks[own]), key), "pass": turn})

    # as many tasks as shards: a given number is not merged, however small the rows are before they are filled
    return drawn.repartition(min(shards, MOST_TASKS), "shard", "s").mapInPandas(fill, "shard long, s int, block long, pass int")


def _moves(got: np.ndarray, want: np.ndarray) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """What a source drew beyond its target, as ranges of its slots, and the source and slot each range goes to."""
    short = [[s, int(got[s]), int(want[s])] for s in range(len(got)) if got[s] < want[s]]
    moves: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for s in range(len(got)):
        low = int(want[s])
        while low < got[s]:
            to, at, end = short[0]
            n = min(int(got[s]) - low, end - at)
            moves.setdefault(s, []).append((s, low, low + n, to, at))
            low += n
            short[0][1] += n
            if short[0][1] == end:
                short.pop(0)
    return moves


def _pieces(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int, seed: int, shard_slots: int, weights, most):
    """Packed documents with s, source_size and target; the parts of documents by block; the slots."""
    spark = docs.sparkSession
    packed = written(_packed(written(_sized(docs, id_col, text_col, source_col), "sizes")), "packed")
    sizes = [(r[0], r[1] or 0) for r in packed.groupBy("source").agg(F.sum("size")).collect()]  # one row per source
    aim = targets(sizes, weights, most)
    plan, names = [], []
    for i, (source, n) in enumerate(sizes):
        blocks = -(-n // block)
        plan.append((min(round(aim[source] * blocks / n), most * blocks) if n else 0, blocks))
        names.append((i, source, n, float(aim[source])))
    named = spark.createDataFrame(names, "s int, _source string, source_size long, target double")
    rows = packed.join(named, F.col("source").eqNullSafe(F.col("_source")))  # Spark knows the size of the named sources
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
    low, high = F.greatest("start", F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    parts = parts.select("s", "block", "doc_id", "tie", "start", "size", "source_size", "target",
                         (low - F.col("start")).alias("low"), (high - F.col("start")).alias("high"))
    return rows, parts, _slots(spark, plan, seed, shard_slots)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK,
        seed: int = SEED, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    rows, parts, slots = _pieces(docs, id_col, text_col, source_col, block, seed, shard_slots, weights, most)
    times = slots.groupBy("s", "block").agg(F.count(F.lit(1)).alias("times")).hint("merge")  # its size is not seen before it runs
    taken = (parts.join(times, ["s", "block"], "left")
             .groupBy("s", "start", "doc_id", "tie", "size", "source_size", "target")
             .agg(F.sum((F.col("high") - F.col("low")) * F.coalesce("times", F.lit(0))).alias("taken")))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return taken.select(columns).union(rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).select(columns))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    count_col: str | None = "n_chars", **parameters) -> DataFrame:
    """The mix as documents with the input's columns: a row per document and pass that takes words of it.

    A document taken whole in a pass keeps its text as it is; else its text is the taken words, joined
    by spaces, with a line for each run of blocks. ``count_col``, if there, is the text's length.
    """
    options = {"block": BLOCK, "seed": SEED, "shard_slots": SHARD_SLOTS, "weights": WEIGHTS, "most": MOST} | parameters
    names = docs.columns
    key = row_key(docs[id_col].cast("long"), whole(docs[text_col]))
    one = docs.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*[docs[c] for c in names]), F.xxhash64(docs[source_col])).alias("_row"))
    own = [F.col(f"_row.`{id_col}`").cast("long").alias("_id"), F.xxhash64(whole(F.col(f"_row.`{text_col}`"))).alias("_tie")]
    one = written(one.select(*own, "_row"), "documents")
    _, parts, slots = _pieces(one.select("_row.*"), id_col, text_col, source_col, **options)
    runs = (parts.join(slots.hint("merge"), ["s", "block"])
            .groupBy("doc_id", "tie", "size", "pass").agg(F.sum(F.col("high") - F.col("low")).alias("n"),
                                                   F.sort_array(F.collect_list(F.struct("low", "high"))).alias("at")))
    text = whole(F.col(f"_row.`{text_col}`"))
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    cut = let(words, lambda ws: F.array_join(F.transform(  # split once per document, not once per run
        "at", lambda a: F.array_join(F.slice(ws, (a.low + 1).cast("int"), (a.high - a.low).cast("int")), " ")), "\n"))
    joined = one.join(runs, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tie") == F.col("tie")))
    joined = joined.withColumn("_text", F.when(F.col("n") == F.col("size"), text).otherwise(cut))
    said = {text_col: F.col("_text"), count_col: F.length("_text").cast("long")}
    return joined.select(*[said.get(c, F.col(f"_row.`{c}`")).alias(c) for c in names])


@query("op6_mix")
def mix_sources(documents: DataFrame) -> DataFrame:
    return mix(documents)
