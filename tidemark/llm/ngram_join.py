"""N-gram Jaccard join: which documents share at least 80 % of their word 5-grams, and what that connects.

A document is the set of hashes of its 5-word shingles. Equal sets are one class with the smallest
document as its representative; only representatives are joined:

1. A count-min sketch of all shingles (``SKETCH_BITS``, a fixed size, so it may be broadcast) puts the
   frequent ones last in a global order. Two linked sets share one of the first n - ceil(0.8 n) + 1
   shingles of each; these prefixes make the inverted index. A sketch never counts too little, so lists
   of shingles below its threshold are that short; only the others can be long.
2. Set relations skip work. First every list puts its sets next to its most central one (whose own
   lists are the longest, as those of an original among its copies), and each set is verified with the
   centre it meets most often: near copies fall into components. Sets whose centres lead to the same last one
   form a group.
3. Inside a group answers are derived from the centre's: two members share what the centre has, less what either
   lost, plus what both lost or both added. Pairs whose losses are small enough are linked without
   looking further; all others must agree in so many differences, so only differences are joined, by prefixes
   again, the rarest of the group first. Members of a large group of near copies that are
   linked with nothing meet few others that way.
4. Across groups a list is only opened where it holds different components and groups, and there only the sets
   outside its largest component or group are compared with the rest.
5. Blocks of a list are skipped by size and position: sizes must be within 80 %, and the number of common
   prefix shingles plus what can follow the prefixes must reach the overlap that 80 % needs.
6. What is left is verified on the whole shingle sets.

Defined results: A-Z count as a-z; a text of one to four words has its whole word sequence as its
shingle; a text without words, and a null text, has no shingles and is linked with nothing; a document
is a row: rows of one id, or of none, with different texts are told apart by a 128-bit hash of both;
null ids count as larger than all others; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import small
from tidemark.llm.components import connected_components
from tidemark.llm.registry import query
from tidemark.llm.tables import written
from tidemark.llm.text import row_key, whole
from tidemark.llm.words import chunks, mix, split_words, window_hashes

GRAM = 5
SKETCH_BITS = 22
#: Shingles that the sketch counts at most this often, besides its noise, come first in the order.
FREQUENT = 64
#: Share of the prefix that two sets must have met in before the first round verifies them.
STRONG = 0.3
#: Or so many sets per shingle in the lists where they met: then reading the set costs less than going through the lists.
DEAR = 4
_BLOCKS = 64


def shingle_sets(data: np.ndarray, bounds: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of some texts, and where each text's begin."""
    words = split_words(data, bounds)
    hashes = words.hashes(0, lower=True)
    counts = words.counts()
    full = window_hashes(hashes, gram)
    text = np.repeat(np.arange(len(counts)), counts)[:len(full)]
    inside = np.arange(len(full)) + gram <= words.first[1:][text]
    owner, found = [text[inside]], [full[inside]]
    for n in range(1, gram):  # short texts: their whole sequence
        short = np.flatnonzero(counts == n)
        if len(short):
            owner.append(short)
            found.append(mix(window_hashes(hashes, n)[words.first[short]] + np.uint64(n)))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    owner, found = owner[new], found[new]
    return found, np.searchsorted(owner, np.arange(len(counts) + 1))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    doc_id, text = docs[id_col].cast("long"), whole(docs[text_col])
    return docs.select(doc_id.alias("doc_id"), row_key(doc_id, text).alias("key"), text.alias("t"))


def _sketch(texts: DataFrame) -> Broadcast:
    """Order classes by bucket of a shingle's hash: 0 for the infrequent, higher ones by the logarithm of the count."""
    width = 1 << SKETCH_BITS
    part = width // _BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, np.uint32)
        for batch in small(batches):
            for _, _, data, bounds in chunks(batch.column(0)):
                found, _ = shingle_sets(data, bounds)
                bucket, times = np.unique((found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), return_counts=True)
                counts[bucket] += times.astype(np.uint32)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(_BLOCKS), pa.int32()), pa.array(
                [np.minimum(counts[i * part:(i + 1) * part], 65535).astype("<u2").tobytes() for i in range(_BLOCKS)], pa.binary())],
                names=["block", "counts"])

    def add(kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                    sums[block] = sums.get(block, np.zeros(part, np.uint64)) + np.frombuffer(counts.as_buffer(), kind)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([
                    np.minimum(x, 0xFFFFFFFF).astype("<u4").tobytes() for x in sums.values()], pa.binary())], names=["block", "counts"])
        return run

    rows = texts.select("t").mapInArrow(count, "block int, counts binary")
    rows = rows.repartition("block", F.spark_partition_id() % 16).mapInArrow(add("<u2"), "block int, counts binary")
    rows = rows.repartition("block").mapInArrow(add("<u4"), "block int, counts binary")  # of many tasks' sums, a few
    total = np.zeros(width, np.uint64)
    for block, counts in written(rows, "sketch").collect():  # one row per block, the sketch
        total[block * part:(block + 1) * part] = np.frombuffer(counts, "<u4")
    limit = FREQUENT + 4 * int(total.sum()) // width
    level = np.zeros(width, np.uint8)
    often = total > limit
    level[often] = np.floor(np.log2(total[often] / limit)).astype(np.uint8) + 1
    return texts.sparkSession.sparkContext.broadcast(level)


def prefix_size(n):
    """How many of the first shingles of a set of n hold one of every linked set: n - ceil(0.8 n) + 1."""
    return n + (-4 * n) // 5 + 1


def _sets(texts: DataFrame, level: Broadcast) -> DataFrame:
    """doc_id, key, n, two hashes of the set, its prefix in the global order, and how many of that are infrequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(2)):
                found, first = shingle_sets(data, bounds)
                n = np.diff(first)
                owner = np.repeat(np.arange(high - low), n)
                keys = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    sums = np.zeros(len(found) + 1, np.uint64)
                    np.cumsum(mix(found ^ np.uint64(salt)), out=sums[1:])
                    keys.append(mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64)))
                rank = level.value[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((found, rank, owner))
                size = np.where(n > 0, prefix_size(n), 0)
                use = np.arange(len(found)) - first[owner] < size[owner]
                light = np.bincount(owner[use & (rank[order] == 0)], minlength=high - low)
                at = np.append(0, np.cumsum(size)).astype(np.int32)
                prefix = pa.ListArray.from_arrays(at, pa.array(found[order][use].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], batch.column(1)[low:high], pa.array(n.astype(np.int32)), *[pa.array(k.view(np.int64)) for k in keys], prefix,
                     pa.array(light.astype(np.int32))], names=["doc_id", "key", "n", "k1", "k2", "prefix", "light"])
    return texts.mapInArrow(run, "doc_id long, key binary, n int, k1 long, k2 long, prefix array<long>, light int")


def _in_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, those that share it with another row; a token may span batches."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        token = batch.column(0).to_numpy()
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        shared = np.zeros(len(token), bool)
        shared[1:] |= same
        shared[:-1] |= same
        last = int(np.searchsorted(token, token[-1]))  # the last token may go on
        yield batch.slice(0, last).filter(pa.array(shared[:last]))
        held = batch.slice(last)
    if held is not None and held.num_rows > 1:
        yield held


def _lists(reps: DataFrame) -> DataFrame:
    """token, rep, n: the inverted index, without the lists of a single set."""
    light = (reps.select(F.explode(F.slice("prefix", F.lit(1), F.col("light"))).alias("token"), "rep", "n")
             .repartition("token").sortWithinPartitions("token").mapInArrow(_in_company, "token long, rep long, n int"))
    frequent = reps.filter("light < size(prefix)").select(
        F.explode(F.slice("prefix", F.col("light") + 1, F.size("prefix") - F.col("light"))).alias("token"), "rep", "n")
    return light.union(frequent)


def _size_near(a: Column, b: Column) -> Column:
    return (5 * a >= 4 * b) & (5 * b >= 4 * a)


def _shingles(pairs: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, shingles of the sets in ``pairs``; one text per row key, however often a row is repeated."""
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b"))).distinct()
    keys = reps.select("rep", "head.key").join(wanted, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for low, high, data, bounds in chunks(batch.column(1)):
                found, first = shingle_sets(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.ListArray.from_arrays(first.astype(np.int32), pa.array(found.view(np.int64)))],
                    names=["rep", "shingles"])
    once = texts.join(keys, "key").select("key", "rep", "t").dropDuplicates(["key"])
    return written(once.select("rep", "t").mapInArrow(run, "rep long, shingles array<long>"), "shingles")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with a Jaccard similarity of 80 % or more, from their whole shingle sets."""
    one, two = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    rows = pairs.select("a", "b").join(two, "b").join(one, "a").withColumn("common", common)
    return written(rows.filter(100 * F.col("common") >= 80 * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b").distinct(), "links")


def _groups(near: DataFrame) -> DataFrame:
    """rep, g: each set with the last of the centres that its own centre leads to, and that one with itself.

    A centre has more company than those around it, so the way ends; it is shortened by half in each round.
    """
    up = near.select(F.col("b").alias("rep"), F.col("a").alias("g"))
    ends = up.select(F.col("g").alias("rep")).distinct().join(up, "rep", "left_anti").withColumn("g", F.col("rep"))
    groups = written(up.union(ends), "groups")
    while True:
        further = groups.select(F.col("rep").alias("g"), F.col("g").alias("far"))
        after = written(groups.join(further, "g").select("rep", F.col("far").alias("g"), (F.col("far") != F.col("g")).alias("moved")), "groups")
        groups = after.select("rep", "g")
        if after.filter("moved").isEmpty():
            return groups


def _of_groups(groups: DataFrame, sets: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and candidates (a, b) among the members of each group, its centre included, where it has several components.

    A member b of the group of c lost l shingles of it, and has n. Members b and x share |c| - l(b) - l(x) + s
    shingles, where s counts the differences from c that both have. With w = 9 l + 4 n they are linked when
    9 s >= w(b) + w(x) - 9 |c|. If that is not above 0 both are linked with the member of least w as well, so a
    star around it connects what such links connect.
    """
    part = F.coalesce("label", "rep").alias("part")
    members = groups.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("g", "rep", part)
    parts = members.groupBy("g", "part").agg(F.count(F.lit(1)).alias("m"))
    several = parts.groupBy("g").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    members = members.join(several.select("g", "main"), "g")
    one, two = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s{c}")) for c in ("g", "rep"))
    rows = members.join(two, "rep").join(one, "g")
    rows = rows.withColumn("lost", F.size(F.array_except("sg", "srep"))).select(
        "g", "rep", "part", "main", F.size("sg").alias("c"), (9 * F.col("lost") + 4 * F.size("srep")).alias("w"),
        F.concat(F.array_except("sg", "srep"), F.array_except("srep", "sg")).alias("differences"))
    rows = written(rows, "differences")
    least = rows.groupBy("g").agg(F.min("w").alias("least"), F.min_by("rep", F.struct("w", "rep")).alias("first"),
                                  F.min(F.when(F.col("part") != F.col("main"), F.col("w"))).alias("least_open"))
    rows = rows.join(least, "g")
    stars = rows.filter((F.col("rep") != F.col("first")) & (F.col("w") + F.col("least") <= 9 * F.col("c"))).select(
        F.col("first").alias("a"), F.col("rep").alias("b"))

    other = F.when(F.col("part") == F.col("main"), F.col("least_open")).otherwise(F.col("least"))
    rows = rows.withColumn("size", F.size("differences")).withColumn(
        "use", F.col("size") + 1 - F.greatest(F.lit(1), F.ceil((F.col("w") + other - 9 * F.col("c")) / 9).cast("int"))).filter("use > 0")
    each = rows.select("g", "rep", "part", "main", "c", "w", "size", "use", F.explode("differences").alias("token"))
    often = each.groupBy("g", "token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # a difference that one member has alone fills its prefix but joins with nothing: of the others, those come first that few have
    common = each.join(often, ["g", "token"])
    shared = common.groupBy("g", "rep").agg(F.count(F.lit(1)).alias("shared"))
    place = F.row_number().over(Window.partitionBy("g", "rep").orderBy("often", "token"))
    lists = common.withColumn("place", place).join(shared, ["g", "rep"]).filter(F.col("place") <= F.col("use") - (F.col("size") - F.col("shared")))
    lists = written(lists.withColumn("rest", F.col("size") - F.col("use")).select(
        "g", "token", "rep", "part", "main", "c", "w", "rest", "place", "shared"), "difference-lists")
    own = ("rep", "part", "w", "rest", "place", "shared")
    a = lists.filter("part != main").select("g", "token", "c", "main", *[F.col(x).alias(f"{x}_a") for x in own])
    b = lists.select(F.col("g").alias("_g"), F.col("token").alias("_t"), *[F.col(x).alias(f"{x}_b") for x in own])
    # what both can have in common up to this place, and what can follow it
    most = F.least("place_a", "place_b") + F.least(F.col("shared_a") - F.col("place_a"), F.col("shared_b") - F.col("place_b"))
    met = a.join(b, (a.g == F.col("_g")) & (a.token == F.col("_t")) & (F.col("part_a") != F.col("part_b"))
                 & ((F.col("part_b") == F.col("main")) | (F.col("rep_a") < F.col("rep_b")))
                 & (9 * most >= F.col("w_a") + F.col("w_b") - 9 * F.col("c")))
    counted = met.groupBy("rep_a", "rep_b", "c", "w_a", "w_b", "rest_a", "rest_b").agg(F.count(F.lit(1)).alias("met"))
    reach = F.col("met") + F.greatest("rest_a", "rest_b")
    found = counted.filter(9 * reach >= F.col("w_a") + F.col("w_b") - 9 * F.col("c")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    return stars, found


def _head() -> Column:
    """A row as the head of a component: the smallest is the one with the smallest id."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, n of every row, and the head of its component: its first row by id, as (none, doc_id, key)."""
    texts = _texts(docs, id_col, text_col)
    sets = written(_sets(texts, _sketch(texts)), "sets")
    # a class goes by a number of its own, since its first id may be null or another class's too
    reps = written(sets.filter("n > 0").groupBy("k1", "k2", "n").agg(
        F.min(_head()).alias("head"), F.any_value("prefix").alias("prefix"), F.any_value("light").alias("light"))
        .withColumn("rep", F.monotonically_increasing_id()), "classes")
    lists = written(_lists(reps), "lists")

    sizes = written(lists.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "list-sizes")
    central = written(lists.join(sizes, "token").groupBy("rep").agg((F.sum("m") / F.max("n")).alias("company")), "company")
    placed = lists.join(central, "rep")
    centre = F.max_by(F.struct(F.col("rep").alias("a"), F.col("n").alias("na")), F.struct("company", -F.col("rep"))).alias("c")
    first = written(placed.groupBy("token").agg(F.count(F.lit(1)).alias("m"), centre).filter("m > 1").select("token", "m", "c.*"), "centres")
    stars = (lists.join(first, "token").filter((F.col("rep") != F.col("a")) & _size_near(F.col("na"), F.col("n")))
             .groupBy("a", F.col("rep").alias("b"), F.least("n", "na").alias("small")).agg(F.count(F.lit(1)).alias("met"), F.sum("m").alias("company")))
    best = (stars.filter((5 * F.col("met") >= STRONG * F.col("small")) | (F.col("company") >= DEAR * F.col("small"))).groupBy("b")
            .agg(F.max_by("a", F.struct("met", -F.col("a"))).alias("a")))
    near = written(best.select("a", "b"), "near")
    sets_near = _shingles(near, texts, reps)
    links = _linked(near, sets_near)
    labels = connected_components(links)
    groups = _groups(near)
    stars, inside = _of_groups(groups, sets_near, labels)

    marked = lists.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("label", "rep")).drop("label")
    marked = marked.join(groups, "rep", "left").withColumn("g", F.coalesce("g", "rep"))
    marked = written(marked, "marked")

    def largest(of: str, name: str) -> DataFrame:
        """Per list: the ``of`` that most of its sets have, how many, and how many kinds there are."""
        counts = marked.groupBy("token", of).agg(F.count(F.lit(1)).alias("m"))
        return counts.groupBy("token").agg(F.max(F.struct("m", of)).alias(name), F.count(F.lit(1)).alias(f"{name}s")).filter(f"{name}s > 1")
    mixed = written(largest("part", "p").join(largest("g", "q"), "token").select("token", "p", "q"), "mixed")
    by_group = F.col("q.m") > F.col("p.m")
    core = F.when(by_group, F.col("g") == F.col("q.g")).otherwise(F.col("part") == F.col("p.part"))
    rows = written(marked.join(mixed, "token").select("token", "rep", "n", "part", "g", core.alias("core")), "open")
    a = rows.filter("NOT core").select("token", *[F.col(x).alias(f"{x}a") for x in ("rep", "n", "part", "g")])
    b = rows.select("token", "core", *[F.col(x).alias(f"{x}b") for x in ("rep", "n", "part", "g")])
    met = a.join(b, (a.token == b.token) & (F.col("parta") != F.col("partb")) & (F.col("ga") != F.col("gb")) & _size_near(F.col("na"), F.col("nb"))
                 & (F.col("core") | (F.col("repa") < F.col("repb"))))
    swap = F.col("repa") > F.col("repb")
    pick = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y))
    counted = met.groupBy(pick("repb", "repa").alias("a"), pick("repa", "repb").alias("b"), pick("nb", "na").alias("na"), pick("na", "nb").alias("nb")).agg(
        F.count(F.lit(1)).alias("met"))
    rest = lambda n: n - prefix_size_column(n)
    reach = F.col("met") + F.greatest(rest(F.col("na")), rest(F.col("nb")))
    across = counted.filter(9 * reach >= 4 * (F.col("na") + F.col("nb"))).select("a", "b")
    candidates = written(across.union(inside), "candidates")
    more = _linked(candidates, _shingles(candidates, texts, reps))
    labels = connected_components(links.union(more).union(stars))

    heads = reps.select("rep", "head").join(labels, F.col("rep") == F.col("node"))
    first = heads.groupBy("label").agg(F.min("head").alias("least"))
    heads = written(heads.join(first, "label").select(F.col("rep").alias("node"), "least"), "heads")
    classes = reps.select("k1", "k2", "n", "rep", "head").join(heads, F.col("rep") == F.col("node"), "left")
    named = sets.select("doc_id", "key", "n", "k1", "k2").join(
        classes.select("k1", "k2", "n", F.coalesce("least", "head").alias("head")), ["k1", "k2", "n"], "left")
    return named.select("doc_id", "key", "n", F.coalesce("head", _head()).alias("head"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) for every row."""
    return _components(docs, id_col, text_col).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("head.doc_id").alias("component_id"))


def prefix_size_column(n: Column) -> Column:
    return n - F.ceil(n * 4 / 5).cast("int") + 1


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: the first by id; of rows equal in id and text one stays."""
    kept = _components(docs, id_col, text_col).filter(F.col("key") == F.col("head.key")).select(F.col("key").alias("_row key"))
    rows = docs.withColumn("_row key", row_key(docs[id_col].cast("long"), whole(docs[text_col])))
    return rows.join(kept, "_row key", "left_semi").dropDuplicates(["_row key"]).drop("_row key")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


@query("op2_ngram_join", sql=SQL)
def ngram_join(documents: DataFrame) -> DataFrame:
    return similar_components(documents)
