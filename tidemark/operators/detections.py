"""Tables of detected boxes: one row per box, with image, id, x1, y1, x2, y2, score, cls."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import boxes as B
from tidemark.operators.running import HOT_ROWS, split_hot, with_group_stats, with_row_number
from tidemark.session import ensure_checkpoint_dir

CORNERS = ("x1", "y1", "x2", "y2")
Tile = tuple[float, float]


def score_filter(dets: DataFrame, threshold: float, inclusive: bool = False, score: str | Column = "score") -> DataFrame:
    """Suppression keeps scores above the threshold; tensor post-processing those at it as well."""
    s = F.col(score) if isinstance(score, str) else score
    return dets.filter(s >= threshold if inclusive else s > threshold)


def area_filter(dets: DataFrame, low: float, high: float) -> DataFrame:
    """Boxes with low^2 < w * h < high^2."""
    size = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    return dets.filter((size > low * low) & (size < high * high))


def min_side_filter(dets: DataFrame, image: str = "image", side: float = 1.0, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Boxes with both sides above ``side``; an image without any keeps all of its boxes."""
    big = F.coalesce(F.least(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) > side, F.lit(False))
    flagged = with_group_stats(dets.withColumn("_big", big), [image], {"_any": F.max("_big")}, hot_rows)
    return flagged.filter(F.col("_big") | ~F.col("_any")).select(*dets.columns)


def top_class(preds: DataFrame, scores: str = "scores") -> DataFrame:
    """Best class (0-based, the first on a tie) and its score."""
    best = F.array_max(scores)
    return preds.withColumn("class_conf", best).withColumn(
        "class_pred", (F.array_position(F.col(scores), F.col("class_conf")) - 1).cast("int"))


def top_class_long(scores: DataFrame, keys: Sequence[str], cls: str = "cls", score: str = "score") -> DataFrame:
    """The same from one row per class."""
    order = F.struct(F.col(score), -F.col(cls))
    return scores.groupBy(*keys).agg(F.max_by(cls, order).alias("class_pred"), F.max(score).alias("class_conf"))


def count_by_class(dets: DataFrame, keys: Sequence[str] = ("image", "name")) -> DataFrame:
    return dets.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def nms_rank(dets: DataFrame, image: str = "image", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rank of a box in its image by falling score, then id. Blocks of a hot image are score bands."""
    return with_row_number(dets, "rank", [-F.col("score"), F.col("id")], F.floor(-F.col("score") * 1000),
                           [image], hot_rows)


def _level(tile: Tile, offset: float) -> Column:
    """The first level whose tiles are as large as the box; tiles double from level to level."""
    x1, y1, x2, y2 = B.box()
    ratio = F.greatest((x2 - x1 + offset) / tile[0], (y2 - y1 + offset) / tile[1], F.lit(1.0))
    return F.ceil(F.log2(ratio)).cast("int")


def _cells(df: DataFrame, tile: Tile, offset: float, level: Column, top: Column) -> DataFrame:
    """The tiles of a box on its own level and those above, up to ``top``: at most four on each."""
    size = [F.lit(float(s)) * F.pow(F.lit(2.0), F.col("_tl")) for s in tile]
    cells = df.withColumn("_tl", F.explode(F.sequence(level, top)))
    for name, low, high, s in (("_tx", "x1", "x2", size[0]), ("_ty", "y1", "y2", size[1])):
        first, last = F.floor(F.col(low) / s), F.floor((F.col(high) + offset) / s)
        cells = cells.withColumn(name, F.explode(F.when(first <= last, F.sequence(first, last))))
    return cells


def typical_tile(dets: DataFrame) -> Tile:
    """Twice the mean width and height, so that a box lies in few tiles and a tile holds few boxes."""
    x1, y1, x2, y2 = B.box()
    w, h = dets.agg(F.avg(x2 - x1), F.avg(y2 - y1)).first()
    return max(1.0, 2 * (w or 0.0)), max(1.0, 2 * (h or 0.0))


def overlapping_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("id",),
                      tile: Tile | None = None, offset: float = 0.0, condition: Column | None = None) -> DataFrame:
    """Pairs of boxes of the same ``keys`` that overlap, with their IoU.

    The join key is (keys, level, tile). Tiles double from level to level; a box lies on
    the first level whose tiles are as large as itself, where it covers four at most, and
    visits the tiles of the levels above, so a large box is not cut into many rows. Two
    boxes meet on the level of the larger one, in the tile of the upper left corner of
    their overlap, so nothing has to be made distinct. Work follows the boxes that are
    near each other and a crowded image spreads over its tiles. ``a_`` and ``b_`` name the
    two sides. Without a ``tile`` size one is taken from the mean size of the boxes of ``a``.
    """
    tile = tile or typical_tile(a)

    sides = [df.withColumn("_level", _level(tile, offset)) for df in (a, b)]
    tops = [df.agg(F.max("_level").alias("m")).first()["m"] or 0 for df in (sides[:1] if a is b else sides)]

    def side(df: DataFrame, p: str) -> DataFrame:
        cells = _cells(df, tile, offset, F.col("_level"), F.lit(max(tops)))
        return cells.select(*keys, "_tl", "_tx", "_ty", F.col("_level").alias(p + "level"), *[F.col(c).alias(p + c) for c in (*columns, *CORNERS)])
    pairs = side(sides[0], "a_").join(side(sides[1], "b_"), [*keys, "_tl", "_tx", "_ty"])
    left, right = B.box("a_"), B.box("b_")
    scale = F.pow(F.lit(2.0), F.col("_tl"))
    home = ((F.greatest("a_level", "b_level") == F.col("_tl"))
            & (F.floor(F.greatest(left[0], right[0]) / (tile[0] * scale)) == F.col("_tx"))
            & (F.floor(F.greatest(left[1], right[1]) / (tile[1] * scale)) == F.col("_ty")))
    hit = home & (B.intersection(left, right, offset) > 0)
    if condition is not None:
        hit = hit & condition
    return pairs.filter(hit).withColumn("iou", B.iou(left, right, offset)).select(
        *keys, *[F.col(p + c) for p in ("a_", "b_") for c in columns], "iou")


def pairwise_iou(dets: DataFrame, image: str = "image", tile: Tile | None = None, direct_boxes: int = 128) -> DataFrame:
    """IoU of every two overlapping boxes of an image (a_id < b_id); all other pairs have IoU 0.

    In an image of up to ``direct_boxes`` boxes a box meets the few others directly;
    larger images are joined tile by tile.
    """
    small, large = split_hot(dets, [image], direct_boxes)

    def side(p: str) -> DataFrame:
        return small.select(image, *[F.col(c).alias(p + c) for c in ("id", *CORNERS)])
    left, right = B.box("a_"), B.box("b_")
    near = side("a_").join(side("b_"), image).filter(
        (F.col("a_id") < F.col("b_id")) & (B.intersection(left, right) > 0))
    pairs = near.select(image, "a_id", "b_id", B.iou(left, right).alias("iou"))
    if large is None:
        return pairs
    return pairs.unionByName(overlapping_pairs(
        large, large, [image], tile=tile, condition=F.col("a_id") < F.col("b_id")))


def box_classes(dets: DataFrame, image: str = "image") -> DataFrame:
    """image, id, ``class_id``: the smallest id of the boxes of the image with the same corners."""
    corners = [F.col(c).alias(f"_{c}") for c in CORNERS]
    first = dets.groupBy(F.col(image).alias("_image"), *corners).agg(F.min("id").alias("class_id"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (image, *CORNERS)])
    return dets.select(image, "id", *CORNERS).join(first, same).select(image, "id", "class_id")


def class_pairs(dets: DataFrame, image: str = "image", tile: Tile | None = None) -> DataFrame:
    """Overlapping boxes of an image with copies counted, not listed: image, a_class, b_class, iou, a_boxes, b_boxes.

    Boxes with the same corners are one class. A class of several boxes is paired with itself once, so a pile of
    n copies is a row and not n * n / 2 of them. :func:`box_classes` gives the members and
    :func:`pairs_of_classes` every pair.
    """
    classes = dets.groupBy(image, *CORNERS).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("boxes"))
    ensure_checkpoint_dir(dets.sparkSession)
    classes = classes.checkpoint()
    between = overlapping_pairs(classes, classes, [image], ("id", "boxes"), tile, condition=F.col("a_id") < F.col("b_id")).select(
        image, F.col("a_id").alias("a_class"), F.col("b_id").alias("b_class"), "iou", "a_boxes", "b_boxes")
    itself = classes.filter((F.col("boxes") > 1) & (B.intersection(B.box(), B.box()) > 0)).select(
        image, F.col("id").alias("a_class"), F.col("id").alias("b_class"), B.iou(B.box(), B.box()).alias("iou"),
        F.col("boxes").alias("a_boxes"), F.col("boxes").alias("b_boxes"))
    return between.unionByName(itself)


def pairs_of_classes(pairs: DataFrame, members: DataFrame, image: str = "image") -> DataFrame:
    """The pairs of boxes (a_id < b_id) that some rows of :func:`class_pairs` stand for."""
    one, two = (members.select(image, F.col("id").alias(f"_{p}"), F.col("class_id").alias(f"{p}_class")) for p in "ab")
    all_of = pairs.join(one, [image, "a_class"]).join(two, [image, "b_class"]).filter(
        (F.col("a_class") != F.col("b_class")) | (F.col("_a") < F.col("_b")))
    return all_of.select(image, F.least("_a", "_b").alias("a_id"), F.greatest("_a", "_b").alias("b_id"), "iou")


def nms(dets: DataFrame, iou_threshold: float = 0.45, score_threshold: float = 0.1, class_aware: bool = False,
        image: str = "image", cls: str = "cls", max_boxes: int = 2_000, tile: Tile | None = None) -> DataFrame:
    """Greedy suppression per image, or per image and class: in the order of falling
    score (id on a tie) a box stays when no box kept before overlaps it by more than
    ``iou_threshold``. Areas count the border pixel.

    Groups of up to ``max_boxes`` boxes are folded as one array by built-in functions.
    Larger ones are decided in rounds over a table of overlapping pairs, so a crowded
    image is never held in one task; both ways give the same boxes.
    """
    keys = [image, cls] if class_aware else [image]
    candidates = score_filter(dets, score_threshold)
    if iou_threshold >= 1:
        return candidates
    small, large = split_hot(candidates, keys, max_boxes)
    kept = _fold(small, keys, iou_threshold)
    if large is None:
        return kept
    return kept.unionByName(_rounds(large, keys, iou_threshold, tile))


def _fold(dets: DataFrame, keys: Sequence[str], threshold: float) -> DataFrame:
    """Greedy suppression of bounded groups: fold the sorted boxes into the kept ones."""
    rest = [c for c in dets.columns if c not in (*keys, "score", "id")]
    row = F.struct((-F.col("score")).alias("_o"), F.col("id"), F.col("score"), *rest)
    grouped = dets.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_boxes"))
    kind = grouped.schema["_boxes"].dataType

    def corners(b: Column) -> B.Box:
        return tuple(b[c] for c in CORNERS)
    kept = F.aggregate(
        F.col("_boxes"), F.array().cast(kind),
        lambda acc, b: F.when(F.exists(acc, lambda k: B.iou(corners(k), corners(b), 1.0) > threshold), acc)
        .otherwise(F.concat(acc, F.array(b))))
    return grouped.select(*keys, F.explode(kept).alias("_b")).select(
        *[F.col(c) if c in keys else F.col("_b")[c].alias(c) for c in dets.columns])


def _rounds(dets: DataFrame, keys: Sequence[str], threshold: float, tile: Tile | None,
            pairs_per_box: int = 2_000) -> DataFrame:
    """Greedy suppression of large groups, decided in rounds over all of them at once.

    Copies of a box share its fate except that the best one suppresses the others, so
    only that one is looked at. A box lies in the tiles of its level, four at most, and of the few levels
    above in which there may be boxes that it overlaps by more than the threshold: those are at most
    1 / threshold times as wide or high. Two such boxes meet in a tile of the larger one's level.
    While the tiles are crowded, the best box of all its
    tiles stays and removes what it overlaps: a tile has one best box, so a round is
    linear in the boxes however many of them lie on top of each other. Once at most
    ``pairs_per_box`` neighbours per box are left, the rest is decided on the table of
    overlapping pairs.
    """
    ensure_checkpoint_dir(dets.sparkSession)
    rest = [c for c in dets.columns if c not in (*keys, *CORNERS)]
    rank = F.struct((-F.col("score")).alias("s"), F.col("id"))
    own = B.iou(B.box(), B.box(), 1.0) > threshold  # else copies do not suppress each other: inverted boxes, NULL corners
    alone = F.when(F.coalesce(own, F.lit(False)), F.lit(None)).otherwise(F.col("id"))
    boxes = dets.withColumn("_alone", alone).groupBy(*keys, *CORNERS, "_alone").agg(F.min_by(F.struct(*rest), rank).alias("_b")).select(
        *keys, *CORNERS, "_b.*").withColumn("n", F.struct(*keys, "id")).checkpoint()
    tile = tile or typical_tile(boxes)
    level = _level(tile, 1.0)
    highest = boxes.agg(F.max(level).alias("m")).first()["m"] or 0
    apart = min(highest, math.ceil(math.log2(1 / threshold)) + 1) if threshold > 0 else highest
    place = [*keys, "_tl", "_tx", "_ty"]

    def placed(df: DataFrame) -> DataFrame:
        return _cells(df, tile, 1.0, level, level + apart)
    alive, kept = boxes, []
    while True:
        cells = placed(alive)
        best = cells.groupBy(*place).agg(F.count(F.lit(1)).alias("c"), F.min_by("n", rank).alias("n"))
        load = best.agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).first()["pairs"]
        if load is None or load <= pairs_per_box * alive.count():
            break
        won = best.groupBy("n").agg(F.count(F.lit(1)).alias("_won"))
        covered = cells.groupBy("n").agg(F.count(F.lit(1)).alias("_all"))
        roots = won.join(covered, "n").filter("_won = _all").select("n").checkpoint()
        winners = placed(boxes.join(roots, "n", "left_semi")).select(
            *place, F.col("n").alias("a_n"), *[F.col(c).alias("a_" + c) for c in CORNERS])
        hit = cells.join(winners, place).filter(
            (F.col("n") != F.col("a_n")) & (B.iou(B.box("a_"), B.box(), 1.0) > threshold)).select("n").distinct()
        alive = alive.join(roots.unionAll(hit), "n", "left_anti").checkpoint()
        kept.append(roots)
    kept.append(_decide_pairs(alive, keys, threshold, tile))
    stays = reduce(lambda a, b: a.unionAll(b), kept)
    return boxes.join(stays, "n", "left_semi").select(*dets.columns)


def _decide_pairs(boxes: DataFrame, keys: Sequence[str], threshold: float, tile: Tile) -> DataFrame:
    """Boxes that stay, by rounds on the suppression graph: a box without an undecided
    better neighbour stays and removes its neighbours."""
    better = (F.col("a_score") > F.col("b_score")) | (
        (F.col("a_score") == F.col("b_score")) & (F.col("a_id") < F.col("b_id")))
    pairs = overlapping_pairs(boxes, boxes, keys, ("id", "score", "n"), tile, 1.0, better)
    edges = pairs.filter(F.col("iou") > threshold).select(
        F.col("a_n").alias("hi"), F.col("b_n").alias("lo")).checkpoint()
    alive, kept = boxes.select("n"), []
    while True:
        roots = alive.join(edges.select(F.col("lo").alias("n")), "n", "left_anti").checkpoint()
        kept.append(roots)
        if edges.isEmpty():
            return reduce(lambda a, b: a.unionAll(b), kept)
        hit = edges.join(roots, F.col("hi") == F.col("n"), "left_semi").select(
            F.col("lo").alias("n")).distinct().checkpoint()
        alive = alive.join(roots.unionAll(hit), "n", "left_anti").checkpoint()
        edges = (edges.join(hit, F.col("lo") == F.col("n"), "left_anti")
                 .join(hit, F.col("hi") == F.col("n"), "left_anti").checkpoint())
