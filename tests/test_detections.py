"""Boxes: suppression against a plain loop, pairs against all pairs, the documented sample."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import boxes as B
from tidemark.operators import detections as D
from tidemark.sources.files import DETECTION_SCHEMA

SCHEMA = "image INT, id INT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, score DOUBLE, cls INT"


def crowd(seed: int, n: int, images: int):
    """Two thirds of the boxes are in image 0; there are copies and equal scores."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        image = 0 if rnd.random() < 0.67 else rnd.randrange(images)
        if out and rnd.random() < 0.2:
            _, _, x1, y1, x2, y2, _, _ = rnd.choice(out)
        else:
            x1, y1 = rnd.uniform(0, 600), rnd.uniform(0, 300)
            x2, y2 = x1 + rnd.uniform(2, 300), y1 + rnd.uniform(2, 200)
        out.append((image, i, x1, y1, x2, y2, round(rnd.random(), 2), rnd.randrange(3)))
    return out


def overlap(a, b, off=0.0):
    w = max(0.0, min(a[4], b[4]) - max(a[2], b[2]) + off)
    h = max(0.0, min(a[5], b[5]) - max(a[3], b[3]) + off)
    area = [(r[4] - r[2] + off) * (r[5] - r[3] + off) for r in (a, b)]
    return w * h / (sum(area) - w * h)


def greedy(data, thr, score_thr, key):
    kept = []
    for r in sorted((r for r in data if r[6] > score_thr), key=lambda r: (-r[6], r[1])):
        if all(key(k) != key(r) or overlap(k, r, 1.0) <= thr for k in kept):
            kept.append(r)
    return sorted((r[0], r[1]) for r in kept)


@pytest.mark.parametrize("class_aware", [False, True])
@pytest.mark.parametrize("max_boxes", [10_000, 20, 0])
def test_nms(spark, class_aware, max_boxes):
    data = crowd(7, 400, 12)
    dets = spark.createDataFrame(data, SCHEMA)
    got = D.nms(dets, 0.45, 0.1, class_aware, max_boxes=max_boxes)
    assert got.columns == dets.columns
    key = (lambda r: (r[0], r[7])) if class_aware else (lambda r: r[0])
    assert rows(got, "image", "id") == greedy(data, 0.45, 0.1, key)


@pytest.mark.parametrize("pairs_per_box", [0, 3, 10**6])
def test_nms_of_a_pile_of_boxes(spark, pairs_per_box):
    """Many nearly equal boxes: decided tile by tile, by pairs, or by both."""
    rnd = random.Random(11)
    data = []
    for i in range(300):
        x, y = rnd.choice([(0, 0), (3, 4), (400, 20), (900, 500)])
        x, y = x + rnd.uniform(0, 3), y + rnd.uniform(0, 3)
        data.append((rnd.randrange(2), i, x, y, x + 50 + rnd.uniform(0, 4), y + 30, round(rnd.random(), 2), 0))
    dets = spark.createDataFrame(data, SCHEMA).filter("score > 0.1")
    for tile in (None, (20.0, 20.0)):
        got = D._rounds(dets, ["image"], 0.6, tile, pairs_per_box)
        assert rows(got, "image", "id") == greedy(data, 0.6, 0.1, lambda r: r[0])


def test_nms_ways_agree_on_degenerate_boxes(spark):
    rows_ = [("i", i, x1, 0.0, x2, 10.0, s) for i, (x1, x2, s) in enumerate(
        [(0.0, 10.0, 0.9), (0.0, 10.0, 0.8), (20.0, 5.0, 0.7), (20.0, 5.0, 0.7), (20.0, 5.0, 0.6), (None, 10.0, 0.5), (None, 10.0, 0.5),
         (3.0, 3.0, 0.4), (3.0, 3.0, 0.4), (100.0, 110.0, 0.9)])]
    dets = spark.createDataFrame(rows_, "image STRING, id LONG, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, score DOUBLE")
    ways = [sorted(r.id for r in D.nms(dets, 0.45, 0.1, max_boxes=n).collect()) for n in (10_000, 1)]
    assert ways[0] == ways[1]


def test_nms_keeps_at_the_threshold(spark):
    # two boxes of 10 x 10 pixels that share 5 x 10: IoU is exactly one third
    data = [(1, 1, 0.0, 0.0, 9.0, 9.0, 0.9, 0), (1, 2, 5.0, 0.0, 14.0, 9.0, 0.8, 0)]
    dets = spark.createDataFrame(data, SCHEMA)
    for max_boxes in (10, 1):
        assert D.nms(dets, 50 / 150, 0.1, max_boxes=max_boxes).count() == 2
        assert D.nms(dets, 0.33, 0.1, max_boxes=max_boxes).count() == 1
        assert D.nms(dets, 0.33, 0.8, max_boxes=max_boxes).count() == 1
    assert D.nms(dets, 1.0, 0.1).count() == 2


@pytest.mark.parametrize("direct", [0, 50, 1000])
@pytest.mark.parametrize("tile", [None, (16.0, 40.0), (5000.0, 5000.0)])
def test_pairs(spark, tile, direct):
    data = crowd(3, 150, 5)
    got = D.pairwise_iou(spark.createDataFrame(data, SCHEMA), tile=tile, direct_boxes=direct)
    want = sorted((a[0], a[1], b[1], overlap(a, b)) for a in data for b in data
                  if a[0] == b[0] and a[1] < b[1] and overlap(a, b) > 0)
    found = rows(got, "image", "a_id", "b_id", "iou")
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert all(x[3] == pytest.approx(y[3]) for x, y in zip(found, want))


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_rank_and_side_filter_of_a_hot_image(spark, hot_rows):
    data = crowd(5, 200, 8)
    dets = spark.createDataFrame(data, SCHEMA)
    want = []
    for image in {r[0] for r in data}:
        ordered = sorted((r for r in data if r[0] == image), key=lambda r: (-r[6], r[1]))
        want += [(image, r[1], i + 1) for i, r in enumerate(ordered)]
    assert rows(D.nms_rank(dets, hot_rows=hot_rows), "image", "id", "rank") == sorted(want)

    side = 120.0
    big = {r[:2] for r in data if min(r[4] - r[2], r[5] - r[3]) > side}
    usable = {image for image, _ in big}
    assert rows(D.min_side_filter(dets, side=side, hot_rows=hot_rows), "image", "id") == sorted(
        r[:2] for r in data if r[:2] in big or r[0] not in usable)


# Rows of the documented sample.
SAMPLE = """
{"xmin":103.2,"ymin":292.4,"xmax":437.8,"ymax":615.8,"confidence":0.8725585938,"class":56,"name":"chair"}
{"xmin":774.8,"ymin":246.4,"xmax":1126.9,"ymax":567.5,"confidence":0.841796875,"class":56,"name":"chair"}
{"xmin":0.4,"ymin":244.3,"xmax":150.4,"ymax":483.6,"confidence":0.8344726562,"class":56,"name":"chair"}
{"xmin":752.3,"ymin":97.0,"xmax":821.7,"ymax":220.5,"confidence":0.8227539062,"class":0,"name":"person"}
{"xmin":536.2,"ymin":107.1,"xmax":659.1,"ymax":210.5,"confidence":0.7124023438,"class":0,"name":"person"}
{"xmin":356.0,"ymin":218.4,"xmax":984.4,"ymax":491.1,"confidence":0.6181640625,"class":57,"name":"couch"}
{"xmin":85.9,"ymin":154.1,"xmax":185.5,"ymax":284.9,"confidence":0.5854492188,"class":58,"name":"potted plant"}
{"xmin":674.5,"ymin":122.0,"xmax":729.8,"ymax":205.2,"confidence":0.384765625,"class":58,"name":"potted plant"}
{"xmin":233.6,"ymin":220.1,"xmax":367.0,"ymax":321.9,"confidence":0.2978515625,"class":56,"name":"chair"}
{"xmin":440.4,"ymin":0.0,"xmax":626.7,"ymax":173.2,"confidence":0.2956542969,"class":58,"name":"potted plant"}
{"xmin":0.9,"ymin":146.6,"xmax":44.6,"ymax":170.0,"confidence":0.2568359375,"class":58,"name":"potted plant"}
""".strip().splitlines()


def test_documented_sample(spark):
    records = [json.loads(line) for line in SAMPLE]
    dets = spark.createDataFrame([tuple(r.values()) for r in records], DETECTION_SCHEMA).withColumn("image", F.lit(1))
    assert rows(D.count_by_class(dets)) == [(1, "chair", 4), (1, "couch", 1), (1, "person", 2), (1, "potted plant", 4)]
    names = dets.select(B.class_name(F.col("class")).alias("n"), "name").collect()
    assert all(r["n"] == r["name"] for r in names)
    label = dets.select(B.class_label(F.col("name"), F.col("confidence")).alias("l")).first()["l"]
    assert label == "chair:87.3%"


def test_class_names(spark):
    assert len(B.CLASS_NAMES) == len(set(B.CLASS_NAMES)) == 80
    got = spark.createDataFrame([(i,) for i in (-1, 0, 79, 80)], "i INT").select(B.class_name(F.col("i")).alias("n")).collect()
    assert [r["n"] for r in got] == [None, "person", "toothbrush", None]


def test_top_class_takes_the_first_maximum(spark):
    df = spark.createDataFrame([(1, [0.1, 0.7, 0.7]), (2, [0.5, 0.5, 0.2])], "id INT, scores ARRAY<DOUBLE>")
    assert rows(D.top_class(df), "id", "class_pred", "class_conf") == [(1, 1, 0.7), (2, 0, 0.5)]
    long = df.select("id", F.posexplode("scores").alias("cls", "score"))
    assert rows(D.top_class_long(long, ["id"])) == [(1, 1, 0.7), (2, 0, 0.5)]


@pytest.mark.parametrize("p6", [False, True])
def test_anchor_grid(spark, p6):
    got = spark.range(1).select(F.inline(B.anchor_grid(416, 320, p6))).collect()
    want = [(s, x, y) for s in ((8, 16, 32, 64) if p6 else (8, 16, 32))
            for y in range(416 // s) for x in range(320 // s)]
    assert [tuple(r) for r in got] == want


def test_decode_anchor(spark):
    cells = spark.range(1).select(F.inline(B.anchor_grid(64, 64)))
    cx, cy, w, h = B.decode_anchor(F.lit(0.5), F.lit(0.25), F.lit(0.0), F.lit(1.0), F.col("gx"), F.col("gy"), F.col("stride"))
    r = cells.select("*", cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h")).filter("stride = 16 AND gx = 2 AND gy = 3").first()
    assert (r["cx"], r["cy"], r["w"]) == (40.0, 52.0, 16.0) and r["h"] == pytest.approx(2.718281828 * 16)


def test_box_arithmetic(spark):
    df = spark.createDataFrame([(10.0, 20.0, 50.0, 100.0)], "x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE")

    def of(values):
        return tuple(df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).first())
    assert of(B.xyxy_to_xywh(B.box())) == (10, 20, 40, 80)
    assert of(B.xyxy_to_cxcywh(B.box())) == (30, 60, 40, 80)
    assert of(B.cxcywh_to_xyxy(*B.xyxy_to_cxcywh(B.box()))) == (10, 20, 50, 100)
    assert of(B.rescale_clip(B.box(), 2.0, 5.0, -50.0, 90.0, 120.0)) == (25, 0, 90, 120)
    assert of(B.unscale(B.box(), 2.0)) == (5, 10, 25, 50)
    assert of(B.mirror_box(B.box(), 100)) == (50, 20, 90, 100)
    assert of(B.affine_box(B.box(), ((0, -1, 120), (1, 0, 0)), 100, 45)) == (20, 10, 100, 45)
    a, b = B.box(), (F.lit(51.0), F.lit(20.0), F.lit(60.0), F.lit(100.0))
    assert of([B.iou(a, b), B.iou(a, a)]) == (0.0, 1.0)
    assert of([B.iou(a, b, 1.0)])[0] == 0.0 and of([B.intersection(a, a, 1.0)])[0] == 41 * 81


def test_filters(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 4.0, 4.0, 0.5), (2, 0.0, 0.0, 2.0, 2.0, 0.4)],
                               "id INT, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, score DOUBLE")
    assert rows(D.score_filter(df, 0.5), "id") == [] and rows(D.score_filter(df, 0.5, True), "id") == [(1,)]
    assert rows(D.area_filter(df, 2, 4), "id") == [] and rows(D.area_filter(df, 1, 4.1), "id") == [(1,), (2,)]


def test_overlapping_pairs_of_very_different_boxes(spark):
    rnd = random.Random(4)
    side = lambda: rnd.choice((1.0, 3.0, 40.0, 900.0)) * rnd.random()
    data = []
    for i in range(150):
        x, y = rnd.random() * 1000, rnd.random() * 1000
        data.append(("i", i, x, y, x + side(), y + side(), 0.5))
    dets = spark.createDataFrame(data, "image STRING, id LONG, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, score DOUBLE")
    want = {(a[1], b[1]) for a in data for b in data if a[1] < b[1] and min(a[4], b[4]) > max(a[2], b[2]) and min(a[5], b[5]) > max(a[3], b[3])}
    for tile in (None, (5.0, 5.0), (2000.0, 2000.0)):
        got = D.overlapping_pairs(dets, dets, ["image"], tile=tile, condition=F.col("a_id") < F.col("b_id")).select("a_id", "b_id").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_large_box_does_not_grow_the_plan(spark):
    """Ten thousand tiles wide, in an image of small boxes."""
    rnd = random.Random(6)
    data = [(0, i, x, y, x + 4, y + 4, round(rnd.random(), 3), 0) for i in range(300) for x, y in [(rnd.uniform(0, 60), rnd.uniform(0, 60))]]
    data += [(0, 1000, 0.0, 0.0, 40_000.0, 40_000.0, 0.99, 0), (0, 1001, 10.0, 0.0, 40_000.0, 39_000.0, 0.5, 0), (0, 1002, 0.0, 0.0, 30_000.0, 20_000.0, 0.98, 0)]
    dets = spark.createDataFrame(data, SCHEMA)
    level = D._level((8.0, 8.0), 1.0)
    cells = D._cells(dets, (8.0, 8.0), 1.0, level, level + 3).groupBy("id", "_tl").count()
    assert cells.agg(F.max("count")).first()[0] <= 4 and cells.groupBy("id").count().agg(F.max("count")).first()[0] == 4
    for pairs_per_box in (0, 10**6):
        got = D._rounds(dets.filter("score > 0.1"), ["image"], 0.45, (8.0, 8.0), pairs_per_box)
        assert rows(got, "image", "id") == greedy(data, 0.45, 0.1, lambda r: r[0])


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.9])
def test_levels_for_any_threshold(spark, threshold):
    rnd = random.Random(8)
    data = []
    for i in range(80):
        x, y, w, h = rnd.uniform(0, 100), rnd.uniform(0, 100), rnd.choice((2, 9, 70, 400)), rnd.choice((2, 9, 70, 400))
        data.append((i % 2, i, x, y, x + w, y + h, round(rnd.random(), 2), 0))
    dets = spark.createDataFrame(data, SCHEMA).filter("score > 0.1")
    got = D._rounds(dets, ["image"], threshold, (4.0, 4.0), 0)
    assert rows(got, "image", "id") == greedy(data, threshold, 0.1, lambda r: r[0])


def test_copies_are_a_class(spark):
    data = crowd(9, 150, 4)
    dets = spark.createDataFrame(data, SCHEMA)
    pairs = D.class_pairs(dets)
    want = sorted((a[0], a[1], b[1]) for a in data for b in data if a[0] == b[0] and a[1] < b[1] and overlap(a, b) > 0)
    assert rows(D.pairs_of_classes(pairs, D.box_classes(dets)), "image", "a_id", "b_id") == want
    assert pairs.count() < len(want)


def test_a_pile_of_equal_boxes_is_one_row(spark):
    pile = spark.range(200_000).selectExpr("1 AS image", "CAST(id AS INT) AS id", "1.0D AS x1", "1.0D AS y1", "9.0D AS x2", "9.0D AS y2", "0.5D AS score", "0 AS cls")
    got = D.class_pairs(pile.unionByName(spark.createDataFrame([(1, 300_000, 5.0, 5.0, 13.0, 13.0, 0.5, 0)], SCHEMA))).collect()
    assert sorted((r.a_class, r.b_class, r.a_boxes, r.b_boxes) for r in got) == [(0, 0, 200_000, 200_000), (0, 300_000, 200_000, 1)]
    assert D.class_pairs(pile.limit(0)).collect() == []
