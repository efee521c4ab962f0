"""Boxes on lineitem: an order is an image, its lines are the boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import boxes as B
from tidemark.operators import detections as D
from tidemark.plans.registry import query


def four(values, digits: int = 6, names=("c1", "c2", "c3", "c4")):
    return [F.round(v, digits).alias(n) for v, n in zip(values, names)]


def iou_sql(a: str, b: str, off: float = 0.0) -> str:
    w = f"greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1) + {off})"
    h = f"greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1) + {off})"
    area_a, area_b = (f"(({p}.x2 - {p}.x1 + {off}) * ({p}.y2 - {p}.y1 + {off}))" for p in (a, b))
    return f"({w} * {h} / ({area_a} + {area_b} - {w} * {h}))"


def clip(v: str, top: float) -> str:
    return f"round(greatest(0.0, least({top}, {v})), 6)"


@query("p13", "SELECT image, id, score FROM box WHERE score > 0.5", using=("box",))
def p13(t):
    return D.score_filter(t.fixture("box"), 0.5).select("image", "id", "score")


@query("p13_inclusive", "SELECT image, id, score * score AS score FROM box WHERE score * score >= 0.25", using=("box",))
def p13_inclusive(t):
    s = F.col("score") * F.col("score")
    return D.score_filter(t.fixture("box"), 0.25, True, s).select("image", "id", s.alias("score"))


@query("p14", "SELECT image, id FROM box WHERE (x2 - x1) * (y2 - y1) > 3600 AND (x2 - x1) * (y2 - y1) < 8100", using=("box",))
def p14(t):
    return D.area_filter(t.fixture("box"), 60, 90).select("image", "id")


@query("p15", """, thin AS (SELECT image, id, x1, y1, x1 + cls * 0.6 AS x2, y2 FROM box),
flags AS (SELECT *, least(x2 - x1, y2 - y1) > 1 AS big, max(least(x2 - x1, y2 - y1)) OVER (PARTITION BY image) > 1 AS usable FROM thin)
SELECT image, id FROM flags WHERE big OR NOT usable""", using=("box",))
def p15(t):
    thin = t.fixture("box").withColumn("x2", F.col("x1") + F.col("cls") * 0.6)
    return D.min_side_filter(thin).select("image", "id")


@query("j8", f""", pairs AS (SELECT a.image, a.id AS a_id, b.id AS b_id, {iou_sql('a', 'b')} AS iou
  FROM box a JOIN box b ON a.image = b.image AND a.id < b.id)
SELECT image, a_id, b_id, round(iou, 9) AS iou FROM pairs WHERE iou > 0""", using=("box",))
def j8(t):
    return D.pairwise_iou(t.fixture("box")).withColumn("iou", F.round("iou", 9)).select(
        "image", "a_id", "b_id", "iou")


@query("j8_classes", f""", classes AS (SELECT image, x1, y1, x2, y2, min(id) AS id, count(*) AS boxes FROM box GROUP BY ALL)
SELECT a.image, a.id AS a_class, b.id AS b_class, round({iou_sql('a', 'b')}, 9) AS iou, a.boxes AS a_boxes, b.boxes AS b_boxes
FROM classes a JOIN classes b ON a.image = b.image AND (a.id < b.id OR a.id = b.id AND a.boxes > 1) WHERE {iou_sql('a', 'b')} > 0""", using=("box",))
def j8_classes(t):
    """Boxes on a coarse grid, so that there are copies."""
    return D.class_pairs(t.fixture("box")).withColumn("iou", F.round("iou", 9))


NAMES = "['person', 'bicycle', 'car', 'motorcycle', 'airplane']"


@query("a4", f"SELECT image, {NAMES}[cls + 1] AS name, count(*) AS n FROM box GROUP BY 1, 2", using=("box",))
def a4(t):
    return D.count_by_class(t.fixture("box").withColumn("name", B.class_name(F.col("cls"))))


@query("a5", """, s AS (SELECT image, id, [score, cls / 4, 0.5] AS v FROM box)
SELECT image, id, list_max(v) AS class_conf, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS class_pred FROM s""", using=("box",))
def a5(t):
    scores = F.array(F.col("score"), F.col("cls") / 4, F.lit(0.5))
    return D.top_class(t.fixture("box").withColumn("scores", scores)).select(
        "image", "id", "class_conf", "class_pred")


@query("a5_long", """SELECT image, arg_max(cls, (score, -cls)) AS class_pred, max(score) AS class_conf FROM box GROUP BY image""",
       using=("box",))
def a5_long(t):
    return D.top_class_long(t.fixture("box"), ["image"])


@query("w10", "SELECT image, id, row_number() OVER (PARTITION BY image ORDER BY score DESC, id) AS rank FROM box", using=("box",))
def w10(t):
    return D.nms_rank(t.fixture("box")).select("image", "id", "rank")


@query("f26", f"SELECT image, id, {NAMES}[cls + 1] || ':' || printf('%.1f', score * 100) || '%' AS label FROM box", using=("box",))
def f26(t):
    return t.fixture("box").select("image", "id",
                                   B.class_label(B.class_name(F.col("cls")), F.col("score")).alias("label"))


@query("f27", f"SELECT image, id, CASE WHEN cls < 4 THEN {NAMES}[cls + 1] END AS name FROM box", using=("box",))
def f27(t):
    index = F.when(F.col("cls") < 4, F.col("cls")).otherwise(F.lit(80))
    return t.fixture("box").select("image", "id", B.class_name(index).alias("name"))


@query("f28", """SELECT image, id, x1 AS c1, y1 AS c2, x2 - x1 AS c3, y2 - y1 AS c4, round(x1 + (x2 - x1) * 0.5, 6) AS d1,
  round(y1 + (y2 - y1) * 0.5, 6) AS d2, x1 AS e1, y2 AS e4 FROM box""", using=("box",))
def f28(t):
    cx, cy, w, h = B.xyxy_to_cxcywh(B.box())
    back = B.cxcywh_to_xyxy(cx, cy, w, h)
    return t.fixture("box").select(
        "image", "id", *four(B.xyxy_to_xywh(B.box())), F.round(cx, 6).alias("d1"),
        F.round(cy, 6).alias("d2"), F.round(back[0], 6).alias("e1"), F.round(back[3], 6).alias("e4"))


@query("f29", f"""SELECT image, id, {clip('x1 * 1.5 - 40.0', 320.0)} AS c1, {clip('y1 * 1.5 + 7.0', 416.0)} AS c2,
  {clip('x2 * 1.5 - 40.0', 320.0)} AS c3, {clip('y2 * 1.5 + 7.0', 416.0)} AS c4, round(x1 / 1.5, 6) AS u1 FROM box""", using=("box",))
def f29(t):
    return t.fixture("box").select(
        "image", "id", *four(B.rescale_clip(B.box(), 1.5, -40.0, 7.0, 320.0, 416.0)),
        F.round(B.unscale(B.box(), 1.5)[0], 6).alias("u1"))


@query("f30", "SELECT image, id, 640.0::DOUBLE - x2 AS c1, y1 AS c2, 640.0::DOUBLE - x1 AS c3, y2 AS c4 FROM box", using=("box",))
def f30(t):
    return t.fixture("box").select("image", "id", *four(B.mirror_box(B.box(), 640)))


MATRIX = ((0.9, -0.25, 12.0), (0.5, 1.1, -30.0))


def _corner(x: str, y: str, row: int) -> str:
    a, b, c = MATRIX[row]
    return f"({x} * {a} + {y} * {b} + {c})"


def _affine(fn: str, row: int, top: float) -> str:
    cs = ", ".join(_corner(x, y, row) for x, y in (("x1", "y1"), ("x2", "y2"), ("x1", "y2"), ("x2", "y1")))
    return clip(f"{fn}({cs})", top)


@query("f31", f"""SELECT image, id, {_affine('least', 0, 416.0)} AS c1, {_affine('least', 1, 320.0)} AS c2,
  {_affine('greatest', 0, 416.0)} AS c3, {_affine('greatest', 1, 320.0)} AS c4 FROM box""", using=("box",))
def f31(t):
    return t.fixture("box").select("image", "id",
                                   *four(B.affine_box(B.box(), MATRIX, 416.0, 320.0)))


@query("f32", """SELECT image, gx, gy, round((dx + gx) * stride, 6) AS c1, round((dy + gy) * stride, 6) AS c2,
  round(exp(lw) * stride, 6) AS c3, round(exp(lh) * stride, 6) AS c4 FROM anch""", using=("anch",))
def f32(t):
    parts = [F.col(c) for c in ("dx", "dy", "lw", "lh", "gx", "gy", "stride")]
    return t.fixture("anch").select("image", "gx", "gy", *four(B.decode_anchor(*parts)))


@query("f33", f""", a AS (SELECT image, id, x1, y1, x2, y2 FROM box), b AS (SELECT image, id, x1 + cls * 20 AS x1, y1 + 5 AS y1, x2 + cls * 20 AS x2, y2 + 5 AS y2 FROM box)
SELECT a.image, a.id, round({iou_sql('a', 'b')}, 9) AS iou, round({iou_sql('a', 'b', 1.0)}, 9) AS iou1
FROM a JOIN b ON a.image = b.image AND a.id = b.id""", using=("box",))
def f33(t):
    shift = F.col("cls") * 20
    x1, y1, x2, y2 = B.box()
    moved = (x1 + shift, y1 + 5, x2 + shift, y2 + 5)
    return t.fixture("box").select(
        "image", "id", F.round(B.iou(B.box(), moved), 9).alias("iou"),
        F.round(B.iou(B.box(), moved, 1.0), 9).alias("iou1"))


def nms_sql(keys: str) -> str:
    """Greedy suppression as a recursion over the rank of a box in its group."""
    overlap = iou_sql("k", "r", 1.0)
    return f""", ranked AS (SELECT image, id, x1, y1, x2, y2, score, cls,
  row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, id) AS rn FROM box WHERE score > 0.1),
step AS (
  SELECT {keys}, 1 AS rn, [struct_pack(id := id, x1 := x1, y1 := y1, x2 := x2, y2 := y2)] AS kept FROM ranked WHERE rn = 1
  UNION ALL
  SELECT {', '.join('s.' + k.strip() for k in keys.split(','))}, s.rn + 1,
    CASE WHEN len(list_filter(s.kept, lambda k: {overlap} > 0.45)) > 0 THEN s.kept
         ELSE list_append(s.kept, struct_pack(id := r.id, x1 := r.x1, y1 := r.y1, x2 := r.x2, y2 := r.y2)) END
  FROM step s JOIN ranked r ON {' AND '.join(f's.{k.strip()} = r.{k.strip()}' for k in keys.split(','))} AND r.rn = s.rn + 1),
done AS (SELECT {keys}, unnest(kept).id AS id FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY rn DESC) AS l FROM step) WHERE l = 1)
SELECT image, id FROM done"""


@query("m2", nms_sql("image"), using=("box",))
def m2(t):
    return D.nms(t.fixture("box")).select("image", "id")


@query("m2_class_aware", nms_sql("image, cls"), using=("box",))
def m2_class_aware(t):
    return D.nms(t.fixture("box"), class_aware=True).select("image", "id")
