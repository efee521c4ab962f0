"""Arithmetic on box columns. Boxes are (x1, y1, x2, y2) unless a name says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names by 0-based index.
CLASS_NAMES = (
    "person", "bicycle", "car", "motorcycle", "airplane", "bus", "train", "truck", "boat", "traffic light",
    "fire hydrant", "stop sign", "parking meter", "bench", "bird", "cat", "dog", "horse", "sheep", "cow",
    "elephant", "bear", "zebra", "giraffe", "backpack", "umbrella", "handbag", "tie", "suitcase", "frisbee",
    "skis", "snowboard", "sports ball", "kite", "baseball bat", "baseball glove", "skateboard", "surfboard",
    "tennis racket", "bottle", "wine glass", "cup", "fork", "knife", "spoon", "bowl", "banana", "apple",
    "sandwich", "orange", "broccoli", "carrot", "hot dog", "pizza", "donut", "cake", "chair", "couch",
    "potted plant", "bed", "dining table", "toilet", "tv", "laptop", "mouse", "remote", "keyboard", "cell phone",
    "microwave", "oven", "toaster", "sink", "refrigerator", "book", "clock", "vase", "scissors", "teddy bear",
    "hair drier", "toothbrush",
)

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", suffix: str = "") -> Box:
    """The four columns x1, y1, x2, y2 with an optional prefix or suffix."""
    return tuple(F.col(f"{prefix}{c}{suffix}") for c in ("x1", "y1", "x2", "y2"))


def cxcywh_to_xyxy(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def xyxy_to_xywh(b: Box) -> Box:
    x1, y1, x2, y2 = b
    return x1, y1, x2 - x1, y2 - y1


def xyxy_to_cxcywh(b: Box) -> Box:
    x, y, w, h = xyxy_to_xywh(b)
    return x + w * 0.5, y + h * 0.5, w, h


def _clip(value: Column, high: Column | float) -> Column:
    top = high if isinstance(high, Column) else F.lit(float(high))
    return F.greatest(F.lit(0.0), F.least(top, value))


def rescale_clip(b: Box, ratio: float, pad_w: float, pad_h: float, width: float, height: float) -> Box:
    """Scale and pad, then clip to the image."""
    x1, y1, x2, y2 = b
    return (_clip(x1 * ratio + pad_w, width), _clip(y1 * ratio + pad_h, height),
            _clip(x2 * ratio + pad_w, width), _clip(y2 * ratio + pad_h, height))


def unscale(b: Box, ratio: float) -> Box:
    """Back to source pixels."""
    return tuple(c / ratio for c in b)


def mirror_box(b: Box, width: Column | float) -> Box:
    """Flip left to right."""
    x1, y1, x2, y2 = b
    w = width if isinstance(width, Column) else F.lit(float(width))
    return w - x2, y1, w - x1, y2


def affine_box(b: Box, matrix: Sequence[Sequence[float]], width: float, height: float) -> Box:
    """Bounding box of the four transformed corners, clipped to the target."""
    x1, y1, x2, y2 = b
    (a, c, e), (d, f, g) = matrix[0], matrix[1]
    corners = [(x1, y1), (x2, y2), (x1, y2), (x2, y1)]
    xs = [x * a + y * c + e for x, y in corners]
    ys = [x * d + y * f + g for x, y in corners]
    return (_clip(F.least(*xs), width), _clip(F.least(*ys), height),
            _clip(F.greatest(*xs), width), _clip(F.greatest(*ys), height))


def decode_anchor(dx: Column, dy: Column, lw: Column, lh: Column, gx: Column, gy: Column, stride: Column) -> Box:
    """Raw prediction of a grid cell to centre, width and height in pixels."""
    return (dx + gx) * stride, (dy + gy) * stride, F.exp(lw) * stride, F.exp(lh) * stride


def anchor_grid(height: int, width: int, p6: bool = False) -> Column:
    """All (stride, gx, gy) cells of an input size in prediction order, as an array to explode."""
    strides = F.array(*[F.lit(s) for s in ((8, 16, 32, 64) if p6 else (8, 16, 32))])
    # the cell number is split into row and column, one explode per anchor list
    return F.flatten(F.transform(strides, lambda s: F.transform(
        F.sequence(F.lit(0), (F.floor(F.lit(height) / s) * F.floor(F.lit(width) / s) - 1).cast("int")),
        lambda i: F.struct(
            s.alias("stride"),
            F.pmod(i, F.floor(F.lit(width) / s).cast("int")).alias("gx"),
            F.floor(i / F.floor(F.lit(width) / s)).cast("int").alias("gy")))))


def area(b: Box, offset: float = 0.0) -> Column:
    x1, y1, x2, y2 = b
    return (x2 - x1 + offset) * (y2 - y1 + offset)


def intersection(a: Box, b: Box, offset: float = 0.0) -> Column:
    """Shared area, 0 when disjoint."""
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a[2], b[2]) - F.greatest(a[0], b[0]) + offset)
    h = F.greatest(zero, F.least(a[3], b[3]) - F.greatest(a[1], b[1]) + offset)
    return w * h


def iou(a: Box, b: Box, offset: float = 0.0) -> Column:
    """Intersection over union; ``offset`` 1 counts pixel borders as suppression does."""
    inter = intersection(a, b, offset)
    union = area(a, offset) + area(b, offset) - inter
    return F.when(inter > 0, inter / union).otherwise(F.lit(0.0))


def class_name(index: Column) -> Column:
    """Name of a 0-based class index, NULL outside the list."""
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return F.when(index >= 0, F.try_element_at(names, (index + 1).cast("int")))


def class_label(name: Column, score: Column) -> Column:
    """``name:87.3%``; rounds the exact binary value, which format_string does not."""
    return F.concat(name, F.lit(":"), F.translate(F.format_number(score * 100, 1), ",", ""), F.lit("%"))
