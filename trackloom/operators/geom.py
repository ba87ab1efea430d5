"""Boxes: intersection over union, exact union coverage, dilation, clipping. Column expressions throughout.

A box is four columns or a struct x1, y1, x2, y2 in pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COVERED = 0.98
BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def box(*cols: str) -> Column:
    return F.struct(*[F.col(c).cast("double").alias(n) for c, n in zip(cols, ("x1", "y1", "x2", "y2"))])


def iou(a: Column, b: Column) -> Column:
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    inter = w * h
    area = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    union = area(a) + area(b) - inter
    return F.when((w <= 0) | (h <= 0) | (union <= 0), F.lit(0.0)).otherwise(inter / F.nullif(union, F.lit(0.0)))


def covered_sql(b: str, boxes: str) -> str:
    """SQL of the share of box b that the union of an array of boxes covers, exactly.

    Each vertical slab between neighbouring x edges is filled by the union of the y intervals of the boxes that span it,
    found in one sweep over the boxes by y1. A degenerate box counts as covered."""
    clip = f"transform({boxes}, r -> named_struct('y1', greatest(r.y1, {b}.y1), 'y2', least(r.y2, {b}.y2), 'x1', greatest(r.x1, {b}.x1), 'x2', least(r.x2, {b}.x2)))"
    inner = f"array_sort(filter({clip}, r -> r.x2 > r.x1 and r.y2 > r.y1))"
    cuts = "array_sort(array_distinct(flatten(transform(rs, r -> array(r.x1, r.x2)))))"
    filled = (
        "aggregate(filter(rs, r -> r.x1 <= xs[k] and r.x2 >= xs[k + 1]), named_struct('len', 0.0D, 'upto', double('-Infinity')), "
        "(s, r) -> named_struct('len', s.len + greatest(0.0D, r.y2 - greatest(r.y1, s.upto)), 'upto', greatest(s.upto, r.y2)), s -> s.len)"
    )
    slabs = f"aggregate(transform(filter(sequence(0, greatest(size(xs) - 1, 1) - 1), k -> size(xs) > 1), k -> (xs[k + 1] - xs[k]) * {filled}), 0.0D, (a, v) -> a + v)"
    # Lambdas bind the clipped boxes and the cuts, so each is computed once a row.
    body = f"transform(array({inner}), rs -> transform(array({cuts}), xs -> {slabs})[0])[0]"
    area = f"(({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1))"
    return f"case when {b}.x2 <= {b}.x1 or {b}.y2 <= {b}.y1 then 1.0D else {body} / {area} end"


def covered(b: str, boxes: str) -> Column:
    return F.expr(covered_sql(b, f"coalesce({boxes}, cast(array() as array<{BOX}>))"))


def dilate(df: DataFrame, scale: float = 1.3, margin: float = 8.0, width: str = "width", height: str = "height") -> DataFrame:
    """Boxes grown about their centres and clipped to the frame."""
    half_w = ((F.col("x2") - F.col("x1")) * scale + 2 * margin) / 2
    half_h = ((F.col("y2") - F.col("y1")) * scale + 2 * margin) / 2
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    zero = F.lit(0.0)
    new = {
        "x1": F.greatest(zero, cx - half_w), "y1": F.greatest(zero, cy - half_h),
        "x2": F.least(F.col(width).cast("double"), cx + half_w), "y2": F.least(F.col(height).cast("double"), cy + half_h),
    }
    return df.withColumns(new)


def pixel_region(df: DataFrame) -> DataFrame:
    """Sample ranges that a fill box touches: luma from floor to ceiling, chroma at half size."""
    lo = lambda c: F.greatest(F.lit(0), F.floor(c)).cast("int")
    hi = lambda c, m: F.least(F.col(m).cast("long"), F.ceil(c)).cast("int")
    df = df.withColumns({"lx1": lo("x1"), "ly1": lo("y1"), "lx2": hi("x2", "width"), "ly2": hi("y2", "height")})
    half = {c.replace("l", "c"): F.floor(F.col(c) / 2).cast("int") if c.endswith("1") else F.ceil(F.col(c) / 2).cast("int") for c in ("lx1", "ly1", "lx2", "ly2")}
    return df.withColumns(half)


def context_crop(df: DataFrame, scale: float = 3.0, least: float = 160.0) -> DataFrame:
    """Review crop about a box: three times its longer side, 160 pixels at least, inside the frame."""
    side = F.greatest(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) * scale, F.lit(least))
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    return df.withColumns({
        "crop_x1": F.greatest(F.lit(0.0), cx - side / 2), "crop_y1": F.greatest(F.lit(0.0), cy - side / 2),
        "crop_x2": F.least(F.col("width").cast("double"), cx + side / 2), "crop_y2": F.least(F.col("height").cast("double"), cy + side / 2),
    })
