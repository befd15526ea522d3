"""Point transforms as column expressions with literal coefficients."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def _with(df: DataFrame, **cols: Column) -> DataFrame:
    """Replace several columns at once, all computed from the old values."""
    return df.withColumns(cols)


def rebase(df: DataFrame, x_start: int, y_start: int) -> DataFrame:
    return _with(df, x=F.col("x") - x_start, y=F.col("y") - y_start)


def window_filter(df: DataFrame, box: tuple[float, float, float, float], margin: int = 100) -> DataFrame:
    """Points strictly inside ``(x0, y0, x1, y1)`` widened by ``margin``; pushed to the scan."""
    x0, y0, x1, y1 = box
    return df.where((F.col("x") > x0 - margin) & (F.col("x") < x1 + margin)
                    & (F.col("y") > y0 - margin) & (F.col("y") < y1 + margin))


def affine_points(df: DataFrame, shape: tuple[int, int], scale, rotate: float) -> DataFrame:
    """Rotate about the image centre, scale, and re-centre in the transformed frame."""
    h, w = shape
    sx, sy = (scale, scale) if isinstance(scale, (int, float)) else scale
    c, s = math.cos(math.radians(rotate)), math.sin(math.radians(rotate))
    out_w, out_h = abs(sx) * (w * abs(c) + h * abs(s)), abs(sy) * (w * abs(s) + h * abs(c))
    dx, dy = F.col("x") - w / 2, F.col("y") - h / 2
    return _with(df, x=(dx * c - dy * s) * sx + out_w / 2, y=(dx * s + dy * c) * sy + out_h / 2)


def flip_points(df: DataFrame, shape: tuple[int, int], axis: int, k: int = 9) -> DataFrame:
    """Mirror points and their template index; ``axis`` 0 is x, 1 is y."""
    h, w = shape
    if axis == 0:
        return _with(df, x=F.lit(w - 1) - F.col("x"), ix=F.lit(k - 1) - F.col("ix"))
    return _with(df, y=F.lit(h - 1) - F.col("y"), iy=F.lit(k - 1) - F.col("iy"))


def flip_corners(df: DataFrame, shape: tuple[int, int], flip: int) -> DataFrame:
    """Mirror chip corners ``(k, x, y)`` without the minus one and renumber them."""
    h, w = shape
    if flip == 0:
        return _with(df, x=F.lit(w) - F.col("x"), k=F.lit(3) - F.col("k"))
    order = F.element_at(F.array(*[F.lit(i) for i in (1, 0, 3, 2)]), F.col("k").cast("int") + 1)
    return _with(df, y=F.lit(h) - F.col("y"), k=order.cast("long"))


def rot90_points(df: DataFrame, shape: tuple[int, int], n: int, k: int = 9) -> DataFrame:
    """Quarter turns of points with the matching swap of template indices."""
    h, w = shape
    x, y, ix, iy, top = F.col("x"), F.col("y"), F.col("ix"), F.col("iy"), F.lit(k - 1)
    n %= 4
    if n == 0:
        return df
    if n == 1:
        return _with(df, x=F.lit(h) - y, y=x, ix=F.abs(iy - top), iy=ix)
    if n == 2:
        return _with(df, x=F.lit(w) - x, y=F.lit(h) - y, ix=F.abs(iy - top), iy=F.abs(ix - top))
    return _with(df, x=y, y=F.lit(w) - x, ix=iy, iy=F.abs(ix - top))


def rotated_shape(shape: tuple[int, int], angle: float) -> tuple[int, int]:
    h, w = shape
    s, c = abs(math.sin(math.radians(angle))), abs(math.cos(math.radians(angle)))
    return round(w * s + h * c), round(h * s + w * c)


def rotate_about_center(df: DataFrame, angle: float, shape: tuple[int, int],
                        new_shape: tuple[int, int] | None = None) -> DataFrame:
    """Clockwise rotation in image axes, shifted into the new frame."""
    h, w = shape
    new_h, new_w = new_shape or rotated_shape(shape, angle)
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    dx, dy = F.col("x") - w / 2, F.col("y") - h / 2
    return _with(df, x=dx * c + dy * s + (w / 2 + (new_w - w) / 2),
                 y=dy * c - dx * s + (h / 2 + (new_h - h) / 2))


def homography(src, dst) -> list[float]:
    """The eight coefficients that take four source corners to four target corners."""
    rows, rhs = [], []
    for (x, y), (u, v) in zip(src, dst):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        rhs += [u, v]
    return [float(c) for c in np.linalg.solve(np.array(rows, float), np.array(rhs, float))]


def perspective_points(df: DataFrame, src, dst) -> DataFrame:
    a, b, c, d, e, f, g, h = homography(src, dst)
    x, y = F.col("x"), F.col("y")
    den = x * g + y * h + 1.0
    return _with(df, x=(x * a + y * b + c) / den, y=(x * d + y * e + f) / den)


def clip_to_polygon(points: DataFrame, corners: DataFrame) -> DataFrame:
    """Points inside a convex polygon ``corners(chip, k, x, y)``, either winding.

    The polygon becomes one row per chip (four corners), so the points are
    joined once on the chip and tested with half-plane predicates.
    """
    from ..session import small

    ring = corners.groupBy("chip").agg(F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("_ring"))
    joined = points.join(small(ring), "chip")
    size = F.size("_ring")
    side = F.transform(F.sequence(F.lit(1), size), lambda i: (
        (F.element_at("_ring", i % size + 1)["x"] - F.element_at("_ring", i)["x"])
        * (F.col("y") - F.element_at("_ring", i)["y"])
        - (F.element_at("_ring", i % size + 1)["y"] - F.element_at("_ring", i)["y"])
        * (F.col("x") - F.element_at("_ring", i)["x"])))
    return joined.where((F.array_min(side) >= 0) | (F.array_max(side) <= 0)).drop("_ring")


def match_extent(points: DataFrame, own: tuple[int, int], other: tuple[int, int], mode: str) -> DataFrame:
    """Fit points of a frame ``own = (h, w)`` to another frame.

    ``min`` crops to the common size, ``max`` keeps all (padding is implicit in
    sparse rows), ``same`` centres the frame inside the other and crops.
    """
    (h, w), (oh, ow) = own, other
    if mode == "max":
        return points
    if mode == "min":
        return points.where((F.col("x") < min(w, ow)) & (F.col("y") < min(h, oh)))
    if mode != "same":
        raise ValueError("mode is min, max or same")
    moved = _with(points, x=F.col("x") + (ow - w) // 2, y=F.col("y") + (oh - h) // 2)
    return moved.where((F.col("x") >= 0) & (F.col("x") < ow) & (F.col("y") >= 0) & (F.col("y") < oh))


def chip_box_check(corners: DataFrame, ratio_tol: float = 0.05, angle_tol: float = 2.0) -> DataFrame:
    """Availability of a chip box from its side ratios and corner angles.

    Four rows per chip become one row of arrays; sides and angles are array
    expressions over it.
    """
    ring = corners.groupBy("chip").agg(
        F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("_r"),
        F.max("w").alias("w"), F.max("h").alias("h"))
    at = lambda i: F.element_at("_r", i)
    nxt = lambda i: F.element_at("_r", i % 4 + 1)
    idx = F.sequence(F.lit(1), F.lit(4))
    length = F.transform(idx, lambda i: F.hypot(at(i)["x"] - nxt(i)["x"], at(i)["y"] - nxt(i)["y"]))
    slope = F.transform(idx, lambda i: F.degrees(F.when(
        at(i)["x"] == nxt(i)["x"], F.signum(at(i)["y"] - nxt(i)["y"]) * (math.pi / 2)).otherwise(
        F.atan(F.try_divide(at(i)["y"] - nxt(i)["y"], at(i)["x"] - nxt(i)["x"])))))
    base = ring.withColumn("_len", length).withColumn("_ang", slope)
    turn = F.transform(idx, lambda i: F.element_at("_ang", i % 4 + 1) - F.element_at("_ang", i))
    off = F.transform(turn, lambda d: F.abs(90 - F.when(d < 0, d + 180).otherwise(d)))
    hi, lo = F.array_max("_len") / F.array_min("_len"), F.array_min("_len") / F.array_max("_len")
    want_hi, want_lo = F.greatest("w", "h") / F.least("w", "h"), F.least("w", "h") / F.greatest("w", "h")
    return (base.withColumn("max_ratio", hi).withColumn("max_angle", F.array_max(off))
            .select("chip", "max_ratio", "max_angle",
                    ((F.abs(hi - want_hi) <= ratio_tol) & (F.abs(lo - want_lo) <= ratio_tol)
                     & (F.col("max_angle") <= angle_tol)).alias("available")))
