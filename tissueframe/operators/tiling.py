"""Tile plans, halo blocks, seam ownership and per-tile functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.buckets import bucket
from ..session import small


def _axis(length: Column, win: int, overlap: int | float, win_back: bool) -> Column:
    """Array of ``(lo, hi)`` along one axis."""
    if isinstance(overlap, float):
        n = F.floor(length / ((1 - overlap) * win)) + 1
        begin = lambda t: F.rint(t * win - t * overlap * win)
        end = lambda t: F.rint(F.least(begin(t) + win, length.cast("double")))
    else:
        step = win - overlap
        n = F.ceil(length / step)
        if win_back:
            end = lambda t: F.least(t * step + win, length)
            begin = lambda t: F.when(t * step + win > length, F.greatest(F.lit(0), length - win)).otherwise(t * step)
        else:
            begin = lambda t: t * step
            end = lambda t: F.least(t * step + win, length)
    boxes = F.transform(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")), lambda t: F.struct(
        begin(t).cast("long").alias("lo"), end(t).cast("long").alias("hi")))
    return F.filter(boxes, lambda b: b["lo"] < b["hi"])


def tile_plan(images: DataFrame, win: int, overlap: int | float = 0, win_back: bool = False) -> DataFrame:
    """Boxes ``[y0, y1) x [x0, x1)`` covering each image ``(img, h, w)``.

    A whole-number overlap is in pixels, a fractional one a share of the window;
    ``win_back`` slides the last window back inside the image.
    """
    rows = images.withColumn("_y", F.explode(_axis(F.col("h"), win, overlap, win_back)))
    both = rows.withColumn("_x", F.explode(_axis(F.col("w"), win, overlap, win_back)))
    return both.select("img", F.col("_y.lo").alias("y0"), F.col("_y.hi").alias("y1"),
                       F.col("_x.lo").alias("x0"), F.col("_x.hi").alias("x1"))


def tile_plan_padded(images: DataFrame, patch: int = 2000, overlap: int = 48) -> DataFrame:
    """Full-size patches; the last row and column are anchored at the far edge."""
    step = patch - overlap

    def axis(length: Column) -> Column:
        n = F.greatest(F.lit(1), F.floor((length - overlap) / step) + 1).cast("long")
        lo = lambda t: F.when(t == n - 1, F.greatest(F.lit(0), length - patch)).otherwise(t * step)
        return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda t: F.struct(
            lo(t).cast("long").alias("lo"), F.least(length, lo(t) + patch).cast("long").alias("hi")))

    both = images.withColumn("_y", F.explode(axis(F.col("h")))).withColumn("_x", F.explode(axis(F.col("w"))))
    return both.select("img", F.col("_y.lo").alias("y0"), F.col("_y.hi").alias("y1"),
                       F.col("_x.lo").alias("x0"), F.col("_x.hi").alias("x1"))


def halo_blocks(runs: DataFrame, size: int = 2000, halo: int = 100) -> DataFrame:
    """Runs copied to every block whose halo they enter, relative to the padded bounding box.

    Blocks start at the box of all runs widened by ``halo``; ``by, bx`` name them.
    """
    box = small(runs.groupBy("chip").agg((F.min("y") - halo).alias("_oy"), (F.min("x0") - halo).alias("_ox")))
    t = runs.join(box, "chip")
    top, left, right = F.col("y") - F.col("_oy"), F.col("x0") - F.col("_ox"), F.col("x1") - F.col("_ox")
    t = t.withColumn("by", F.explode(F.sequence(F.greatest(F.lit(0), bucket(top - halo, size)), bucket(top + halo, size))))
    t = t.withColumn("bx", F.explode(F.sequence(F.greatest(F.lit(0), bucket(left - halo, size)), bucket(right + halo, size))))
    lo, hi = F.col("_ox") + F.col("bx") * size - halo, F.col("_ox") + F.col("bx") * size + (size - 1 + halo)
    return t.select("chip", "label", "by", "bx", "y", F.greatest("x0", lo).alias("x0"), F.least("x1", hi).alias("x1"))


def own_tile(pixels: DataFrame, overlap: int) -> DataFrame:
    """Pixels of tile results ``(img, y0, y1, x0, x1, h, w, y, x, ...)`` the tile may keep.

    Interior edges give up half of the overlap, image borders nothing.
    """
    half = overlap // 2
    def inside(p, lo, hi, end):
        return ((F.col(p) >= F.col(lo) + F.when(F.col(lo) != 0, half).otherwise(0))
                & (F.col(p) < F.col(hi) - F.when(F.col(hi) != F.col(end), half).otherwise(0)))
    return pixels.where(inside("y", "y0", "y1", "h") & inside("x", "x0", "x1", "w"))


def merge_tiles_or(pixels: DataFrame) -> DataFrame:
    """One value per pixel where tiles overlap: on if any tile says so."""
    return pixels.groupBy("img", "y", "x").agg(F.max("v").alias("v"))


def pixels_in_boxes(pixels: DataFrame, boxes: DataFrame, size: int) -> DataFrame:
    """Every pixel with each box of its image that holds it, by bucketed equi-join.

    Boxes are no larger than ``size`` plus overlap, so they span few buckets.
    """
    b = (boxes.withColumn("_by", F.explode(F.sequence(bucket("y0", size), bucket(F.col("y1") - 1, size))))
         .withColumn("_bx", F.explode(F.sequence(bucket("x0", size), bucket(F.col("x1") - 1, size)))))
    p = pixels.withColumn("_by", bucket("y", size)).withColumn("_bx", bucket("x", size))
    return (p.join(b, ["img", "_by", "_bx"]).where("y >= y0 and y < y1 and x >= x0 and x < x1").drop("_by", "_bx"))


def chip_blocks(points: DataFrame, extent: DataFrame, nh: int, nw: int) -> DataFrame:
    """Block index (column by column) of an equal split; the last block takes the remainder."""
    e = small(extent.select("chip", F.floor(F.col("h") / nh).alias("_ch"), F.floor(F.col("w") / nw).alias("_cw")))
    by = F.least(F.floor(F.col("y") / F.col("_ch")), F.lit(nh - 1))
    bx = F.least(F.floor(F.col("x") / F.col("_cw")), F.lit(nw - 1))
    return points.join(e, "chip").withColumn("block", (bx * nh + by).cast("long")).drop("_ch", "_cw")


def map_tiles(tiles: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
              empty: Column | None = None, on_empty: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a user function over batches of tiles; tiles flagged ``empty`` skip it."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)

    busy = tiles if empty is None else tiles.where(~empty)
    out = busy.mapInPandas(batches, schema)
    if empty is None or on_empty is None:
        return out
    return out.unionByName(on_empty(tiles.where(empty)))
