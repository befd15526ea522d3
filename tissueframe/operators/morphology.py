"""Dilation, erosion, outlines, hole filling, expansion and distance bands."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..plans.buckets import overlap_runs
from ..plans.islands import area, merge_runs, subtract
from ..plans.tiles import TILE, group_tiles, map_label_tiles, paint
from ..session import cut, small
from .components import connected_components


def _shift(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """``out[y, x] = a[y + dy, x + dx]`` with zeros outside."""
    out = np.zeros_like(a)
    h, w = a.shape
    out[max(0, -dy):h - max(0, dy), max(0, -dx):w - max(0, dx)] = \
        a[max(0, dy):h - max(0, -dy), max(0, dx):w - max(0, -dx)]
    return out


_CROSS = ((-1, 0), (1, 0), (0, -1), (0, 1))
_RING = tuple((dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) != (0, 0))


def dilate(runs: DataFrame, k: int) -> DataFrame:
    """Square dilation by ``k`` pixels on each side, as label 1 runs.

    Rows are spread in doubling steps, so a wide kernel costs log(k) passes
    instead of 2k + 1 copies of each run.
    """
    flat = merge_runs(runs.select("chip", "y", (F.col("x0") - k).alias("x0"), (F.col("x1") + k).alias("x1")),
                      ("chip", "y"))
    done, total = 0, 2 * k
    flat = flat.withColumn("y", F.col("y") - k)
    while done < total:
        step = min(done + 1, total - done)
        flat = merge_runs(flat.withColumn("y", F.explode(F.array("y", F.col("y") + step))), ("chip", "y"))
        done += step
    return flat.select("chip", F.lit(1).cast("long").alias("label"), "y", "x0", "x1")


def erode(runs: DataFrame, k: int) -> DataFrame:
    """Square erosion by ``k``; pixels outside the mask count as background."""

    def shrink(a: np.ndarray) -> np.ndarray:
        on = a > 0
        for axis in (0, 1):
            keep = on.copy()
            for d in range(1, k + 1):
                for s in (-d, d):
                    keep &= _shift(on, s, 0) if axis == 0 else _shift(on, 0, s)
            on = keep
        return on.astype(np.int64)

    flat = runs.withColumn("label", F.lit(1).cast("long"))
    return map_label_tiles(flat, shrink, 2 * k)


def outline(runs: DataFrame, whole: bool = True) -> DataFrame:
    """Object pixels that miss a 4-neighbour of the same label; unless ``whole``, runs end at tile borders."""

    def edge(a: np.ndarray) -> np.ndarray:
        inner = np.ones(a.shape, dtype=bool)
        for dy, dx in _CROSS:
            inner &= _shift(a, dy, dx) == a
        return np.where(inner, 0, a)

    return map_label_tiles(runs, edge, 1, whole=whole)


def drop_seams(runs: DataFrame, whole: bool = True) -> DataFrame:
    """Remove pixels that have a 4-neighbour of another label; unless ``whole``, runs end at tile borders."""

    def part(a: np.ndarray) -> np.ndarray:
        clash = np.zeros(a.shape, dtype=bool)
        for dy, dx in _CROSS:
            other = _shift(a, dy, dx)
            clash |= (other > 0) & (other != a)
        return np.where(clash, 0, a)

    return map_label_tiles(runs, part, 1, whole=whole)


def _square_distance(on: np.ndarray, r: int) -> np.ndarray:
    """Squared distance to the nearest object pixel, at most ``r * r + 1``.

    Along the rows by the last and the next object pixel, at a cost free of ``r``; then between rows, from near to
    far, until no pixel can come nearer.
    """
    far, at = r * r + 1, np.arange(on.shape[1], dtype=np.int64)
    before = np.maximum.accumulate(np.where(on, at, -r - 1), axis=1)
    after = np.minimum.accumulate(np.where(on, at, len(at) + r)[:, ::-1], axis=1)[:, ::-1]
    side = np.minimum(at - before, after - at)
    flat = np.minimum(side * side, far)
    best = flat.copy()
    for d in range(1, min(r, len(on) - 1) + 1):
        if d * d >= best.max():
            break
        np.minimum(best[d:], flat[:-d] + d * d, out=best[d:])
        np.minimum(best[:-d], flat[d:] + d * d, out=best[:-d])
    return best


def _around(a: np.ndarray, pick, blank: int) -> np.ndarray:
    """``pick`` over the square of three pixels around each, ``blank`` outside."""
    p = np.pad(a, 1, constant_values=blank)
    rows = pick(pick(p[:-2], p[1:-1]), p[2:])
    return pick(pick(rows[:, :-2], rows[:, 1:-1]), rows[:, 2:])


def expand_labels(runs: DataFrame, r: int = 10, conn: int = 8, labelled: bool = False,
                  size: int = TILE) -> DataFrame:
    """Grow each object into the background up to distance ``r``; objects never touch.

    ``r`` synchronous rounds: a background pixel takes the label around it when
    that label is unique; where two labels meet it stays background.  Whatever a
    round decides depends on pixels at most two away, so a halo of ``2 r + 2``
    makes every tile exact and the whole growth costs one shuffle.
    """
    objects = runs if labelled else connected_components(runs, conn)

    def grow(a: np.ndarray) -> np.ndarray:
        allowed = (a == 0) & (_square_distance(a > 0, r) <= r * r)
        names = np.unique(np.append(a, 0))
        a, big = np.searchsorted(names, a).astype(np.int32), len(names)  # in the order of the labels
        for _ in range(r):
            hi = _around(a, np.maximum, 0)
            lo = _around(np.where(a > 0, a, big), np.minimum, big)
            cand = np.where(allowed & (a == 0) & (hi == lo), hi, 0)
            if not cand.any():
                break
            a = np.where((cand > 0) & (_around(np.where(cand > 0, cand, big), np.minimum, big) == cand), cand, a)
        return names[a]

    return cut(map_label_tiles(objects, grow, 2 * r + 2, size))


def distance_band(runs: DataFrame, r: int, size: int = TILE) -> DataFrame:
    """Squared distance to the nearest object pixel, for pixels outside within ``r``.

    Runs are shuffled once, to the tiles they come within ``r`` of; a task holds one tile and its halo.
    """

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        chip, ty, tx = (int(v) for v in key)
        d2 = _square_distance(paint(pdf, ty, tx, r, size) > 0, r)[r:r + size, r:r + size]
        y, x = np.nonzero((d2 > 0) & (d2 <= r * r))
        return pd.DataFrame({"chip": np.full(len(y), chip), "y": y + ty * size, "x": x + tx * size, "d2": d2[y, x]})

    objects = runs.select("chip", F.lit(1).cast("long").alias("label"), "y", "x0", "x1")
    return group_tiles(objects, r, size).applyInPandas(one, "chip long, y long, x long, d2 long")


def instance_to_semantic(pixels: DataFrame, frame: DataFrame | None = None) -> DataFrame:
    """Binarise instance pixels, cutting where diagonal neighbours disagree.

    A pixel survives when its lower-right neighbour has its label and its lower
    and right neighbours agree with each other.  In the last row and column of
    ``frame(chip, h, w)`` there is nothing to compare with and all pixels
    survive; without a frame the plane goes on as background.
    """
    at = lambda dy, dx, role: F.struct(F.lit(role).alias("role"), (F.col("y") - dy).alias("y"),
                                       (F.col("x") - dx).alias("x"))
    sent = pixels.select("chip", "label", F.explode(F.array(
        at(0, 0, "c"), at(1, 1, "d"), at(1, 0, "s"), at(0, 1, "e"))).alias("t"))
    pick = lambda role: F.max(F.when(F.col("t.role") == role, F.col("label"))).alias(role)
    near = sent.groupBy("chip", F.col("t.y").alias("y"), F.col("t.x").alias("x")).agg(*map(pick, "cdse"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    agree = (zero("d") == F.col("c")) & (zero("s") == zero("e"))
    if frame is not None:
        near = near.join(small(frame.select("chip", "h", "w")), "chip")
        agree = agree | (F.col("y") == F.col("h") - 1) | (F.col("x") == F.col("w") - 1)
    return (near.where((F.col("c") > 0) & agree)
            .select("chip", "y", "x", F.lit(1).alias("v")))


def drop_small_objects(runs: DataFrame, min_size: int) -> DataFrame:
    """Keep labels with at least ``min_size`` pixels."""
    big = area(runs).where(F.col("area") >= min_size)
    return runs.join(big.select("chip", "label"), ["chip", "label"], "left_semi")


def fill_holes(runs: DataFrame, max_size: int | None = None) -> DataFrame:
    """Turn enclosed background into foreground (label 1), optionally only small holes."""
    flat = cut(merge_runs(runs.select("chip", "y", "x0", "x1"), ("chip", "y")))
    box = flat.groupBy("chip").agg(F.min("y").alias("_t"), F.max("y").alias("_b"),
                                   F.min("x0").alias("_l"), F.max("x1").alias("_r"))
    rows = box.select("chip", "_t", "_b", "_l", "_r", F.explode(F.sequence(F.col("_t") - 1, F.col("_b") + 1)).alias("y"))
    frame = rows.select("chip", F.lit(1).cast("long").alias("label"), "y",
                        (F.col("_l") - 1).alias("x0"), (F.col("_r") + 1).alias("x1"))
    back = connected_components(subtract(frame, flat), 4)
    edge = box.withColumnRenamed("chip", "_chip")
    outer = back.join(edge, back["chip"] == edge["_chip"]).where("y < _t and x0 < _l")
    holes = back.join(outer.select("chip", "label").distinct(), ["chip", "label"], "left_anti")
    if max_size is not None:
        small_ones = area(holes).where(F.col("area") <= max_size)
        holes = holes.join(small_ones.select("chip", "label"), ["chip", "label"], "left_semi")
    both = flat.unionByName(holes.select("chip", "y", "x0", "x1"))
    return merge_runs(both, ("chip", "y")).select("chip", F.lit(1).cast("long").alias("label"), "y", "x0", "x1")


def best_tissue_mask(tissue: DataFrame, cells: DataFrame, k: int = 200) -> DataFrame:
    """Tissue around cells: intersect, dilate, drop specks, fill, intersect again."""
    shared = overlap_runs(cells, tissue).select("chip", F.lit(1).cast("long").alias("label"), "y", "x0", "x1")
    grown = cut(connected_components(dilate(shared, k // 2), 8))
    kept = drop_small_objects(grown, int(k * k * 2.25))
    filled = fill_holes(kept)
    inside = overlap_runs(filled, merge_runs(tissue.withColumn("label", F.lit(1).cast("long"))))
    return merge_runs(inside.select("chip", F.lit(1).cast("long").alias("label"), "y", "x0", "x1"))
