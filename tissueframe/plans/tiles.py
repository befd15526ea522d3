"""Square tiles with a halo, for operators that look a bounded distance around a pixel.

A tile has a fixed edge, so the rows of one (image, tile) group are bounded by the
tile's area once duplicates are removed, whatever the size of the image.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import deal
from .buckets import bucket

TILE = 512


def runs_to_tiles(runs: DataFrame, halo: int = 0, size: int = TILE) -> DataFrame:
    """Send each run to every tile whose halo it enters, clipped to that halo."""
    t = runs.withColumn("ty", F.explode(F.sequence(bucket(F.col("y") - halo, size),
                                                   bucket(F.col("y") + halo, size))))
    t = t.withColumn("tx", F.explode(F.sequence(bucket(F.col("x0") - halo, size),
                                                bucket(F.col("x1") + halo, size))))
    return (t.withColumn("x0", F.greatest("x0", F.col("tx") * size - halo))
             .withColumn("x1", F.least("x1", F.col("tx") * size + (size - 1 + halo))))


def paint(pdf: pd.DataFrame, ty: int, tx: int, halo: int, size: int = TILE,
          value: str = "label") -> np.ndarray:
    """Runs of one tile as a dense array that includes the halo."""
    edge = size + 2 * halo
    out = np.zeros((edge, edge), dtype=np.int64)
    y = pdf["y"].to_numpy() - (ty * size - halo)
    x0 = pdf["x0"].to_numpy() - (tx * size - halo)
    n = pdf["x1"].to_numpy() - pdf["x0"].to_numpy() + 1
    rows = np.repeat(y, n)
    cols = np.repeat(x0, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    out[rows, cols] = np.repeat(pdf[value].to_numpy(), n)
    return out


def trace(arr: np.ndarray, ty: int, tx: int, halo: int, size: int = TILE) -> pd.DataFrame:
    """The tile's own pixels (halo removed) back as runs of equal value > 0."""
    own = arr[halo:halo + size, halo:halo + size]
    pad = np.zeros((own.shape[0], 1), dtype=own.dtype)
    ext = np.concatenate([pad, own, pad], axis=1)
    change = ext[:, 1:] != ext[:, :-1]
    y0, x0 = np.nonzero(change[:, :-1] & (own > 0))
    y1, x1 = np.nonzero(change[:, 1:] & (own > 0))
    return pd.DataFrame({"label": own[y0, x0], "y": y0 + ty * size,
                         "x0": x0 + tx * size, "x1": x1 + tx * size})


def group_tiles(runs: DataFrame, halo: int, size: int = TILE):
    """Runs grouped by tile; repeated runs go after the shuffle by tile, which serves both.

    The tiles are dealt to a fixed number of tasks: a few megabytes of runs are hours of tile work, and adaptive
    execution would put them together in one task.
    """
    tiles = runs_to_tiles(runs.select("chip", "label", "y", "x0", "x1"), halo, size)
    return deal(tiles, "chip", "ty", "tx", share=4).distinct().groupBy("chip", "ty", "tx")


def tiles_of(at: Column, shifts, size: int = TILE) -> Column:
    """Different tile numbers that a position reaches by any of the shifts."""
    return F.array_distinct(F.array(*[bucket(at + F.lit(s).cast("long"), size) for s in sorted(set(shifts))]))


def paint_pixels(pdf: pd.DataFrame, ty: int, tx: int, halo: int, size: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Values of one tile's pixels ``(y, x, v)`` with the halo around it, and where there is a pixel."""
    edge = size + 2 * halo
    out, have = np.zeros((edge, edge), pdf["v"].to_numpy().dtype), np.zeros((edge, edge), bool)
    y, x = pdf["y"].to_numpy() - (ty * size - halo), pdf["x"].to_numpy() - (tx * size - halo)
    out[y, x], have[y, x] = pdf["v"].to_numpy(), True
    return out, have


def map_label_tiles(runs: DataFrame, fn: Callable[[np.ndarray], np.ndarray], halo: int,
                    size: int = TILE, whole: bool = True) -> DataFrame:
    """Apply an array function of reach ``halo`` to every tile; returns merged runs, or unless ``whole`` those of the tiles."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        chip, ty, tx = (int(v) for v in key)
        done = trace(fn(paint(pdf, ty, tx, halo, size)), ty, tx, halo, size)
        done.insert(0, "chip", chip)
        return done

    out = group_tiles(runs, halo, size).applyInPandas(
        one, "chip long, label long, y long, x0 long, x1 long")
    from .islands import merge_runs
    return merge_runs(out, ("chip", "label", "y")) if whole else out


def join_tiles(pieces: DataFrame, by: tuple[str, ...], size: int = TILE) -> DataFrame:
    """Merged runs of a written table whose runs are merged inside each tile: only those at a tile's left or right border meet others."""
    from .islands import merge_runs

    edge = F.coalesce((F.pmod("x0", F.lit(size)) == 0) | (F.pmod("x1", F.lit(size)) == size - 1), F.lit(True))
    return pieces.where(~edge).select(*by, "x0", "x1").unionByName(merge_runs(pieces.where(edge), by))
