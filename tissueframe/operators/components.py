"""Connected components of label masks and of point sets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.buckets import bucket, near_join, square_distance
from ..plans.fixpoint import label_components
from ..plans.tiles import TILE, join_tiles, runs_to_tiles
from ..session import cut, deal

#: Raster id of a pixel: row * STRIDE + column + 1, so that 0 stays background.
STRIDE = 1 << 31


def _union(pdf: pd.DataFrame) -> pd.DataFrame:
    """Touching or overlapping runs of a tile's rows made one; sorted by (y, x0)."""
    pdf = pdf.sort_values(["y", "x0"], ignore_index=True)
    y, x0, x1 = (pdf[c].to_numpy() for c in ("y", "x0", "x1"))
    row = y * (x1.max() - x0.min() + 3)  # no run touches one of the next row
    starts, ends = row + x0, row + x1
    reach = np.maximum.accumulate(ends)
    first = np.flatnonzero(np.append(True, starts[1:] > reach[:-1] + 1))
    return pdf.iloc[first].assign(x1=np.maximum.reduceat(ends, first) - row[first])


def _tile_roots(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, reach: int) -> np.ndarray:
    """Index of the first run of each run's component; input sorted by (y, x0)."""
    span = int(x1.max() - x0.min()) + 8
    left, right = x0 - x0.min() + 3, x1 - x0.min() + 3
    starts, ends = y * span + left, y * span + right
    lo = np.searchsorted(ends, (y + 1) * span + left - reach, "left")
    hi = np.searchsorted(starts, (y + 1) * span + right + reach, "right")
    n = np.maximum(hi - lo, 0)
    src = np.repeat(np.arange(len(y)), n)
    dst = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    root = np.arange(len(y))
    while True:
        before = root.copy()
        low = np.minimum(root[src], root[dst])
        np.minimum.at(root, src, low)
        np.minimum.at(root, dst, low)
        root = root[root]
        if np.array_equal(before, root):
            return root


def connected_components(runs: DataFrame, conn: int, size: int = TILE) -> DataFrame:
    """Label the objects of a semantic mask; a label is the raster id of its first pixel.

    Runs are cut at tile borders, then merged and labelled inside each tile (a tile is
    bounded in area) after one shuffle; only pieces on tile borders enter the distributed merge.
    """
    reach = {4: 0, 8: 1}[conn]
    tiles = deal(runs_to_tiles(runs.select("chip", "y", "x0", "x1"), 0, size), "chip", "ty", "tx", share=4)
    tiles = tiles.groupBy("chip", "ty", "tx", "y", "x0").agg(F.max("x1").alias("x1"))  # no more rows than pixels

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _union(pdf)
        y, x0, x1 = (pdf[c].to_numpy() for c in ("y", "x0", "x1"))
        first = _tile_roots(y, x0, x1, reach)
        return pdf.assign(root=y[first] * STRIDE + x0[first] + 1)

    pieces = cut(tiles.groupBy("chip", "ty", "tx").applyInPandas(
        local, "chip long, ty long, tx long, y long, x0 long, x1 long, root long"))
    last = F.lit(size - 1)
    border = pieces.where((F.pmod("y", F.lit(size)).isin(0, size - 1))
                          | (F.pmod("x0", F.lit(size)) == 0) | (F.pmod("x1", F.lit(size)) == last))
    a = (border.withColumn("_xb", F.explode(F.sequence(bucket(F.col("x0") - 1, size),
                                                       bucket(F.col("x1") + 1, size))))
         .withColumn("_dy", F.explode(F.array(F.lit(0), F.lit(1))))
         .select("chip", "_xb", (F.col("y") + F.col("_dy")).alias("_y"), "_dy",
                 F.col("x0").alias("_a0"), F.col("x1").alias("_a1"), F.col("root").alias("_ra")))
    b = border.select("chip", F.col("tx").alias("_xb"), F.col("y").alias("_y"), "x0", "x1", "root")
    below = (F.col("_dy") == 1) & (F.col("x0") <= F.col("_a1") + reach) & (F.col("x1") >= F.col("_a0") - reach)
    beside = (F.col("_dy") == 0) & (F.col("x0") == F.col("_a1") + 1)
    edges = (a.join(b, ["chip", "_xb", "_y"]).where((below | beside) & (F.col("_ra") != F.col("root")))
             .select(F.struct("chip", F.col("_ra").alias("rid")).alias("u"),
                     F.struct("chip", F.col("root").alias("rid")).alias("v")).distinct())
    merged = label_components(edges).select(F.col("node.chip").alias("chip"), F.col("node.rid").alias("root"),
                                            F.col("root.rid").alias("_top"))
    out = pieces.join(merged, ["chip", "root"], "left").select(
        "chip", F.coalesce("_top", "root").alias("label"), "y", "x0", "x1")
    return cut(join_tiles(out, ("chip", "label", "y"), size))


def first_pixel(label: Column) -> tuple[Column, Column]:
    """Row and column of the pixel that gave a component its label."""
    y = F.shiftright(label - 1 + STRIDE // 2, 31)
    return y, label - 1 - y * STRIDE


def point_components(points: DataFrame, max_d: float, keys: tuple[str, ...] = ("chip",)) -> DataFrame:
    """Link points ``(keys, id, x, y)`` closer than ``max_d``; adds ``root``.

    Points at one position are collapsed first, so a pile of copies costs one node.
    """
    spot = points.groupBy(*keys, "x", "y").agg(F.min("id").alias("rep"))
    half = int(np.ceil(max_d))
    pairs = near_join(spot, spot, half, keys).where(
        (square_distance() < float(max_d) ** 2) & (F.col("rep") < F.col("s_rep")))
    labels = label_components(pairs.select(F.col("rep").alias("u"), F.col("s_rep").alias("v")))
    tagged = spot.join(labels, spot["rep"] == labels["node"], "left").select(
        *keys, "x", "y", F.coalesce("root", "rep").alias("root"))
    return points.join(tagged, [*keys, "x", "y"])


def consecutive_labels(labels: DataFrame, keys: tuple[str, ...] = ("chip",), start: int = 1) -> DataFrame:
    """Ordered dense relabelling: ``(keys, label, new_label)`` from a label column.

    Ranks within range-partitioned blocks and adds the number of labels in the
    blocks before, so no task sees all labels of one chip.
    """
    distinct = labels.where("label > 0").select(*keys, "label").distinct()
    ranged = cut(distinct.repartitionByRange(*keys, "label").withColumn("_part", F.spark_partition_id()))
    inside = ranged.withColumn("_rn", F.row_number().over(
        Window.partitionBy("_part", *keys).orderBy("label")))
    sizes = ranged.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (inside.join(before, [*keys, "_part"])
            .select(*keys, "label", (F.col("_rn") + F.col("_before") + (start - 1)).cast("long").alias("new_label")))
