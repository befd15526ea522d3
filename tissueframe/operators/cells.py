"""Points to cells, per-cell tables and the statistics drawn from them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.buckets import bucket, near_join, points_in_runs
from ..plans.islands import area
from ..plans.quantiles import medians, percentiles
from ..plans.tiles import TILE
from ..session import cut, small, spread
from .masks import centroids


def assign_cells(expression: DataFrame, runs: DataFrame) -> DataFrame:
    """Adds ``cell_id``: the label under each point, 0 outside."""
    return (points_in_runs(expression, runs.select("chip", "label", "y", "x0", "x1"), "left")
            .withColumn("cell_id", F.coalesce("label", F.lit(0)).cast("long")).drop("label"))


def points_in_tissue(expression: DataFrame, tissue: DataFrame) -> DataFrame:
    """The points that lie in tissue."""
    return points_in_runs(expression, tissue, "left_semi")


def tissue_cut(expression: DataFrame, tissue: DataFrame, bin_size: int = 1) -> DataFrame:
    """Counts inside tissue per gene and bin."""
    return bin_gene_matrix(points_in_tissue(expression, tissue), bin_size)


def saturate(total: Column, bits: int) -> Column:
    """Counts stop at the largest value of an unsigned integer."""
    return F.least(total.cast("long"), F.lit(2 ** bits - 1).cast("long"))


def dnb_heatmap(expression: DataFrame, bits: int = 8) -> DataFrame:
    """Sum over genes per spot, saturated once at the end."""
    return expression.groupBy("chip", "x", "y").agg(saturate(F.sum("mid"), bits).alias("mid"))


def bin_heatmap(expression: DataFrame, size: int) -> DataFrame:
    """Sums per square bin with bin indices ``bx, by``."""
    return (expression.groupBy("chip", bucket("x", size).alias("bx"), bucket("y", size).alias("by"))
            .agg(F.sum("mid").cast("long").alias("mid")))


def bin_gene_matrix(expression: DataFrame, size: int) -> DataFrame:
    """Sums per bin and gene."""
    return (expression.groupBy("chip", "gene", bucket("x", size).alias("bx"), bucket("y", size).alias("by"))
            .agg(F.sum("mid").cast("long").alias("mid")))


def cell_gene_matrix(assigned: DataFrame) -> DataFrame:
    """Sums per cell and gene, background excluded."""
    return (assigned.where("cell_id > 0").groupBy("chip", "cell_id", "gene")
            .agg(F.sum("mid").cast("long").alias("mid")))


def cell_obs(assigned: DataFrame, runs: DataFrame) -> DataFrame:
    """Per cell: counts, genes, spots, area and centroid; empty cells have zeros.

    Distinct genes and spots come from two pre-aggregations, so a crowded cell
    never gathers its points in one task.
    """
    inside = assigned.where("cell_id > 0")
    genes = (inside.groupBy("chip", "cell_id", "gene").agg(F.sum("mid").alias("mid"))
             .groupBy("chip", "cell_id").agg(F.sum("mid").cast("long").alias("mid"), F.count("*").alias("n_gene")))
    spots = (inside.groupBy("chip", "cell_id", "x", "y").agg(F.count("*").alias("n"))
             .groupBy("chip", "cell_id").agg(F.count("*").alias("n_dnb")))
    shape = centroids(runs).withColumnRenamed("label", "cell_id")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (shape.join(genes, ["chip", "cell_id"], "left").join(spots, ["chip", "cell_id"], "left")
            .select("chip", "cell_id", "area", "cx", "cy", zero("mid"), zero("n_gene"), zero("n_dnb")))


def cell_summary(obs: DataFrame) -> DataFrame:
    """Cells per chip with truncated means and medians."""
    names = ("area", "n_gene", "mid")
    obs = cut(obs.select("chip", *names))
    mean = obs.groupBy("chip").agg(F.count("*").alias("n_cells"), *[F.avg(c).cast("long").alias(f"mean_{c}") for c in names])
    middle = medians(obs, ("chip",), names).select("chip", *[F.col(c).cast("long").alias(f"median_{c}") for c in names])
    pairs = [f"{kind}_{c}" for c in names for kind in ("mean", "median")]
    return mean.join(middle, "chip").select("chip", "n_cells", *pairs)


def fraction_rich_cells(obs: DataFrame, genes: int = 200) -> DataFrame:
    """Share of cells with more than ``genes`` genes, also as percent text."""
    share = F.avg((F.col("n_gene") > genes).cast("double"))
    return obs.groupBy("chip").agg(share.alias("fraction")).withColumn(
        "percent", F.format_string("%.1f%%", F.col("fraction") * 100))


def cell_to_tissue_ratio(assigned: DataFrame, tissue_expr: DataFrame) -> DataFrame:
    """Counts in cells over counts in tissue (or raw counts where no tissue is known)."""
    cell = assigned.where("cell_id > 0").groupBy("chip").agg(F.sum("mid").cast("long").alias("cell_mid"))
    tissue = tissue_expr.groupBy("chip").agg(F.sum("mid").cast("long").alias("tissue_mid"))
    raw = assigned.groupBy("chip").agg(F.sum("mid").cast("long").alias("raw_mid"))
    base = F.coalesce("tissue_mid", "raw_mid")
    return (raw.join(cell, "chip", "left").join(tissue, "chip", "left")
            .select("chip", F.coalesce("cell_mid", F.lit(0)).alias("cell_mid"), base.alias("base_mid"),
                    (F.coalesce("cell_mid", F.lit(0)) / base).alias("ratio")))


def five_number(obs: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Minimum, quartiles, maximum (rounded to 3) and the rows left for plotting."""
    long = cut(obs).unpivot(["chip"], [F.col(c).cast("double").alias(c) for c in cols], "name", "value")
    quart = percentiles(long, ("chip", "name"), "value", (0.0, 0.25, 0.5, 0.75, 1.0)).select(
        "chip", "name", F.col("q")[0].alias("min"), F.slice("q", 2, 3).alias("q"), F.col("q")[4].alias("max"))
    fence = small(quart.withColumn("fence", F.col("q")[2] + 2 * (F.col("q")[2] - F.col("q")[0])))
    kept = (long.join(fence.select("chip", "name", "fence"), ["chip", "name"])
            .groupBy("chip", "name").agg(F.sum((F.col("value") <= F.col("fence")).cast("long")).alias("plotted")))
    return fence.join(kept, ["chip", "name"]).select(
        "chip", "name", F.round("min", 3).alias("min"), F.round(F.col("q")[0], 3).alias("q1"),
        F.round(F.col("q")[1], 3).alias("median"), F.round(F.col("q")[2], 3).alias("q3"),
        F.round("max", 3).alias("max"), "plotted")


def cell_density(obs: DataFrame, r: int = 200) -> DataFrame:
    """Other cells within distance ``r`` of each integer position ``(chip, cell_id, x, y)``.

    Positions are sent to the tiles within reach, at most nine.  A tile sums its rows up once and reads off each row the
    cells between two columns for all its positions at a time.  No pairs are formed, and a pile of cells is one position.
    """
    size = max(TILE, r)
    sites = obs.groupBy("chip", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).agg(F.count("*").alias("n"))
    near = lambda c: F.explode(F.sequence(bucket(F.col(c) - r, size), bucket(F.col(c) + r, size)))
    tiles = sites.withColumn("ty", near("y")).withColumn("tx", near("x"))
    span = np.floor(np.sqrt(r * r - np.arange(-r, r + 1) ** 2)).astype(int)

    def count(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, ty, tx = map(int, key)
        y, x = part["y"].to_numpy() - (ty * size - r), part["x"].to_numpy() - (tx * size - r)
        upto = np.zeros((size + 2 * r, size + 2 * r + 1), np.int64)
        upto[y, x + 1] = part["n"].to_numpy()
        np.cumsum(upto, axis=1, out=upto)
        own = (y >= r) & (y < r + size) & (x >= r) & (x < r + size)
        y, x, total = y[own], x[own], np.full(int(own.sum()), -1)
        for dy, wide in zip(range(-r, r + 1), span):
            total += upto[y + dy, x + wide + 1] - upto[y + dy, x - wide]
        return part.loc[own, ["chip", "x", "y"]].assign(density=total)

    found = tiles.groupBy("chip", "ty", "tx").applyInPandas(count, "chip long, x long, y long, density long")
    return obs.join(found, ["chip", "x", "y"]).select("chip", "cell_id", "density")


def background_candidates(assigned: DataFrame, cells: DataFrame, r: int = 50) -> DataFrame:
    """Background points strictly inside the box of half-width ``r`` around a cell centre."""
    spots = cells.select("chip", "cell_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    near = near_join(assigned.where("cell_id = 0").drop("cell_id"), spots, r, ("chip",))
    inside = (F.abs(F.col("x") - F.col("s_x")) < r) & (F.abs(F.col("y") - F.col("s_y")) < r)
    return near.where(inside).select("chip", F.col("s_cell_id").alias("cell_id"), "gene", "x", "y", "mid")


def dedupe_first(df: DataFrame, keys: tuple[str, ...], order: str = "cell_id") -> DataFrame:
    """One row per key: the smallest ``order``; combined before the shuffle."""
    return df.groupBy(*keys).agg(F.min(order).alias(order))


def filter_cells_by_list(cell_gene: DataFrame, flags: DataFrame) -> DataFrame:
    """Rows of cells whose ``flag`` is 0."""
    return cell_gene.join(spread(flags.where("flag = 0").select("chip", "cell_id")), ["chip", "cell_id"], "left_semi")


def mad_outliers(obs: DataFrame, keep_border: bool = False, cells_per_region: int = 5000) -> DataFrame:
    """Flag cells far above the median of their region in area (3 MAD) or counts (3.5 MAD).

    Regions are open intervals of an n x n grid; cells on a grid line belong to
    none and leave the result unless ``keep_border``.
    """
    obs = cut(obs)
    grid = small(obs.groupBy("chip").agg(
        (F.floor(F.count("*") / cells_per_region) + 1).alias("_n"), F.max("cx").alias("_mx"), F.max("cy").alias("_my")))
    def region(c, m):
        step = F.col(m) / F.col("_n")
        k = F.floor(F.col(c) / step)
        return F.when((F.col(c) > k * step) & (F.col(c) < (k + 1) * step) & (k < F.col("_n")), k).cast("long")
    tagged = (obs.join(grid, "chip").withColumn("rx", region("cx", "_mx")).withColumn("ry", region("cy", "_my")))
    inner = tagged.where("rx is not null and ry is not null")
    med = small(inner.groupBy("chip", "rx", "ry").agg(
        F.percentile("area", F.lit(0.5)).alias("_ma"), F.percentile("mid", F.lit(0.5)).alias("_mm")))
    mad = small(inner.join(med, ["chip", "rx", "ry"]).groupBy("chip", "rx", "ry").agg(
        F.percentile(F.abs(F.col("area") - F.col("_ma")), F.lit(0.5)).alias("_da"),
        F.percentile(F.abs(F.col("mid") - F.col("_mm")), F.lit(0.5)).alias("_dm")))
    how = "left" if keep_border else "inner"
    base = tagged if keep_border else inner
    big_area = F.col("area") > F.col("_ma") + 3 * F.col("_da")
    big_mid = F.col("mid") > F.col("_mm") + 3.5 * F.col("_dm")
    bit = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return (base.join(med, ["chip", "rx", "ry"], how).join(mad, ["chip", "rx", "ry"], how)
            .select("chip", "cell_id", bit(big_area).alias("by_area"), bit(big_mid).alias("by_mid"))
            .withColumn("flag", F.greatest("by_area", "by_mid")))


def object_trace(runs: DataFrame, frame: DataFrame | None = None) -> DataFrame:
    """Bounding box height, width and area per object; ``frame(chip, h, w)`` drops full-image ones."""
    trace = runs.groupBy("chip", "label").agg(
        (F.max("y") - F.min("y") + 1).alias("h"), (F.max("x1") - F.min("x0") + 1).alias("w"),
        F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("area"))
    if frame is None:
        return trace
    full = small(frame.select("chip", F.col("h").alias("_h"), F.col("w").alias("_w")))
    return trace.join(full, "chip").where("not (h = _h and w = _w)").drop("_h", "_w")


def trace_exceed(trace: DataFrame, area_limit: int = 1600, side: int = 40) -> DataFrame:
    share = lambda c, lim: F.avg((F.col(c) > lim).cast("double"))
    return trace.groupBy("chip").agg(share("area", area_limit).alias("area_share"),
                                     share("h", side).alias("height_share"), share("w", side).alias("width_share"))


def mask_size_estimate(runs: DataFrame, factor: float = 1.5) -> DataFrame:
    """Objects larger than ``factor`` times the mean object of their chip."""
    sizes = area(runs)
    mean = small(sizes.groupBy("chip").agg((F.avg("area") * factor).alias("limit")))
    return sizes.join(mean, "chip").where(F.col("area") > F.col("limit"))


def highly_variable(cell_gene: DataFrame, min_counts: int = 100, min_genes: int = 10, max_genes: int = 2500,
                    mt_prefix: str = "MT-", max_mt: float = 0.05, n_bins: int = 20, lo: float = 0.0125,
                    hi: float = 3.0, min_disp: float = 0.5, top: int = 5000) -> DataFrame:
    """Highly variable genes by normalised dispersion.

    Cells pass a count, gene-number and mitochondrial filter; counts are scaled
    to the median cell total and log1p'ed.  Dispersion is variance over mean,
    z-scored within ``n_bins`` equal-frequency bins of the mean.  All per chip.
    """
    mt = F.col("gene").startswith(mt_prefix)
    cells = cell_gene.groupBy("chip", "cell_id").agg(
        F.sum("mid").cast("long").alias("total"), F.count("*").alias("genes"),
        F.coalesce(F.sum(F.when(mt, F.col("mid"))), F.lit(0)).alias("mt"))
    good = cut(cells).where((F.col("total") >= min_counts) & F.col("genes").between(min_genes, max_genes)
                       & (F.col("mt") / F.col("total") < max_mt))
    scale = small(percentiles(good, ("chip",), "total", (0.5,)).select("chip", F.col("q")[0].alias("_med"), F.col("n").alias("_n")))
    norm = (cell_gene.join(good.select("chip", "cell_id", "total"), ["chip", "cell_id"]).join(scale, "chip")
            .withColumn("_v", F.log1p(F.col("mid") * F.col("_med") / F.col("total"))))
    # absent entries are zeros: moments use the number of cells, not of rows
    gene = norm.groupBy("chip", "gene").agg(F.sum("_v").alias("_s"), F.sum(F.col("_v") * F.col("_v")).alias("_ss"),
                                            F.first("_n").alias("_n"))
    mean = F.col("_s") / F.col("_n")
    var = (F.col("_ss") - F.col("_n") * mean * mean) / (F.col("_n") - 1)
    stats = (gene.where("_n > 1").select("chip", "gene", mean.alias("mean"), var.alias("_var")).where("mean > 0")
             .withColumn("disp", F.col("_var") / F.col("mean")))
    binned = stats.withColumn("bin", F.ntile(n_bins).over(Window.partitionBy("chip").orderBy("mean", "gene")))
    moments = binned.groupBy("chip", "bin").agg(F.avg("disp").alias("_m"), F.stddev_samp("disp").alias("_sd"))
    z = (binned.join(moments, ["chip", "bin"])
         .withColumn("norm_disp", F.when(F.col("_sd") > 0, (F.col("disp") - F.col("_m")) / F.col("_sd")).otherwise(1.0)))
    ranked = z.where((F.col("mean") > lo) & (F.col("mean") < hi) & (F.col("norm_disp") >= min_disp)).withColumn(
        "rank", F.row_number().over(Window.partitionBy("chip").orderBy(F.desc("norm_disp"), "gene")))
    return ranked.where(F.col("rank") <= top).select("chip", "gene", "mean", "disp", "norm_disp", "rank")
