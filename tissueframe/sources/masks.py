"""Run-length encodings, mask layers and image pyramids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..plans.buckets import bucket
from ..session import small


def rle_encode(runs: DataFrame, extent: DataFrame) -> DataFrame:
    """Runs ``(chip, layer, y, x0, x1)`` to 1-based ``(start, length)`` over flattened pixels.

    Runs that meet across a row border are joined.  Only runs touching the left
    or right image border can do so, at most two per row; all others pass through.
    """
    e = small(extent.select("chip", "width"))
    flat = runs.join(e, "chip").select(
        "chip", "layer", (F.col("y") * F.col("width") + F.col("x0") + 1).alias("start"),
        (F.col("x1") - F.col("x0") + 1).alias("length"),
        ((F.col("x0") == 0) | (F.col("x1") == F.col("width") - 1)).alias("_edge"))
    order = Window.partitionBy("chip", "layer").orderBy("start")
    touch = flat.where("_edge").withColumn("_new", F.when(
        F.lag(F.col("start") + F.col("length")).over(order) == F.col("start"), 0).otherwise(1))
    joined = touch.withColumn("_isl", F.sum("_new").over(order)).groupBy("chip", "layer", "_isl").agg(
        F.min("start").alias("start"), F.sum("length").alias("length")).drop("_isl")
    return flat.where("not _edge").drop("_edge").unionByName(joined)


def rle_decode(rle: DataFrame, extent: DataFrame) -> DataFrame:
    """Flattened runs back to one run per row."""
    e = small(extent.select("chip", "width"))
    lo, hi = F.col("start") - 1, F.col("start") + F.col("length") - 2
    rows = rle.join(e, "chip").withColumn("y", F.explode(F.sequence(
        F.floor(lo / F.col("width")), F.floor(hi / F.col("width")))))
    base = F.col("y") * F.col("width")
    return rows.select("chip", "layer", "y", F.greatest(lo - base, F.lit(0)).alias("x0"),
                       F.least(hi - base, F.col("width") - 1).alias("x1"))


def write_mask_layers(runs: DataFrame, path: str) -> None:
    """Each final layer is its own folder; a large layer is split into several files."""
    runs.hint("rebalance", "layer").write.partitionBy("layer").parquet(path)


def read_mask_layers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_pyramid(pixels: DataFrame, path: str, mags: tuple[int, ...] = (1, 10, 50, 100, 150), tile: int = 256) -> None:
    """Every mag-th pixel of every mag-th row, in tiles of the level, one folder per level."""
    levels = pixels.withColumn("mag", F.explode(F.array(*[F.lit(m) for m in mags]))).where(
        (F.pmod("x", F.col("mag")) == 0) & (F.pmod("y", F.col("mag")) == 0))
    lx, ly = F.floor(F.col("x") / F.col("mag")), F.floor(F.col("y") / F.col("mag"))
    tiled = levels.select("mag", "img", bucket(ly, tile).alias("ty"), bucket(lx, tile).alias("tx"),
                          (ly % tile).cast("int").alias("py"), (lx % tile).cast("int").alias("px"), "v")
    tiled.hint("rebalance", "mag", "img", "ty", "tx").write.partitionBy("mag").parquet(path)


def read_pyramid(spark: SparkSession, path: str, mag: int, tile: int = 256) -> DataFrame:
    """One level as pixels of that level; only its folder is read."""
    raw = spark.read.parquet(path).where(F.col("mag") == mag)
    return raw.select("img", (F.col("ty") * tile + F.col("py")).alias("y"), (F.col("tx") * tile + F.col("px")).alias("x"), "v")
