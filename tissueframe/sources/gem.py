"""Point tables: GEM text, transcript tables, the tiled Parquet store and profiles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.buckets import bucket

#: Tile edge of the store in pixels.
TILE = 2000


def read_gem(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Tab-separated points (plain or gzip) to ``(expression, chip_meta)``.

    Folders ``chip=...`` give the chip, otherwise it is 0.  The count column is
    the first title containing ``ount``; ``#key=value`` lines carry the start
    coordinates and the bin size.
    """
    if not re.search(r"\.(gz|gem)/?$", path):
        raise ValueError(f"not a GEM path (.gem or .gz): {path}")
    lines = spark.read.text(path)
    if "chip" not in lines.columns:
        lines = lines.withColumn("chip", F.lit(0).cast("long"))
    title = lines.where(~F.col("value").startswith("#")).limit(1).first()
    if title is None:
        raise ValueError(f"no rows in {path}")
    names = title["value"].split("\t")
    count = next((n for n in names if "ount" in n), None)
    if count is None:
        raise ValueError("no count column in " + ", ".join(names))
    schema = ", ".join(f"`{n}` {'bigint' if n in ('x', 'y', count) else 'string'}" for n in names)
    raw = spark.read.csv(path, sep="\t", header=True, comment="#", schema=schema)
    chip = F.col("chip").cast("long") if "chip" in raw.columns else F.lit(0).cast("long")
    expression = raw.select(chip.alias("chip"), F.col("geneID").alias("gene"), "x", "y", F.col(count).alias("mid"))
    note = (lines.where(F.col("value").startswith("#"))
            .select(F.col("chip").cast("long").alias("chip"), F.regexp_extract("value", r"^#\s*([^=]+)=(.*)$", 1).alias("k"),
                    F.regexp_extract("value", r"^#\s*([^=]+)=(.*)$", 2).alias("v")))
    pick = lambda pattern: F.max(F.when(F.lower("k").rlike(pattern), F.regexp_extract("v", r"-?\d+", 0).cast("long")))
    bin_size = pick(r"^bin(size|_size|x)?$")
    meta = note.groupBy("chip").agg(
        F.coalesce(pick(r"(x_?start|offset_?x)$"), F.lit(0)).alias("x_start"),
        F.coalesce(pick(r"(y_?start|offset_?y)$"), F.lit(0)).alias("y_start"),
        F.when(F.coalesce(bin_size, F.lit(0)) == 0, 1).otherwise(bin_size).alias("binx"))
    return expression, meta


def write_gem(expression: DataFrame, path: str, x_start: int = 0, y_start: int = 0) -> None:
    """One folder of GEM parts per chip, with a part that holds the ``#`` lines."""
    rows = expression.select("chip", F.col("gene").alias("geneID"), "x", "y", F.col("mid").alias("MIDCount"))
    rows.hint("rebalance", "chip").write.partitionBy("chip").csv(path, sep="\t", header=True)
    notes = expression.select("chip").distinct().select("chip", F.explode(F.array(
        F.lit(f"#x_start={x_start}"), F.lit(f"#y_start={y_start}"))).alias("value"))
    notes.write.mode("append").partitionBy("chip").text(path)


def transcripts_to_expression(df: DataFrame, pixel: float = 0.2125) -> DataFrame:
    """Micron positions to pixels, rounded half to even, one count per transcript."""
    at = lambda c: F.rint(F.col(c) / pixel).cast("long")
    return df.select(F.col("feature_name").alias("gene"), at("x_location").alias("x"), at("y_location").alias("y"),
                     F.lit(1).cast("long").alias("mid"))


def write_expression(expression: DataFrame, path: str, resolution: int = 500, pitch: int = 500, tile: int = TILE) -> None:
    """Points in tile folders plus one metadata row per chip; hot tiles are split into several files."""
    binx = max(1, resolution // pitch if pitch else resolution // 500)
    tiled = expression.withColumns({"tile_y": bucket("y", tile), "tile_x": bucket("x", tile)})
    (tiled.hint("rebalance", "chip", "tile_y", "tile_x").write.partitionBy("chip", "tile_y", "tile_x").parquet(f"{path}/points"))
    chip_bounds(expression, binx).write.parquet(f"{path}/chip_meta")


def read_expression(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Points and metadata of a store; an empty store is an error."""
    meta = spark.read.parquet(f"{path}/chip_meta")
    if meta.isEmpty():
        raise ValueError(f"empty expression store: {path}")
    points = spark.read.parquet(f"{path}/points").withColumn("chip", F.col("chip").cast("long"))
    return points, meta


def chip_bounds(expression: DataFrame, binx: int = 1) -> DataFrame:
    """Bin factor, origin and size per chip."""
    return expression.groupBy("chip").agg(
        F.lit(binx).cast("long").alias("binx"), F.min("x").alias("min_x"), F.min("y").alias("min_y"),
        (F.max("x") - F.min("x") + 1).alias("width"), (F.max("y") - F.min("y") + 1).alias("height"))


def write_profile(assigned: DataFrame, path: str, tile: int = TILE) -> None:
    """Tab-separated points with their cell, in tile folders."""
    rows = assigned.select("chip", F.col("gene").alias("geneID"), "x", "y", F.col("mid").alias("MIDCount"),
                           F.col("cell_id").alias("CellID"), bucket("y", tile).alias("tile_y"), bucket("x", tile).alias("tile_x"))
    rows.hint("rebalance", "chip", "tile_y", "tile_x").write.partitionBy("chip", "tile_y", "tile_x").csv(path, sep="\t", header=True)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=True, schema="geneID string, x bigint, y bigint, MIDCount bigint, CellID bigint, "
                                                             "chip bigint, tile_y bigint, tile_x bigint")
    return raw.select("chip", F.col("geneID").alias("gene"), "x", "y", F.col("MIDCount").alias("mid"), F.col("CellID").alias("cell_id"))


def write_multires(expression: DataFrame, path: str, bins: tuple[int, ...] = (1, 10, 20, 50, 100, 200, 500)) -> None:
    """One pre-aggregated level per bin size, each built from the coarsest finer level that divides it."""
    spark = expression.sparkSession
    for i, size in enumerate(sorted(bins)):
        finer = [b for b in sorted(bins)[:i] if size % b == 0]
        if finer:
            src, step = spark.read.parquet(f"{path}/bin={finer[-1]}"), size // finer[-1]
        else:
            src, step = expression.select("chip", "gene", F.col("x").alias("bx"), F.col("y").alias("by"), "mid"), size
        (src.groupBy("chip", "gene", bucket("bx", step).alias("bx"), bucket("by", step).alias("by"))
         .agg(F.sum("mid").cast("long").alias("mid")).write.parquet(f"{path}/bin={size}"))


def read_multires(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)
