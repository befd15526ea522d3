"""Cell tables, cell blocks, borders and label exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import small


def write_cells(cell: DataFrame, cell_gene: DataFrame, path: str, table: str | None = None, buckets: int = 64) -> None:
    """Cell table and cell x gene table, laid out by cell.

    With a ``table`` prefix both are saved as bucketed tables, so that joins on
    the cell need no shuffle.
    """
    for name, df in (("cell", cell), ("cell_gene", cell_gene)):
        if table:
            (df.write.bucketBy(buckets, "cell_id").sortBy("cell_id").option("path", f"{path}/{name}")
             .saveAsTable(f"{table}_{name}"))
        else:
            df.hint("rebalance", "chip", "cell_id").sortWithinPartitions("chip", "cell_id").write.parquet(f"{path}/{name}")


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/cell"), spark.read.parquet(f"{path}/cell_gene")


def block_grid(cells: DataFrame, target: int = 5000) -> DataFrame:
    """Chunk grid per chip: halve the longer side to near-square, then quarter until chunks are small."""
    box = cells.groupBy("chip").agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.min("y").alias("y0"),
                                    F.max("x").alias("x1"), F.max("y").alias("y1"))
    w = F.greatest(F.col("x1") - F.col("x0"), F.lit(1)).cast("double")
    h = F.greatest(F.col("y1") - F.col("y0"), F.lit(1)).cast("double")
    short, long_ = F.least("w", "h"), F.greatest("w", "h")
    steps = F.sequence(F.lit(0), F.lit(40))
    box = box.withColumns({"w": w, "h": h})
    pre = F.array_min(F.filter(steps, lambda i: long_ / F.pow(F.lit(2.0), i) <= short * 1.415))
    box = box.withColumn("pre", pre)
    depth = F.array_min(F.filter(steps, lambda d: F.floor(
        F.col("n") / (F.pow(F.lit(2.0), F.col("pre")) * F.pow(F.lit(4.0), d))) <= target))
    box = box.withColumn("depth", depth)
    fine, coarse = F.pow(F.lit(2.0), F.col("depth")), F.pow(F.lit(2.0), F.col("pre") + F.col("depth"))
    wide = F.col("w") > F.col("h")
    return box.select("chip", "x0", "y0", "w", "h", F.when(wide, coarse).otherwise(fine).cast("long").alias("gx"),
                      F.when(wide, fine).otherwise(coarse).cast("long").alias("gy"))


def assign_blocks(cells: DataFrame, target: int = 5000) -> tuple[DataFrame, DataFrame]:
    """Cells with their chunk, and the chunks of the grid that stay empty."""
    grid = small(block_grid(cells, target))
    cx = F.least(F.floor((F.col("x") - F.col("x0")) / (F.col("w") / F.col("gx"))), F.col("gx") - 1)
    cy = F.least(F.floor((F.col("y") - F.col("y0")) / (F.col("h") / F.col("gy"))), F.col("gy") - 1)
    placed = cells.join(grid, "chip").withColumns({"chunk_x": cx.cast("long"), "chunk_y": cy.cast("long")}).drop(
        "x0", "y0", "w", "h", "gx", "gy")
    every = (grid.withColumn("chunk_x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gx") - 1)))
             .withColumn("chunk_y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gy") - 1)))
             .select("chip", "chunk_x", "chunk_y"))
    empty = every.join(placed.select("chip", "chunk_x", "chunk_y").distinct(), ["chip", "chunk_x", "chunk_y"], "left_anti")
    return placed, empty


def write_cell_blocks(cells: DataFrame, path: str, target: int = 5000) -> None:
    placed, empty = assign_blocks(cells, target)
    keys = ("chip", "chunk_x", "chunk_y")
    placed.hint("rebalance", *keys).write.partitionBy(*keys).parquet(f"{path}/blocks")
    empty.write.parquet(f"{path}/empty")


def read_cell_blocks(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.parquet(f"{path}/blocks")
    return raw.withColumns({c: F.col(c).cast("long") for c in ("chip", "chunk_x", "chunk_y")})


def export_label_pixels(pixels: DataFrame, path: str, group: str = "tissue", bin_size: int = 1) -> None:
    """Gzip CSV of label pixels in label order; range partitions also split a single large label."""
    rows = (pixels.where("label > 0").repartitionByRange("label", "y", "x").sortWithinPartitions("label", "y", "x")
            .select(F.col("x").alias("X coordinate"), F.col("y").alias("Y coordinate"), F.lit(group).alias("Group name"),
                    F.format_string("Label %02d", F.col("label")).alias("Label name"), F.lit(bin_size).alias("Bin size")))
    rows.write.csv(path, header=True, compression="gzip")


def read_label_pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="`X coordinate` bigint, `Y coordinate` bigint, `Group name` string, "
                                                    "`Label name` string, `Bin size` int")


def border_features(vertices: DataFrame) -> DataFrame:
    """One GeoJSON feature per closed ring of at least three vertices ``(chip, cell_id, idx, x, y)``."""
    ring = vertices.groupBy("chip", "cell_id").agg(F.sort_array(F.collect_list(F.struct("idx", "x", "y"))).alias("r"))
    pts = F.transform("r", lambda p: F.array(p["x"], p["y"]))
    closed = F.concat(pts, F.slice(pts, 1, 1))
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"), F.col("cell_id").alias("id"),
        F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"),
        F.struct(F.lit("annotation").alias("objectType"), F.concat(F.lit("cell "), F.col("cell_id")).alias("name")).alias("properties")))
    return ring.where(F.size("r") >= 3).select("chip", "cell_id", feature.alias("feature"))


def export_geojson(vertices: DataFrame, path: str) -> None:
    """Newline-delimited features, one folder per chip."""
    features = border_features(vertices).select("chip", F.col("feature").alias("value"))
    features.hint("rebalance", "chip").write.partitionBy("chip").text(path)
