"""Chunk-wise heat-maps and cell tables with Structured Streaming.

State is one running sum per spot, and one per gene and per spot of a cell, so it is bounded by the chip; each micro-batch
adds the rows it changed to a running table (``tables``) and reading takes the newest per key.  The order in which chunks
arrive does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cells import saturate
from ..operators.masks import centroids
from ..plans.buckets import points_in_runs
from .tables import RunningTable

POINTS = "chip bigint, gene string, x bigint, y bigint, mid bigint"
SPOT, CELL = ("chip", "x", "y"), ("chip", "cell_id")
SPOT_SUM = "chip bigint, x bigint, y bigint, mid bigint"
#: A gene of a cell (without a place) or a spot of it (without a gene).
PART = (*CELL, "part", "gene", "x", "y")
PART_SUMS = "chip bigint, cell_id bigint, part string, gene string, x bigint, y bigint, mid bigint, n bigint"


def _source(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(POINTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _run(changed: DataFrame, table: RunningTable, state: str):
    return (changed.writeStream.outputMode("update").foreachBatch(lambda rows, epoch: table.add(rows, epoch) and None)
            .option("checkpointLocation", state).trigger(availableNow=True).start())


def stream_dnb(spark: SparkSession, source: str, out: str, state: str, files_per_batch: int = 1):
    """Running sums per spot; returns the streaming query."""
    sums = _source(spark, source, files_per_batch).groupBy(*SPOT).agg(F.sum("mid").cast("long").alias("mid"))
    return _run(sums, RunningTable(spark, out, SPOT), state)


def read_dnb(spark: SparkSession, out: str, bits: int = 8) -> DataFrame:
    """Newest sum per spot, saturated at read-out."""
    return RunningTable(spark, out, SPOT).read(SPOT_SUM).withColumn("mid", saturate(F.col("mid"), bits))


def stream_cell_counts(spark: SparkSession, source: str, runs: DataFrame, out: str, state: str, files_per_batch: int = 1):
    """Running sums of the genes and spots of each cell against a static mask; returns the streaming query.

    Keyed state is a row for each gene and each spot of a cell, so a chunk touches only what it holds and a crowded cell
    is dealt to many tasks.  The state lives in RocksDB on the executors and in the folder ``state``, from which a new
    query goes on.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    points = points_in_runs(_source(spark, source, files_per_batch), runs.select("chip", "label", "y", "x0", "x1"), "inner")
    row = lambda part, gene, x, y, mid: F.struct(
        F.lit(part).alias("part"), gene.cast("string").alias("gene"), x.cast("long").alias("x"), y.cast("long").alias("y"), mid.cast("long").alias("mid"))
    none = F.lit(None)
    both = F.array(row("gene", F.col("gene"), none, none, F.col("mid")), row("spot", none, F.col("x"), F.col("y"), none))
    parts = points.select("chip", F.col("label").alias("cell_id"), F.explode(both).alias("p")).select(*CELL, "p.*")
    sums = parts.groupBy(*PART).agg(F.sum("mid").cast("long").alias("mid"), F.count("*").alias("n"))
    return _run(sums, RunningTable(spark, out, PART), state)


def read_cell_counts(spark: SparkSession, out: str) -> DataFrame:
    """Newest sums of the cells that hold points: ``(chip, cell_id, mid, n, n_gene, n_dnb)``."""
    gene, spot = F.col("part") == "gene", F.col("part") == "spot"
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return RunningTable(spark, out, PART).read(PART_SUMS).groupBy(*CELL).agg(
        whole(F.sum(F.when(gene, F.col("mid")))).alias("mid"), whole(F.sum(F.when(gene, F.col("n")))).alias("n"),
        F.count(F.when(gene, 1)).alias("n_gene"), F.count(F.when(spot, 1)).alias("n_dnb"))


def read_cell_obs(spark: SparkSession, out: str, runs: DataFrame) -> DataFrame:
    """The table of ``cells.cell_obs`` from the running sums; cells without points have zeros."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    shape = centroids(runs).withColumnRenamed("label", "cell_id")
    return (shape.join(read_cell_counts(spark, out), [*CELL], "left")
            .select(*CELL, "area", "cx", "cy", zero("mid"), zero("n_gene"), zero("n_dnb"), zero("n")))
