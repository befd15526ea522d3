"""Gaps-and-islands on label runs, one pixel row at a time.

A window over ``(keys, label, y)`` holds at most one row per pixel column of an
image, after the duplicates are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import deal, spread


def merge_runs(runs: DataFrame, by: tuple[str, ...] = ("chip", "label", "y"), gap: int = 1) -> DataFrame:
    """Union touching or overlapping intervals ``[x0, x1]`` within each group."""
    # the window needs no other shuffle; a task costs a hash table of its own, so there are fewer
    one = deal(runs.select(*by, "x0", "x1"), *by, share=4).groupBy(*by, "x0").agg(F.max("x1").alias("x1"))
    order = Window.partitionBy(*by).orderBy("x0")
    reach = F.max("x1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = one.withColumn("_new", F.when(F.col("x0") <= reach + gap, 0).otherwise(1))
    numbered = starts.withColumn("_isl", F.sum("_new").over(order))
    return (numbered.groupBy(*by, "_isl").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))
            .drop("_isl"))


def runs_from_pixels(pixels: DataFrame, by: tuple[str, ...] = ("chip", "label", "y")) -> DataFrame:
    """Consecutive pixels of one label in a row become one run."""
    px = pixels.select(*by, "x").distinct()
    order = Window.partitionBy(*by).orderBy("x")
    tagged = px.withColumn("_g", F.col("x") - F.row_number().over(order))
    return tagged.groupBy(*by, "_g").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_g")


def pixels_from_runs(runs: DataFrame) -> DataFrame:
    """One row per pixel of every run."""
    keep = [c for c in runs.columns if c not in ("x0", "x1")]
    return deal(runs, *keep).select(*keep, F.explode(F.sequence("x0", "x1")).alias("x"))


def subtract(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("chip",)) -> DataFrame:
    """Pixels of ``a`` that ``b`` does not cover, keeping the labels of ``a``."""
    return merge_runs(uncovered(a, b, keys), (*keys, "label", "y"))


def uncovered(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("chip",)) -> DataFrame:
    """The pieces of ``subtract`` within their buckets, for steps that merge runs themselves.

    Both sides meet in one shuffle on (row, bucket).  A bucket is 128 pixels wide,
    so its distinct pieces are few; each run of ``a`` walks over the sorted
    pieces of ``b`` and emits the gaps.
    """
    from .buckets import run_pieces

    spot = [*keys, "y", "_xb"]
    own = run_pieces(a).select(*spot, F.struct("label", "x0", "x1").alias("_a"),
                               F.lit(None).cast("struct<b0:bigint,b1:bigint>").alias("_b"))
    cover = run_pieces(b).select(*spot, F.lit(None).cast(own.schema["_a"].dataType).alias("_a"),
                                 F.struct(F.col("x0").cast("long").alias("b0"), F.col("x1").cast("long").alias("b1")).alias("_b"))
    met = deal(own.unionByName(cover), *spot, share=4).groupBy(*spot).agg(F.collect_set("_a").alias("_as"),
                                                    F.sort_array(F.collect_set("_b")).alias("_bs"))
    runs = met.select(*keys, "y", "_bs", F.explode("_as").alias("_a"))
    x0, x1 = F.col("_a.x0").cast("long"), F.col("_a.x1").cast("long")
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    piece = lambda lo, hi: F.array(F.struct(lo.alias("s"), hi.alias("e")))
    gaps = F.aggregate(
        F.filter("_bs", lambda c: (c["b0"] <= x1) & (c["b1"] >= x0)),
        F.struct(x0.alias("at"), none.alias("gaps")),
        lambda st, c: F.struct(
            F.greatest(st["at"], c["b1"] + 1).alias("at"),
            F.when(c["b0"] > st["at"], F.concat(st["gaps"], piece(st["at"], c["b0"] - 1))).otherwise(st["gaps"]).alias("gaps")),
        lambda st: F.when(st["at"] <= x1, F.concat(st["gaps"], piece(st["at"], x1))).otherwise(st["gaps"]))
    return (runs.select(*keys, F.col("_a.label").alias("label"), "y", F.explode(gaps).alias("g"))
            .select(*keys, "label", "y", F.col("g.s").alias("x0"), F.col("g.e").alias("x1")))


def area(runs: DataFrame, by: tuple[str, ...] = ("chip", "label")) -> DataFrame:
    return spread(runs.groupBy(*by).agg(F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("area")))
