"""Scan windows, greedy suppression, top tiles and corner snapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..plans.buckets import bucket, square_distance
from ..session import cut, small


def assign_scan_window(regions: DataFrame, scale: float = 1.5, min_step: int = 500) -> DataFrame:
    """Number the non-empty scan windows of regions ``(chip, label, area, cx, cy)`` row by row."""
    step = small(regions.groupBy("chip").agg(F.greatest(
        F.lit(min_step).cast("long"), F.floor(F.sqrt(F.avg("area")) * scale).cast("long")).alias("_step")))
    placed = regions.join(step, "chip").withColumns({
        "wy": F.floor(F.col("cy") / F.col("_step")), "wx": F.floor(F.col("cx") / F.col("_step"))}).drop("_step")
    order = Window.partitionBy("chip").orderBy("wy", "wx")
    windows = placed.groupBy("chip", "wy", "wx").agg(F.count("*").alias("_n"))
    windows = windows.withColumn("scan_window", F.row_number().over(order).cast("long")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(small(windows.drop("_n")), ["chip", "wy", "wx"])


def scan_order_labels(regions: DataFrame, scale: float = 1.5, min_step: int = 500) -> DataFrame:
    """Final label of each region: by scan window, then by centre inside the window."""
    placed = assign_scan_window(regions, scale, min_step)
    local = Window.partitionBy("chip", "scan_window").orderBy("cy", "cx", "label")
    return (placed.withColumn("local_index", F.row_number().over(local).cast("long"))
            .withColumn("new_label", (F.col("_before") + F.col("local_index")).cast("long")).drop("_before"))


def rotated_nms(det: DataFrame, max_keep: int = 1000, max_det: int = 1500, conf: int | float | None = None,
                class_gap: int = 4096) -> DataFrame:
    """Greedy suppression by score: a kept box removes boxes whose centre is within min(w, h).

    Boxes are in size classes, with buckets no smaller than any reach of the
    class.  In a round the best open box of a bucket is kept when no class holds
    a better one in the nine buckets around it; kept boxes then suppress their
    surroundings.  A box meets at most nine kept boxes per class and round, so
    piles of detections never form pairs, and a huge box holds up only the boxes
    near it until it is decided.  The outcome equals the sequential one, ties by id.
    """
    if conf is not None:
        det = det.where(F.col("score") > conf)
    reach = F.least("w", "h")
    rank = F.struct("score", (-F.col("id")).alias("nid"))
    open_boxes = cut(det.select("img", "id", (F.col("cx") + F.col("cls") * class_gap).alias("x"),
                                (F.col("cy") + F.col("cls") * class_gap).alias("y"), reach.alias("reach"), rank.alias("rk"),
                                F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(reach, F.lit(1)))) + 1).cast("long").alias("edge")))
    edges = small(open_boxes.select("img", "edge").distinct())
    at = ["img", "edge", "bx", "by"]

    def placed(boxes: DataFrame) -> DataFrame:
        return boxes.withColumns({"bx": F.floor(F.col("x") / F.col("edge")), "by": F.floor(F.col("y") / F.col("edge"))})

    def around(boxes: DataFrame) -> DataFrame:
        step = F.array(*[F.lit(d) for d in (-1, 0, 1)])
        return (boxes.withColumn("bx", F.explode(F.transform(step, lambda d: F.col("bx") + d)))
                .withColumn("by", F.explode(F.transform(step, lambda d: F.col("by") + d))))

    kept = None
    while not open_boxes.isEmpty():
        top = cut(placed(open_boxes).groupBy(*at).agg(F.max(F.struct("rk", "id", "x", "y", "reach")).alias("t")).select(*at, "t.*"))
        best = around(top).groupBy(*at).agg(F.max("rk").alias("_hi"))
        beaten = (placed(top.select("img", "id", "x", "y", "rk").join(edges, "img")).join(best, at)
                  .where(F.col("rk") < F.col("_hi")).select("img", "id").distinct())
        won = cut(top.join(beaten, ["img", "id"], "left_anti"))
        kept = won.select("img", "id") if kept is None else kept.unionByName(won.select("img", "id"))
        near = around(won).select(*at, F.col("x").alias("s_x"), F.col("y").alias("s_y"), F.col("reach").alias("s_r"))
        gone = (placed(open_boxes.drop("edge").join(edges, "img")).join(near, at)
                .where(square_distance() <= F.col("s_r") * F.col("s_r")).select("img", "id").distinct())
        open_boxes = cut(open_boxes.join(gone, ["img", "id"], "left_anti"))
    result = det if kept is None else det.join(kept, ["img", "id"], "left_semi")
    order = Window.partitionBy("img").orderBy(F.desc("score"), "id")
    return (result.withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= min(max_keep, max_det)))


def top_density_tiles(cell_runs: DataFrame, k: int, n: int = 5, tissue: DataFrame | None = None) -> DataFrame:
    """The ``n`` tiles of each chip with most objects."""
    from ..plans.buckets import overlap_runs
    if tissue is not None:
        cell_runs = overlap_runs(cell_runs, tissue).withColumnRenamed("label_a", "label")
    spread = cell_runs.select("chip", "label", bucket("y", k).alias("ty"), F.explode(
        F.sequence(bucket("x0", k), bucket("x1", k))).alias("tx")).distinct()
    tiles = spread.groupBy("chip", "ty", "tx").agg(F.count("*").alias("objects"))
    order = Window.partitionBy("chip").orderBy(F.desc("objects"), "ty", "tx")
    return tiles.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def snap_tissue_corners(outline: DataFrame) -> DataFrame:
    """Outline pixel nearest to each bounding-box corner of the largest object.

    ``outline(chip, label, area, x, y)`` carries the object's area.
    """
    largest = small(outline.groupBy("chip").agg(F.max(F.struct("area", "label")).alias("m"))
                    .select("chip", F.col("m.label").alias("label")))
    own = outline.join(largest, ["chip", "label"])
    box = small(own.groupBy("chip").agg(F.min("x").alias("l"), F.max("x").alias("r"),
                                        F.min("y").alias("t"), F.max("y").alias("b")))
    corner = F.array(*[F.struct(F.lit(i).alias("k"), F.col(cx).alias("x"), F.col(cy).alias("y"))
                       for i, (cx, cy) in enumerate((("l", "t"), ("r", "t"), ("r", "b"), ("l", "b")))])
    px = own.join(box, "chip").withColumn("c", F.explode(corner))
    d2 = (F.col("x") - F.col("c.x")) ** 2 + (F.col("y") - F.col("c.y")) ** 2
    best = px.groupBy("chip", F.col("c.k").alias("k")).agg(F.min(F.struct(d2.alias("d2"), "y", "x")).alias("m"))
    return best.select("chip", F.col("k").cast("long").alias("k"), F.col("m.x").alias("x"), F.col("m.y").alias("y"))
