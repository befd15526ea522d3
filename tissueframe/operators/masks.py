"""Overlap statistics and the algebra of mask layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.buckets import bucket, overlap_pairs, overlap_runs, points_in_runs, run_pieces
from ..plans.islands import area, merge_runs, pixels_from_runs, runs_from_pixels, subtract, uncovered
from ..session import cut, deal, small, spread
from .components import connected_components, first_pixel
from .morphology import drop_seams, drop_small_objects, expand_labels, outline


#: Most reference centroids of an object whose pixels are compared with all of them.
FEW_SITES = 64


def _one() -> Column:
    return F.lit(1).cast("long")


def largest_overlap_map(a: DataFrame, b: DataFrame) -> DataFrame:
    """Partner of largest shared area in both directions; the larger label wins ties."""
    pairs = overlap_pairs(a, b)
    both = pairs.select("chip", "cnt", F.explode(F.array(
        F.struct(F.lit("a_to_b").alias("direction"), F.col("label_a").alias("label"), F.col("label_b").alias("other")),
        F.struct(F.lit("b_to_a").alias("direction"), F.col("label_b").alias("label"), F.col("label_a").alias("other")),
    )).alias("p")).select("chip", "cnt", "p.*")
    return (both.groupBy("chip", "direction", "label")
            .agg(F.max(F.struct("cnt", "other")).alias("m"))
            .select("chip", "direction", "label", F.col("m.other").alias("partner"), F.col("m.cnt").alias("cnt")))


def overlap_fraction(a: DataFrame, b: DataFrame, by: str = "b") -> DataFrame:
    """Largest overlap of each ``a`` label over its partner's area (or its own)."""
    best = (overlap_pairs(a, b).groupBy("chip", "label_a")
            .agg(F.max(F.struct("cnt", "label_b")).alias("m"))
            .select("chip", F.col("label_a").alias("label"), F.col("m.cnt").alias("cnt"),
                    F.col("m.label_b").alias("partner")))
    sizes = area(b).withColumnRenamed("label", "partner") if by == "b" else area(a)
    on = ["chip", "partner"] if by == "b" else ["chip", "label"]
    return best.join(sizes, on).select("chip", "label", "partner", (F.col("cnt") / F.col("area")).alias("fraction"))


def mask_minus(a: DataFrame, b: DataFrame, min_size: int = 15) -> DataFrame:
    """``a`` outside ``b``, relabelled with 4-connectivity, specks removed."""
    return cut(drop_small_objects(connected_components(uncovered(a, b), 4), min_size))


def mask_and(a: DataFrame, b: DataFrame, min_size: int = 15) -> DataFrame:
    """``a`` inside ``b``, relabelled with 4-connectivity, specks removed."""
    return cut(drop_small_objects(connected_components(overlap_runs(a, b), 4), min_size))


def mask_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Logical or, as label 1 runs."""
    cols = ("chip", "y", "x0", "x1")
    return (merge_runs(a.select(*cols).unionByName(b.select(*cols)), ("chip", "y"))
            .select("chip", _one().alias("label"), "y", "x0", "x1"))


def keep_large_fragments(orig: DataFrame, frag: DataFrame, thr: float = 0.4) -> DataFrame:
    """Drop fragments that keep less than ``thr`` of the object they come from.

    Pixels next to each other are of one object, so a piece lies in the object that holds its first pixel.
    """
    objects = connected_components(orig, 8)
    inside = overlap_runs(objects, frag.withColumn("label", _one()))
    pieces = connected_components(inside, 4)
    y, x = first_pixel(F.col("label"))
    first = area(pieces).select("chip", "label", F.col("area").alias("cnt"), y.alias("y"), x.alias("x"))
    share = (points_in_runs(first, objects.withColumnRenamed("label", "object"), "inner")
             .join(area(objects).withColumnRenamed("label", "object"), ["chip", "object"])
             .where(F.col("cnt") / F.col("area") >= thr)
             .select("chip", "label"))
    kept = pieces.join(share, ["chip", "label"], "left_semi")
    return cut(mask_union(kept, uncovered(frag.withColumn("label", _one()), orig)))


def overlap_merge(secondary: DataFrame, primary: DataFrame, thr: float) -> tuple[DataFrame, DataFrame]:
    """Add what ``primary`` leaves of ``secondary``; returns (kept secondary, merged mask)."""
    left = mask_minus(secondary, primary)
    kept = keep_large_fragments(secondary, left, thr)
    cols = ("chip", _one().alias("label"), "y", "x0", "x1")
    both = primary.select(*cols).unionByName(kept.select(*cols))
    return kept, cut(subtract(both, outline(kept, whole=False)))


def multimodal_merge(nuclei: DataFrame, boundary: DataFrame, interior: DataFrame):
    """Interior into boundary (0.5), then nuclei into the result (0.8).

    Returns (kept nuclei, boundary plus interior, merged mask).
    """
    _, cell = overlap_merge(interior, boundary, 0.5)
    kept, merged = overlap_merge(nuclei, cell, 0.8)
    return kept, cell, merged


def merge_layers(nuclei: DataFrame, boundary: DataFrame, interior: DataFrame, matrix: DataFrame,
                 r: int = 10, min_size: int = 15) -> tuple[DataFrame, DataFrame]:
    """Combine the layers that each chip has into (cell mask, nuclear mask).

    Chips with the same layers are merged together; there are at most 15 such sets.
    """
    layers = {"nuclei": nuclei, "boundary": boundary, "interior": interior, "matrix": matrix}
    found = reduce(DataFrame.unionByName, (df.select("chip", F.lit(n).alias("layer")).distinct() for n, df in layers.items()))
    present = cut(found.groupBy("chip").agg(F.array_join(F.sort_array(F.collect_set("layer")), ",").alias("has")))
    sets = sorted(row["has"] for row in present.select("has").distinct().collect())
    if len(sets) < 2:
        return _merge_present(layers, set(sets[0].split(",")) if sets else set(), r, min_size)
    parts = []
    for has in sets:
        chips = present.where(F.col("has") == has).select("chip")
        own = {n: df.join(chips, "chip", "left_semi") for n, df in layers.items()}
        parts.append(_merge_present(own, set(has.split(",")), r, min_size))
    cell, core = zip(*parts)
    return reduce(DataFrame.unionByName, cell), reduce(DataFrame.unionByName, core)


def _merge_present(layers: dict[str, DataFrame], has: set[str], r: int, min_size: int) -> tuple[DataFrame, DataFrame]:
    """Merge the layers ``has`` of chips that all have them."""
    nuclei, boundary, interior = layers["nuclei"], layers["boundary"], layers["interior"]
    stained = has - {"matrix"}
    if has >= {"nuclei", "matrix"}:
        cell = split_multi_cells(layers["matrix"], nuclei)
    elif stained == {"nuclei", "boundary", "interior"}:
        kept, base, _ = multimodal_merge(nuclei, boundary, interior)
        cell = overlap_merge(expand_labels(kept, r), base, 0.1)[1]
    elif stained == {"nuclei", "boundary"}:
        kept, _ = overlap_merge(nuclei, boundary, 0.8)
        cell = overlap_merge(expand_labels(kept, r), boundary, 0.1)[1]
    elif stained == {"nuclei"}:
        cell = expand_labels(nuclei, r)
    elif stained == {"boundary"}:
        cell = boundary
    elif stained == {"interior"}:
        cell = interior
    else:
        return nuclei, nuclei
    cell = cut(drop_small_objects(connected_components(cell, 4), min_size))
    if "nuclei" not in has:
        return cell, nuclei
    core = mask_and(nuclei, cell, min_size)
    return cell, keep_large_fragments(nuclei, core)


def merge_conflict(nuclei: DataFrame, membrane: DataFrame, cover: str = "nuclear") -> DataFrame:
    """Both layers without the objects of the losing layer that touch the other."""
    pairs = overlap_pairs(nuclei, membrane)
    if cover == "nuclear":
        hit = pairs.select("chip", F.col("label_b").alias("label")).distinct()
        membrane = membrane.join(hit, ["chip", "label"], "left_anti")
    else:
        hit = pairs.select("chip", F.col("label_a").alias("label")).distinct()
        nuclei = nuclei.join(hit, ["chip", "label"], "left_anti")
    cols = ("chip", "label", "y", "x0", "x1")
    return (membrane.select(F.lit("membrane").alias("layer"), *cols)
            .unionByName(nuclei.select(F.lit("nuclear").alias("layer"), *cols)))


def cells_inside_tissue(cells: DataFrame, tissue: DataFrame) -> DataFrame:
    """Objects whose every pixel lies in tissue."""
    flat = merge_runs(tissue.select("chip", "y", "x0", "x1"), ("chip", "y")).withColumn("label", _one())
    covered = overlap_pairs(cells, flat).select("chip", F.col("label_a").alias("label"), "cnt")
    whole = area(cells).join(covered, ["chip", "label"]).where("cnt = area").select("chip", "label")
    return cells.join(whole, ["chip", "label"], "left_semi")


def mask_iou(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection over union of two semantic masks per chip."""
    fa = merge_runs(a.select("chip", "y", "x0", "x1"), ("chip", "y")).withColumn("label", _one())
    fb = merge_runs(b.select("chip", "y", "x0", "x1"), ("chip", "y")).withColumn("label", _one())
    sizes = (area(fa, ("chip",)).withColumnRenamed("area", "na")
             .join(area(fb, ("chip",)).withColumnRenamed("area", "nb"), "chip", "full"))
    shared = overlap_pairs(fa, fb).select("chip", "cnt")
    both = F.coalesce("cnt", F.lit(0))
    union = F.coalesce("na", F.lit(0)) + F.coalesce("nb", F.lit(0)) - both
    return sizes.join(shared, "chip", "left").select("chip", (both / (union + F.lit(1e-5))).alias("iou"))


def overlap_keep_remove(a: DataFrame, b: DataFrame, thr: float = 0.5) -> DataFrame:
    """Verdict per ``a`` object: covered by ``b`` in more than ``thr`` of its area."""
    flat = merge_runs(b.select("chip", "y", "x0", "x1"), ("chip", "y")).withColumn("label", _one())
    shared = overlap_pairs(a, flat).select("chip", F.col("label_a").alias("label"), "cnt")
    return (area(a).join(shared, ["chip", "label"], "left")
            .select("chip", "label", (F.coalesce("cnt", F.lit(0)) / F.col("area")).alias("ratio"))
            .withColumn("keep", F.col("ratio") > thr))


def overlap_report(nuclei: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts of both layers and the shares with an overlap of 0.5 and 0.1 of own area."""
    n = (area(nuclei).join(overlap_fraction(nuclei, cells, "a"), ["chip", "label"], "left").groupBy("chip")
         .agg(F.count("*").alias("nuclei"), F.avg((F.coalesce("fraction", F.lit(0.0)) >= 0.5).cast("double"))
              .alias("nuclei_share")))
    c = (area(cells).join(overlap_fraction(cells, nuclei, "a"), ["chip", "label"], "left").groupBy("chip")
         .agg(F.count("*").alias("cells"), F.avg((F.coalesce("fraction", F.lit(0.0)) >= 0.1).cast("double"))
              .alias("cells_share")))
    return n.join(c, "chip", "full")


def centroids(runs: DataFrame) -> DataFrame:
    """Area and mean pixel position per label."""
    n = F.col("x1") - F.col("x0") + 1
    return spread(runs.groupBy("chip", "label")
            .agg(F.sum(n).cast("long").alias("area"),
                 F.sum((F.col("x0") + F.col("x1")) * n).cast("long").alias("_sx"),
                 F.sum(F.col("y") * n).cast("long").alias("_sy"))
            .select("chip", "label", "area", (F.col("_sx") / (2 * F.col("area"))).alias("cx"),
                    (F.col("_sy") / F.col("area")).alias("cy")))


def _contained(src: DataFrame, ref: DataFrame) -> DataFrame:
    """Reference centroids with the source object they fall in."""
    spots = centroids(ref).select("chip", F.col("label").alias("ref"), "cx", "cy",
                                  F.floor(F.col("cx") + 0.5).cast("long").alias("x"),
                                  F.floor(F.col("cy") + 0.5).cast("long").alias("y"))
    return points_in_runs(spots, src, "inner")


def centroid_containment(src: DataFrame, ref: DataFrame) -> DataFrame:
    """Number of reference centroids in each source object; two or more is ``multi``."""
    hits = _contained(src, ref).groupBy("chip", "label").agg(F.count("*").alias("n"))
    return (area(src).join(hits, ["chip", "label"], "left")
            .select("chip", "label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
            .withColumn("kind", F.when(F.col("n") < 2, "single").otherwise("multi")))


def nearest_site(points: DataFrame, sites: DataFrame, keys: tuple[str, ...], reach: int,
                 tie: tuple[str, ...]) -> DataFrame:
    """The nearest site of each point, exact for any distance.

    Searches the surrounding buckets; a hit no farther than the bucket edge is
    final, the remaining points try again with a bucket twice as wide.  Points
    must be distinct rows; keys without a site are dropped.
    """
    from ..plans.buckets import near_join, square_distance

    cols = points.columns
    sites = cut(sites.distinct())
    open_points = cut(points.join(sites.select(*keys).distinct(), [*keys], "left_semi"))
    done = None
    while True:
        near = near_join(open_points, sites, reach, keys, "left").withColumn("_d2", square_distance())
        best = cut(near.groupBy(*cols).agg(F.min(F.when(F.col("_d2").isNotNull(), F.struct(
            F.col("_d2").alias("d2"), *[F.col(f"s_{t}").alias(f"s_{t}") for t in tie]))).alias("_m")))
        final = F.coalesce(F.col("_m.d2") <= reach * reach, F.lit(False))
        hit = best.where(final).select(*cols, "_m.*")
        done = hit if done is None else done.unionByName(hit)
        open_points = best.where(~final).select(*cols)
        if open_points.isEmpty():
            return done
        reach *= 2


def split_multi_cells(src: DataFrame, ref: DataFrame) -> DataFrame:
    """Cut source objects that hold several reference centroids along their bisectors.

    A run of an object with few centroids finds the owners of its pixels from the list of all; the pixels of the others search buckets.
    """
    kind = cut(centroid_containment(src, ref))
    multi = kind.where("kind = 'multi'")
    single = src.join(kind.where("kind = 'single'").select("chip", "label"), ["chip", "label"], "left_semi")
    sites = _contained(src, ref).select("chip", "label", F.col("cx").alias("x"), F.col("cy").alias("y"), "ref")
    few, many = (multi.where(cond).select("chip", "label") for cond in (F.col("n") <= FEW_SITES, F.col("n") > FEW_SITES))
    owned = _owned_runs(src, sites.join(few, ["chip", "label"], "left_semi"))
    if not many.isEmpty():
        pixels = pixels_from_runs(src.join(many, ["chip", "label"], "left_semi")).select("chip", "label", "y", "x")
        near = nearest_site(pixels.distinct(), sites.join(many, ["chip", "label"], "left_semi"), ("chip", "label"), 16, ("ref",))
        owned = owned.unionByName(runs_from_pixels(near.select("chip", F.col("s_ref").alias("label"), "y", "x")))
    cols = ("chip", "y", "x0", "x1")
    return mask_union(single.select(*cols), drop_seams(owned, whole=False).select(*cols))


def _owned_runs(runs: DataFrame, sites: DataFrame) -> DataFrame:
    """Runs cut where the nearest of their label's ``sites(chip, label, x, y, ref)`` changes; the label is then its ``ref``."""
    lists = sites.groupBy("chip", "label").agg(F.collect_set(F.struct("x", "y", "ref")).alias("_s"))
    held = deal(run_pieces(runs).select("chip", "label", "y", "x0", "x1"), "chip", "label").join(spread(lists), ["chip", "label"])

    def owner(x: Column) -> Column:
        def far(s: Column) -> Column:
            dx, dy = x - s["x"], F.col("y") - s["y"]
            return F.struct((dx * dx + dy * dy).alias("d2"), s["ref"].alias("ref"))
        return F.array_min(F.transform("_s", far))["ref"]

    piece = lambda ref, x0, x1: F.array(F.struct(ref.alias("label"), x0.alias("x0"), x1.alias("x1")))
    none = F.slice(piece(owner(F.col("x0")), F.col("x0"), F.col("x0")), 1, 0)
    state = lambda ref, at, done: F.struct(ref.alias("ref"), at.alias("at"), done.alias("done"))
    pieces = F.aggregate(
        F.sequence("x0", "x1"), state(owner(F.col("x0")), F.col("x0"), none),
        lambda st, x: F.when(st["ref"].eqNullSafe(owner(x)), st).otherwise(
            state(owner(x), x, F.concat(st["done"], piece(st["ref"], st["at"], x - 1)))),
        lambda st: F.concat(st["done"], piece(st["ref"], st["at"], F.col("x1"))))
    return held.select("chip", "y", F.explode(pieces).alias("_p")).select("chip", "_p.label", "y", "_p.x0", "_p.x1")


def fit_mask(runs: DataFrame, extent: DataFrame, binx: int = 1) -> DataFrame:
    """Crop runs to ``extent(chip, width, height)`` and scale them down by ``binx``."""
    fitted = (runs.join(small(extent.select("chip", "width", "height")), "chip")
              .where("y >= 0 and y < height and x1 >= 0 and x0 < width")
              .select("chip", "label", "y", F.greatest("x0", F.lit(0)).alias("x0"),
                      F.least("x1", F.col("width") - 1).alias("x1")))
    if binx != 1:
        fitted = fitted.select("chip", "label", bucket("y", binx).alias("y"),
                               bucket("x0", binx).alias("x0"), bucket("x1", binx).alias("x1"))
    return merge_runs(fitted)
