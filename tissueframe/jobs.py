"""Composite jobs: the pipeline stages as chains of operators.

Every job takes and returns DataFrames, so a stage can be written, restarted or
queried on its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .functions import intensity
from .operators import cells, cluster, images, masks, morphology, reduction, registration, stitching
from .session import cut, small
from .sources import cell_tables, records


def extract_matrix(expression: DataFrame, tissue: DataFrame, nuclei: DataFrame, cell: DataFrame | None = None, r: int = 10,
                   bin_size: int = 1) -> dict[str, DataFrame]:
    """Tissue counts, and gene and cell tables of the final nuclear and cell masks, all from the points in tissue.

    Without a cell mask nuclei grown by ``r`` take its place.
    """
    inside = cut(cells.points_in_tissue(expression, tissue))
    if cell is None:
        cell = cut(morphology.expand_labels(nuclei, r, labelled=True))
    out = {"tissue": cells.bin_gene_matrix(inside, bin_size)}
    for name, mask in (("nuclear", nuclei), ("cell", cell)):
        assigned = cut(cells.assign_cells(inside, mask))
        out[f"{name}_gene"] = cells.cell_gene_matrix(assigned)
        out[f"{name}_cell"] = cells.cell_obs(assigned, mask)
    return out


def write_matrix(tables: dict[str, DataFrame], path: str) -> None:
    """The nuclear and the cell tables of ``extract_matrix`` as ``path/nuclear`` and ``path/cell``, laid out by cell."""
    for name in ("nuclear", "cell"):
        cell_tables.write_cells(tables[f"{name}_cell"], tables[f"{name}_gene"], f"{path}/{name}")


def metrics_by_variant(expression: DataFrame, variants: dict[str, DataFrame], tissue: DataFrame, **options) -> DataFrame:
    """``metrics_job`` of every mask variant (nuclear, cell, ...) as ``(chip, variant, section, name, value)``."""
    parts = [metrics_job(expression, mask, tissue, **options).withColumn("variant", F.lit(name)) for name, mask in variants.items()]
    return reduce(DataFrame.unionByName, parts)


def metrics_tables(expression: DataFrame, variants: dict[str, DataFrame], tissue: DataFrame, pixels: DataFrame,
                   clusters: DataFrame | None = None, size: int = 20, width: float = 8.0) -> dict[str, DataFrame]:
    """The tables behind the report of a chip, each with a ``variant`` column.

    ``heatmap``: binned counts of the tissue (variant ``tissue``) and of the cells of each mask; ``ratio``: share of the
    tissue's intensity in the mask; ``intensity``: histogram of the mean intensity of its objects; ``clusters``: binned
    positions with the size of their cluster, for ``clusters(chip, cell_id, cluster, cx, cy)``.
    """
    inside = cut(cells.points_in_tissue(expression, tissue))
    tag = lambda df, name: df.withColumn("variant", F.lit(name))
    heat = [tag(cells.bin_heatmap(inside, size), "tissue")]
    ratio, hist = [], []
    for name, mask in variants.items():
        heat.append(tag(cells.bin_heatmap(cells.assign_cells(inside, mask).where("cell_id > 0"), size), name))
        ratio.append(tag(images.intensity_ratio(mask, tissue, pixels), name))
        hist.append(tag(images.intensity_histogram(images.object_intensity(mask, pixels), width), name))
    out = {name: reduce(DataFrame.unionByName, parts) for name, parts in (("heatmap", heat), ("ratio", ratio), ("intensity", hist))}
    if clusters is not None:
        out["clusters"] = images.cluster_report(clusters)
    return out


def metrics_job(expression: DataFrame, nuclei: DataFrame, tissue: DataFrame, radius: int = 200,
                resolution: float = 500.0) -> DataFrame:
    """All cell metrics of a chip as ``(chip, section, name, value)``, from the points in tissue."""
    inside = cut(cells.points_in_tissue(expression, tissue))
    assigned = cut(cells.assign_cells(inside, nuclei))
    obs = cut(cells.cell_obs(assigned, nuclei).withColumn("diameter", intensity.cell_diameter(F.col("area"), resolution)))
    density = cells.cell_density(obs.select("chip", "cell_id", F.floor(F.col("cx") + 0.5).cast("long").alias("x"),
                                            F.floor(F.col("cy") + 0.5).cast("long").alias("y")), radius)

    def long(df: DataFrame, section: str) -> DataFrame:
        cols = [F.col(c).cast("double").alias(c) for c in df.columns if c != "chip"]
        return df.unpivot(["chip"], cols, "name", "value").select("chip", F.lit(section).alias("section"), "name", "value")

    five = cells.five_number(obs, ("area", "diameter", "mid", "n_gene"))
    quart = five.unpivot(["chip", "name"], ["min", "q1", "median", "q3", "max"], "stat", "value").select(
        "chip", F.lit("distribution").alias("section"), F.concat_ws("_", "name", "stat").alias("name"), "value")
    parts = [long(cells.cell_summary(obs), "cells"),
             long(cells.fraction_rich_cells(obs).drop("percent"), "rich"),
             long(cells.cell_to_tissue_ratio(assigned, cells.bin_gene_matrix(inside, 1)), "ratio"),
             long(images.area_ratio(nuclei, tissue), "area"),
             long(cells.trace_exceed(cells.object_trace(nuclei)), "trace"),
             long(density.groupBy("chip").agg(F.avg("density").alias("mean_density"), F.max("density").alias("max_density")), "density"),
             quart]
    return reduce(DataFrame.unionByName, parts)


def mask_job(nuclei: DataFrame, boundary: DataFrame, interior: DataFrame, matrix: DataFrame, r: int = 10) -> DataFrame:
    """Final cell and nuclear masks as one run table with a layer column."""
    cell, core = masks.merge_layers(nuclei, boundary, interior, matrix, r)
    cols = ("chip", "y", "x0", "x1")
    return (cell.select(F.lit("cell").alias("layer"), *cols)
            .unionByName(core.select(F.lit("nuclei").alias("layer"), *cols)))


def double_cell_filter(expression: DataFrame, nuclei: DataFrame, cells_per_region: int = 5000) -> DataFrame:
    """Cell x gene rows of the cells that are not flagged as doublets."""
    assigned = cut(cells.assign_cells(expression, nuclei))
    flags = cells.mad_outliers(cells.cell_obs(assigned, nuclei), cells_per_region=cells_per_region)
    return cells.filter_cells_by_list(cells.cell_gene_matrix(assigned), flags)


def gene_registration(dnb: DataFrame, image: DataFrame, candidates, shape: tuple[int, int], box: int,
                      template=registration.TEMPLATE) -> dict[str, DataFrame]:
    """Track template of the counts, chip box, and the best turn and shift of an image."""
    dnb = cut(dnb)
    marginals = cut(registration.axis_marginals(dnb))
    first = registration.track_valley(marginals, template=template)
    length = marginals.groupBy("chip", "axis").agg((F.max("pos") + 1).alias("length"))
    positions = registration.cyclic_positions(first.join(length, ["chip", "axis"]).select("chip", "axis", "first", "length"), template)
    fixed = dnb.select(F.col("chip").alias("img"), "y", "x", F.col("mid").alias("v"))
    return {"template": registration.template_lattice(positions),
            "center": registration.mass_center(dnb),
            "chip_box": registration.chip_box_from_expression(dnb, box),
            "alignment": registration.best_alignment(registration.align_score(fixed, image, candidates, shape=shape))}


def register_points(detected: DataFrame, template: DataFrame, shape: tuple[int, int], anchor: tuple[float, float],
                    reach: float = 10.0) -> dict[str, DataFrame]:
    """Detected track points against a template ``(chip, x, y, ix, iy)``.

    ``pairs``: nearest template point of each detected point within ``reach``; ``offset``: median displacement of the
    pairs; ``turns``: offset of every quarter turn that moves its zero-index point nearest the anchor onto the anchor;
    ``turn``: the turn that moves least.
    """
    pairs = cut(registration.pair_nearest(detected, template, reach))
    turns = cut(registration.align_rank(template, shape, anchor, anchor))
    best = turns.groupBy("chip").agg(F.min(F.struct("dist", "rot", "offset_x", "offset_y")).alias("m"))
    return {"pairs": pairs, "offset": registration.median_offset(pairs), "turns": turns, "turn": best.select("chip", "m.*")}


def stitch_plan(fov: DataFrame, jitter: DataFrame, w: int, h: int, overlap: float = 0.1, conf: int = 2) -> dict[str, DataFrame]:
    """Cleaned offsets, their residuals and the location of every field of view."""
    clean = cut(stitching.jitter_consensus(stitching.filter_abnormal_offset(jitter, conf)))
    return {"jitter": clean, "error": stitching.stitch_error(clean, w, h, overlap),
            "location": stitching.fov_global_location(fov, clean, w, h, overlap)}


def stitch_slides(paths: DataFrame, jitter: DataFrame, pixels: DataFrame, w: int, h: int, cols: int, overlap: float = 0.1,
                  conf: int = 2, pattern: str = "*_{xxx}_{xxx}_*", index0: bool = True, line_scan: bool = False,
                  snake: tuple[int, str] | None = None) -> dict[str, DataFrame]:
    """From the files ``(slide, path)`` of scanned slides to their mosaics.

    Rows and columns come from the file names.  With ``snake = (rows, corner)`` the names count fields along a snake
    of ``cols`` columns (their last number, the first being 0) and are turned into rows and columns; offsets and pixels
    are keyed by row and column in either case.  ``line_scan`` places a slide by the median offsets of its columns.
    """
    found = records.scan_fov_listing(paths, pattern, index0).join(paths.select("slide", "path"), "path")
    if snake:
        rows, corner = snake
        found = stitching.snake_reorder(found.withColumn("k", F.col("r") * cols + F.col("c")), rows, cols, corner).drop("k")
    fov = cut(found.select("slide", "path", "r", "c"))
    out = stitch_plan(fov, jitter, w, h, overlap, conf)
    if line_scan:
        out["location"] = stitching.line_scan_location(fov, out["jitter"], w, h, overlap)
    out["location"] = cut(out["location"])
    return out | {"fov": fov, "mosaic": stitching.mosaic(pixels, out["location"], cols)}


def template_fit(track: DataFrame, template: DataFrame, conf: float = 0.5) -> dict[str, DataFrame]:
    """Scores, line angle per field and the quality of a template against detected points."""
    good = cut(track.where(F.col("conf") > conf))
    points = good.select("chip", "fov_row", "fov_col", "id", "x", "y")
    return {"score": registration.fov_track_score(good),
            "angle": registration.rotate_search(points, ("chip", "fov_row", "fov_col")),
            "quality": registration.template_eval(points.select("chip", "id", "x", "y"), template),
            "offset": registration.median_offset(registration.pair_nearest(points.select("chip", "id", "x", "y"), template, 10))}


def field_fit(track: DataFrame, boxes: DataFrame, shape: tuple[int, int], scales: tuple[float, ...], max_d: float,
              conf: float = 0.5, min_area: float = 0.0, template=registration.TEMPLATE) -> dict[str, DataFrame]:
    """Template scale per field and the area that the track points of a mosaic cover.

    ``track`` holds points in the pixels of their field ``(chip, fov_row, fov_col, id, x, y, conf)``, ``boxes`` the
    origin ``x0, y0`` of each field.  ``scale``: usual scale and start index per field; ``points``: positions in the
    mosaic; ``area``: hull of the clusters of points closer than ``max_d`` over ``shape``; ``passed`` where it is at
    least ``min_area`` (chips without a cluster have area 0).
    """
    keys = ("chip", "fov_row", "fov_col")
    good = cut(track.where(F.col("conf") > conf).select(*keys, "id", "x", "y"))
    points = cut(good.join(boxes.select(*keys, "x0", "y0"), [*keys])
                 .select(*keys, "id", (F.col("x") + F.col("x0")).alias("x"), (F.col("y") + F.col("y0")).alias("y")))
    hull = registration.point_cluster_area(points.select("chip", "id", "x", "y"), max_d, shape)
    area = points.select("chip").distinct().join(hull, "chip", "left").select(
        "chip", F.coalesce("area_ratio", F.lit(0.0)).alias("area_ratio"))
    return {"points": points, "scale": registration.scale_search(good, keys, scales, template=template),
            "area": area.withColumn("passed", F.col("area_ratio") >= min_area)}


def cluster_job(cell_gene: DataFrame, components: int = 8, neighbours: int = 10, top: int = 5000, **hvg) -> DataFrame:
    """Communities of cells from their highly variable genes.

    The features are the genes that are among the ``top`` of any chip; a cell
    becomes the sparse row of its counts, log1p.  Neighbours and
    communities are those of a chip, so cell ids need to be unique only there.
    """
    cell_gene = cut(cell_gene)
    genes = cells.highly_variable(cell_gene, top=top, **hvg).select("gene").distinct()
    index = cut(genes.withColumn("idx", F.row_number().over(Window.orderBy("gene")) - 1))  # a row for each gene
    width = index.count()
    picked = cell_gene.join(small(index), "gene")
    entry = F.sort_array(F.collect_list(F.struct("idx", F.log1p("mid").alias("v"))))  # the genes of a cell, no zeros
    packed = picked.groupBy("chip", "cell_id").agg(entry.alias("m"))
    vectors = cut(packed.select("chip", "cell_id", F.col("m.idx").alias("idx"), F.col("m.v").alias("val")))
    reduced = reduction.fit(vectors, "idx", "val", min(components, width), width).project(vectors, "idx", "val", "pca")
    graph = cluster.knn_graph(reduced.select("chip", "cell_id", "pca"), "cell_id", "pca", neighbours, by=("chip",))
    labels = cluster.community_labels(graph, ("chip",))
    return vectors.select("chip", "cell_id").join(labels.withColumnRenamed("node", "cell_id"), ["chip", "cell_id"])
