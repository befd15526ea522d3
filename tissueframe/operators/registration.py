"""Track points, templates, alignment scores and landmark fits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geometry
from ..plans.buckets import bucket, near_join, square_distance
from ..plans.groups import starts
from ..plans.islands import merge_runs
from ..plans.tiles import TILE, paint_pixels, tiles_of
from ..session import cut, deal, small, spread
from .components import point_components
from .masks import nearest_site

#: Steps between the nine track lines of a period.
PITCH = (240, 300, 330, 390, 390, 330, 300, 240, 420)
#: Steps along x and along y.
TEMPLATE = (PITCH, PITCH)
#: Points whose distances to all candidates of a scale search are held at a time.
CHUNK = 4096


def track_prefix(pitch) -> tuple[int, ...]:
    """Offsets of the track lines from the first of a period."""
    return tuple(sum(pitch[:i]) for i in range(len(pitch)))


def _by_axis(value, template) -> Column:
    """``value`` of the steps along the axis of a row."""
    return F.when(F.col("axis") == "x", value(template[0])).otherwise(value(template[1]))


def _offsets(template) -> Column:
    return _by_axis(lambda p: F.array(*[F.lit(v).cast("long") for v in track_prefix(p)]), template)


def _whole(value, template) -> Column:
    return _by_axis(lambda p: F.lit(value(p)).cast("long"), template)


def pair_nearest(detected: DataFrame, template: DataFrame, high: float, low: float | None = None) -> DataFrame:
    """Nearest template point of each detected ``(chip, id, x, y)`` within ``(low, high)``."""
    near = near_join(detected, template, int(math.ceil(high)), ("chip",)).withColumn("_d2", square_distance())
    best = (near.groupBy("chip", "id", "x", "y").agg(F.min(F.struct("_d2", "s_ix", "s_iy", "s_x", "s_y")).alias("m"))
            .where(F.col("m._d2") < high * high))
    if low is not None:
        best = best.where(F.col("m._d2") > low * low)
    return best.select("chip", "id", "x", "y", F.col("m.s_ix").alias("ix"), F.col("m.s_iy").alias("iy"),
                       F.col("m.s_x").alias("tx"), F.col("m.s_y").alias("ty"), F.sqrt("m._d2").alias("dist"))


def nominal_fov_locations(track: DataFrame, step: int) -> DataFrame:
    return track.select("chip", "fov_row", "fov_col").distinct().withColumns(
        {"x": F.col("fov_col") * step, "y": F.col("fov_row") * step})


def nearest_fov(points: DataFrame, fov_loc: DataFrame, pitch: int) -> DataFrame:
    """Field of view owning each point: nearest origin, stepped back when the point lies before it."""
    hit = nearest_site(points, fov_loc, ("chip",), pitch, ("fov_row", "fov_col", "x", "y"))
    back = lambda p, s, idx: F.col(idx) - (F.col(p) < F.col(s)).cast("long")
    return hit.select(*points.columns, back("y", "s_y", "s_fov_row").alias("fov_row"),
                      back("x", "s_x", "s_fov_col").alias("fov_col"))


def fov_error(pairs: DataFrame, fov_loc: DataFrame, pitch: int) -> DataFrame:
    """Mean pairing distance per field of view, -1 where nothing pairs."""
    owned = nearest_fov(pairs.select("chip", "id", "x", "y", "dist"), fov_loc, pitch)
    mean = owned.groupBy("chip", "fov_row", "fov_col").agg(F.avg("dist").alias("_e"))
    return (fov_loc.join(mean, ["chip", "fov_row", "fov_col"], "left")
            .withColumn("error", F.coalesce("_e", F.lit(-1.0))).drop("_e"))


def align_rank(template: DataFrame, shape, anchor, point00, corner=(0.0, 0.0)) -> DataFrame:
    """Offset per quarter turn from the zero-index template point nearest the anchor."""
    turns = None
    for n in range(4):
        t = geometry.rot90_points(template, shape, n).withColumn("rot", F.lit(n).cast("long"))
        turns = t if turns is None else turns.unionByName(t)
    x, y = F.col("x") - corner[0], F.col("y") - corner[1]
    zero = turns.where((F.col("ix") == 0) & (F.col("iy") == 0) & (x > 0) & (y > 0))
    dist = F.sqrt((x - anchor[0]) ** 2 + (y - anchor[1]) ** 2)
    best = zero.groupBy("chip", "rot").agg(F.min(F.struct(F.round(dist, 9).alias("dist"), "x", "y")).alias("m"))
    return best.select("chip", "rot", (F.lit(point00[0]) - F.col("m.x")).alias("offset_x"),
                       (F.lit(point00[1]) - F.col("m.y")).alias("offset_y"), F.col("m.dist").alias("dist"))


def template_index(points: DataFrame, zero_x: Column | str, zero_y: Column | str, k: int = 9) -> DataFrame:
    """Cyclic index of each lattice point from the rank of its distinct coordinates."""
    def ranks(axis):
        return points.select("chip", axis).distinct().withColumn(
            f"r{axis}", F.dense_rank().over(Window.partitionBy("chip").orderBy(axis)))
    rx, ry = ranks("x"), ranks("y")
    zx = rx.where(F.col("x") == zero_x).select("chip", F.col("rx").alias("zx"))
    zy = ry.where(F.col("y") == zero_y).select("chip", F.col("ry").alias("zy"))
    return (points.join(rx.join(zx, "chip"), ["chip", "x"]).join(ry.join(zy, "chip"), ["chip", "y"])
            .withColumn("ix", F.pmod(F.col("rx") - F.col("zx"), F.lit(k)).cast("long"))
            .withColumn("iy", F.pmod(F.col("ry") - F.col("zy"), F.lit(k)).cast("long"))
            .drop("rx", "ry", "zx", "zy"))


def axis_marginals(dnb: DataFrame) -> DataFrame:
    """Row and column sums in one pass: ``(chip, axis, pos, total)``."""
    both = dnb.select("chip", "mid", F.explode(F.array(
        F.struct(F.lit("x").alias("axis"), F.col("x").alias("pos")),
        F.struct(F.lit("y").alias("axis"), F.col("y").alias("pos")))).alias("m"))
    return both.groupBy("chip", "m.axis", "m.pos").agg(F.sum("mid").cast("long").alias("total"))


def mass_center(dnb: DataFrame, key: str = "chip", w: str = "mid") -> DataFrame:
    total = F.sum(w)
    return dnb.groupBy(key).agg((F.sum(F.col("x") * F.col(w)) / total).alias("x"),
                                (F.sum(F.col("y") * F.col(w)) / total).alias("y"))


def track_valley(marginals: DataFrame, find_range: int | None = None, center: DataFrame | None = None,
                 template=TEMPLATE) -> DataFrame:
    """Offset of the quietest track lines per chip and axis.

    Every shift of the offsets in ``template`` (steps along x, steps along y) is a
    candidate; the first smallest sum wins, and the result sits one past that shift.
    """
    length = marginals.groupBy("chip", "axis").agg((F.max("pos") + 1).alias("_n"))
    if find_range is not None:
        mid = small(center.unpivot(["chip"], ["x", "y"], "axis", "_c"))
        start = F.rint("_c").cast("long") - find_range
        length = length.join(mid, ["chip", "axis"]).select(
            "chip", "axis", F.least(F.col("_n") - start, F.lit(2 * find_range)).alias("_n"), start.alias("_o"))
        marginals = marginals.join(mid, ["chip", "axis"]).withColumn("pos", F.col("pos") - start).where(
            (F.col("pos") >= 0) & (F.col("pos") < 2 * find_range))
    else:
        length = length.withColumn("_o", F.lit(0).cast("long"))
    last = F.col("_n") - _whole(lambda p: sum(p[:-1]), template) - 1
    cand = length.withColumn("_m", last).where("_m >= 1").select("chip", "axis", F.explode(F.sequence(
        F.lit(1).cast("long"), F.col("_m"))).alias("shift"))
    hits = (marginals.withColumn("shift", F.explode(F.transform(_offsets(template), lambda p: F.col("pos") - p)))
            .groupBy("chip", "axis", "shift").agg(F.sum("total").alias("_t")))
    best = (cand.join(hits, ["chip", "axis", "shift"], "left")
            .groupBy("chip", "axis").agg(F.min(F.struct(F.coalesce("_t", F.lit(0)).alias("t"), "shift")).alias("m")))
    return best.join(length.select("chip", "axis", "_o"), ["chip", "axis"]).select(
        "chip", "axis", (F.col("m.shift") + 1 + F.col("_o")).alias("first"), F.col("m.t").cast("long").alias("total"))


def cyclic_positions(first: DataFrame, template=TEMPLATE) -> DataFrame:
    """Track positions and indices along one axis from ``(chip, axis, first, length)``."""
    period, lines = _whole(sum, template), _whole(len, template)
    lower = F.ceil(F.col("first") / period) * lines
    upper = F.ceil((F.col("length") - F.col("first")) / period) * lines
    steps = first.select("chip", "axis", "first", "length", period.alias("_period"), lines.alias("_lines"),
                         F.explode(F.sequence(-lower, upper)).alias("k"))
    idx = F.pmod(F.col("k"), F.col("_lines"))
    offset = F.element_at(_offsets(template), (idx + 1).cast("int"))
    return (steps.withColumn("pos", F.col("first") + F.floor(F.col("k") / F.col("_lines")) * F.col("_period") + offset)
            .where((F.col("pos") >= 0) & (F.col("pos") <= F.col("length")))
            .select("chip", "axis", F.col("pos").cast("long").alias("pos"), idx.cast("long").alias("idx")))


def template_lattice(positions: DataFrame) -> DataFrame:
    """Template points: every column position with every row position of a chip."""
    xs = positions.where("axis = 'x'").select("chip", F.col("pos").alias("x"), F.col("idx").alias("ix"))
    ys = positions.where("axis = 'y'").select("chip", F.col("pos").alias("y"), F.col("idx").alias("iy"))
    return xs.join(ys, "chip").select("chip", "x", "y", "ix", "iy")


def chip_box_from_expression(dnb: DataFrame, box: int, support: int = 10, step: int = 4) -> DataFrame:
    """Position of the ``box``-sized square that covers most supported grid cells.

    A grid cell counts when a spot lies within ``support`` pixels of its centre.
    A spot is the run of grid columns it supports in each of its few grid rows.
    What a box covers is, along x, piecewise linear with four bends per run of
    grid cells and, along y, a step up and a step down per row.  Only these
    events are summed: first down the columns, then along the rows, where the
    ends of the linear pieces are the candidates.  The first best in row-major
    order wins.  The search is exact.
    """
    side = box // step
    half = step // 2
    low = lambda c: F.ceil((F.col(c) - (support + half)) / step).cast("long")
    high = lambda c: F.floor((F.col(c) + (support - half)) / step).cast("long")
    spots = dnb.where(low("y") <= high("y")).select("chip", F.explode(F.sequence(low("y"), high("y"))).alias("gy"),
                                                    low("x").alias("x0"), high("x").alias("x1"))
    cover = merge_runs(spots.where("x0 <= x1"), ("chip", "gy")).withColumnsRenamed({"x0": "g0", "x1": "g1"})
    grid = dnb.groupBy("chip").agg(F.floor((F.max("x") + 1) / step).cast("long").alias("_gw"),
                                   F.floor((F.max("y") + 1) / step).cast("long").alias("_gh"))
    last = small(grid.select("chip", "_gw", "_gh", (F.col("_gw") - side - 1).alias("_lx"), (F.col("_gh") - side - 1).alias("_ly"))
                 .where("_lx >= 0 and _ly >= 0"))
    cover = (cover.join(last, "chip").withColumn("g0", F.greatest("g0", F.lit(0)))
             .withColumn("g1", F.least("g1", F.col("_gw") - 1)).where("g0 <= g1 and gy >= 0 and gy < _gh"))
    event = lambda at, w: F.struct(at.cast("long").alias("at"), F.lit(w).cast("long").alias("w"))
    bends = F.array(event(F.col("g0") - side + 1, 1), event(F.col("g1") - side + 2, -1), event(F.col("g0") + 1, -1), event(F.col("g1") + 2, 1))
    steps = F.array(event(F.greatest(F.lit(0), F.col("gy") - side + 1), 1), event(F.col("gy") + 1, -1))
    events = (cover.withColumn("s", F.explode(steps)).where("s.at <= _ly").withColumn("b", F.explode(bends)).where("b.at <= _lx")
              .groupBy("chip", "_lx", "_ly", F.greatest(F.lit(0), F.col("b.at")).alias("bx"), F.col("s.at").alias("by"))
              .agg(F.sum(F.col("s.w") * F.col("b.w")).alias("w"), F.sum(F.col("s.w") * F.col("b.w") * F.col("b.at")).alias("wa")))
    down = Window.partitionBy("chip", "bx").orderBy("by")
    columns = (events.select("chip", "_lx", "bx", "by", F.sum("w").over(down).alias("w"), F.sum("wa").over(down).alias("wa"),
                             F.coalesce(F.lead("by").over(down) - 1, F.col("_ly")).alias("end"))
               .where("w != 0 or wa != 0").withColumn("by", F.explode(F.sequence("by", "end"))))
    along = Window.partitionBy("chip", "by").orderBy("bx")
    pieces = columns.select("chip", "by", "bx", F.sum("w").over(along).alias("w"), F.sum("wa").over(along).alias("wa"),
                            F.coalesce(F.lead("bx").over(along) - 1, F.col("_lx")).alias("end"))
    at = (pieces.withColumn("x", F.explode(F.array("bx", "end")))
          .select("chip", (F.col("w") * (F.col("x") + 1) - F.col("wa")).alias("t"), "by", F.col("x").alias("bx")))
    zero = F.lit(0).cast("long")
    best = (at.unionByName(last.select("chip", zero.alias("t"), zero.alias("by"), zero.alias("bx")))
            .groupBy("chip").agg(F.max(F.struct("t", (-F.col("by")).alias("ny"), (-F.col("bx")).alias("nx"))).alias("m")))
    return best.select("chip", (-F.col("m.nx") * step).alias("x"), (-F.col("m.ny") * step).alias("y"),
                       F.col("m.t").cast("long").alias("covered"))


def max_filter(pixels: DataFrame, k: int, key: str = "img", size: int = TILE) -> DataFrame:
    """Grey dilation with a square of ``2 k + 1`` pixels; a pixel goes to the tiles within ``k``, in one shuffle."""

    def one(name: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(name[1]), int(name[2])
        # the larger of repeated pixels is painted last
        v, have = paint_pixels(pdf.sort_values("v"), ty, tx, k, size)
        low = v.min()
        v = np.where(have, v, low)
        for axis in (0, 1):
            take = [np.take(m, range(i, i + size), axis=axis) for m in (v, have) for i in range(2 * k + 1)]
            v, have = np.maximum.reduce(take[:2 * k + 1]), np.logical_or.reduce(take[2 * k + 1:])
        y, x = np.nonzero(have)
        return pd.DataFrame({key: [name[0]] * len(y), "y": y + ty * size, "x": x + tx * size, "v": v[y, x]})

    spread = [range(-k, k, size), [k]]
    reach = lambda c: tiles_of(F.col(c), [d for part in spread for d in part], size)
    sent = pixels.withColumn("_ty", F.explode(reach("y"))).withColumn("_tx", F.explode(reach("x")))
    kind = {f.name: f.dataType.simpleString() for f in pixels.schema}
    return sent.select(key, "_ty", "_tx", "y", "x", "v").groupBy(key, "_ty", "_tx").applyInPandas(
        one, f"`{key}` {kind[key]}, y long, x long, v {kind['v']}")


def _candidates(candidates) -> Column:
    return F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("rot", "dx", "dy"), c)])
                     for c in candidates])


def _tile_scores(fixed: DataFrame, moving: DataFrame, candidates, method: str, shape: tuple[int, int],
                 size: int) -> DataFrame:
    """``(img, c, s)``: what the pixels of each tile that meet add to candidate number ``c``.

    A turned pixel goes once to each tile that a candidate moves it to, a few tiles however many candidates there
    are, and each candidate is scored in the tile by looking its pixels up in the fixed image.
    """
    moves = np.array([tuple(c) for c in candidates], np.int64).reshape(-1, 3)
    h, w = shape
    turns = {0: lambda x, y: (x, y), 1: lambda x, y: (h - y, x), 2: lambda x, y: (w - x, h - y), 3: lambda x, y: (y, w - x)}
    x, y = F.col("x").cast("long"), F.col("y").cast("long")
    turned = [F.struct(F.lit(r).alias("rot"), turns[r](x, y)[0].alias("x"), turns[r](x, y)[1].alias("y"))
              for r in np.unique(moves[:, 0]).tolist()]
    sent = (moving.select("img", F.explode(F.array(*turned)).alias("p"), F.col("v").alias("b")).select("img", "p.*", "b")
            .withColumn("tx", F.explode(tiles_of(F.col("x"), moves[:, 1].tolist(), size)))
            .withColumn("ty", F.explode(tiles_of(F.col("y"), moves[:, 2].tolist(), size))))
    held = fixed.select("img", bucket(F.col("y"), size).alias("ty"), bucket(F.col("x"), size).alias("tx"), "y", "x", "v")

    def one(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        sums = []
        if len(a) and len(b):
            ty, tx = int(key[1]), int(key[2])
            v, have = paint_pixels(a, ty, tx, 0, size)
            by_turn = {r: (p["x"].to_numpy() - tx * size, p["y"].to_numpy() - ty * size, p["b"].to_numpy())
                       for r, p in b.groupby("rot")}
            for c, (r, dx, dy) in enumerate(moves.tolist()):
                if r not in by_turn:
                    continue
                px, py, pv = by_turn[r]
                px, py = px + dx, py + dy
                inside = np.flatnonzero((px >= 0) & (px < size) & (py >= 0) & (py < size))
                inside = inside[have[py[inside], px[inside]]]
                at, pv = v[py[inside], px[inside]], pv[inside]
                if len(at):
                    sums.append((key[0], c, (at * pv if method == "product" else np.abs(at - pv) - at - pv).sum()))
        return pd.DataFrame(sums, columns=["img", "c", "s"])

    kind = {f.name: f.dataType.simpleString() for f in fixed.schema}
    whole = {"tinyint", "smallint", "int", "bigint"}
    total = "long" if {kind["v"], moving.schema["v"].dataType.simpleString()} <= whole else "double"
    wide = lambda df, name: df.withColumn(name, F.col(name).cast(total))
    keys = ["img", "ty", "tx"]
    return wide(held, "v").groupBy(*keys).cogroup(wide(sent, "b").groupBy(*keys)).applyInPandas(
        one, f"img {kind['img']}, c long, s {total}")


def align_score(fixed: DataFrame, moving: DataFrame, candidates, method: str = "product",
                shape: tuple[int, int] | None = None, size: int = TILE) -> DataFrame:
    """Score every ``(rot, dx, dy)`` candidate of a moving image; images hold one row for each pixel of a position.

    ``product`` sums a*b over the overlap (larger is better, 0 without overlap); ``absdiff`` sums
    abs(a - dilate9(b)) over the joint frame (smaller is better), using
    abs(a - b) = a + b + (abs(a - b) - a - b) so only matching pixels meet.
    """
    if method == "absdiff":
        moving = cut(max_filter(moving, 4))
    met = (_tile_scores(fixed, moving, candidates, method, shape or (0, 0), size)
           .groupBy("img", "c").agg(F.sum("s").alias("_s")))
    sums = (fixed.groupBy("img").agg(F.sum("v").alias("_a"))
            .join(moving.groupBy("img").agg(F.sum("v").alias("_b")), "img"))
    rest = F.lit(0) if method == "product" else F.col("_a") + F.col("_b")
    return (sums.select("*", F.posexplode(_candidates(candidates)).alias("_at", "m"))
            .withColumn("c", F.col("_at").cast("long")).join(met, ["img", "c"], "left")
            .select("img", F.col("m.rot").alias("rot"), F.col("m.dx").alias("dx"), F.col("m.dy").alias("dy"),
                    (rest + F.coalesce("_s", F.lit(0))).cast("long").alias("score")))


def best_alignment(scores: DataFrame, method: str = "product") -> DataFrame:
    """Best candidate per image; ties go to the first turn and offset."""
    sign = 1 if method == "product" else -1
    order = F.struct((F.col("score") * sign).alias("s"), *[(-F.col(c)).alias(c) for c in ("rot", "dx", "dy")])
    best = scores.groupBy("img").agg(F.max(order).alias("m"))
    return best.select("img", *[(-F.col(f"m.{c}")).alias(c) for c in ("rot", "dx", "dy")],
                       (F.col("m.s") * sign).alias("score"))


def normalized_correlation(a: DataFrame, b: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """Centred cross product over the uncentred norms, 0 for blank images; absent pixels are 0."""
    n = float(shape[0] * shape[1])
    va = a.groupBy("img").agg(F.sum("v").alias("sa"), F.sum(F.col("v") * F.col("v")).alias("saa"))
    vb = b.groupBy("img").agg(F.sum("v").alias("sb"), F.sum(F.col("v") * F.col("v")).alias("sbb"))
    ab = (a.join(b.withColumnRenamed("v", "w"), ["img", "y", "x"])
          .groupBy("img").agg(F.sum(F.col("v") * F.col("w")).alias("sab")))
    norm = F.sqrt(F.col("saa")) * F.sqrt(F.col("sbb"))
    num = F.coalesce("sab", F.lit(0)) - F.col("sa") * F.col("sb") / n
    return (va.join(vb, "img").join(ab, "img", "left")
            .select("img", F.when(norm < 1e-4, 0.0).otherwise(num / norm).alias("ncc")))


def median_offset(pairs: DataFrame) -> DataFrame:
    """Negative median displacement of paired points."""
    med = lambda d, s: F.percentile(F.col(d) - F.col(s), F.lit(0.5))
    return pairs.groupBy("chip").agg((-med("x", "tx")).alias("dx"), (-med("y", "ty")).alias("dy"))


def line_angle(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy(*keys).agg(F.degrees(F.atan(F.regr_slope("y", "x"))).alias("angle"))


def template_eval(detected: DataFrame, template: DataFrame, pair_thr: float = 10, qc_thr: float = 5,
                  min_recall: float = 0.5) -> DataFrame:
    """Distance statistics and recall of the template fit per chip."""
    near = pair_nearest(detected, template, max(pair_thr, qc_thr))
    pairs = near.groupBy("chip").agg(
        F.avg(F.when(F.col("dist") < pair_thr, F.col("dist"))).alias("mean"),
        F.stddev_pop(F.when(F.col("dist") < pair_thr, F.col("dist"))).alias("std"),
        F.sum((F.col("dist") < qc_thr).cast("long")).alias("paired"))
    counts = (detected.groupBy("chip").agg(F.count("*").alias("nd"))
              .join(template.groupBy("chip").agg(F.count("*").alias("nt")), "chip"))
    return counts.join(pairs, "chip", "left").select(
        "chip", "mean", "std", (F.coalesce("paired", F.lit(0)) / F.col("nd")).alias("recall_detected"),
        (F.coalesce("paired", F.lit(0)) / F.col("nt")).alias("recall_template")).withColumn(
        "passed", F.col("recall_detected") > min_recall)


def _hull_area(pdf: pd.DataFrame) -> pd.DataFrame:
    pts = sorted(set(zip(pdf["x"], pdf["y"])))

    def half(seq):
        out = []
        for p in seq:
            while len(out) > 1 and ((out[-1][0] - out[-2][0]) * (p[1] - out[-2][1])
                                    - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ring = np.array(half(pts) + half(pts[::-1]), dtype=float) if len(pts) > 2 else np.zeros((0, 2))
    x, y = ring[:, 0], ring[:, 1]
    area = 0.5 * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))))
    return pd.DataFrame({"chip": [pdf["chip"].iloc[0]], "area": [area]})


def point_cluster_area(points: DataFrame, max_d: float, shape: tuple[int, int], min_n: int = 10) -> DataFrame:
    """Hull area of all points in clusters larger than ``min_n``, over the mosaic area.

    Only the highest and lowest point of each pixel column can be on the hull,
    which bounds what one task receives by the image width.
    """
    tagged = cut(point_components(points, max_d))
    big = tagged.groupBy("chip", "root").agg(F.count("*").alias("n")).where(F.col("n") > min_n)
    kept = tagged.join(big.select("chip", "root"), ["chip", "root"], "left_semi")
    rim = (kept.groupBy("chip", "x").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
           .select("chip", "x", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("y")))
    hull = rim.groupBy("chip").applyInPandas(_hull_area, "chip long, area double")
    return hull.select("chip", (F.col("area") / float(shape[0] * shape[1])).alias("area_ratio"))


def location_model(pairs: DataFrame, key: str = "slide") -> DataFrame:
    """Least-squares map from scope to global locations, solved from sums per slide.

    ``gx = ax*sx + bx*sy + cx`` and the same for ``gy``; where rows or columns do
    not vary the missing slope is 0.
    """
    c = F.col
    agg = pairs.groupBy(key).agg(
        *[F.avg(n).alias(f"m{n}") for n in ("sx", "sy", "gx", "gy")],
        F.covar_pop("sx", "sx").alias("xx"), F.covar_pop("sy", "sy").alias("yy"), F.covar_pop("sx", "sy").alias("xy"),
        *[F.covar_pop(s, g).alias(f"{s}_{g}") for s in ("sx", "sy") for g in ("gx", "gy")])
    det = c("xx") * c("yy") - c("xy") * c("xy")
    out = agg
    for g in ("gx", "gy"):
        full = F.abs(det) > 1e-9
        a = F.when(full, (c(f"sx_{g}") * c("yy") - c(f"sy_{g}") * c("xy")) / det).when(
            c("xx") > 0, c(f"sx_{g}") / c("xx")).otherwise(0.0)
        b = F.when(full, (c(f"sy_{g}") * c("xx") - c(f"sx_{g}") * c("xy")) / det).when(
            (c("yy") > 0) & (c("xx") <= 0), c(f"sy_{g}") / c("yy")).otherwise(0.0)
        out = out.withColumn(f"a_{g}", a).withColumn(f"b_{g}", b)
        out = out.withColumn(f"c_{g}", c(f"m{g}") - c(f"a_{g}") * c("msx") - c(f"b_{g}") * c("msy"))
    return out.select(key, *[f"{k}_{g}" for g in ("gx", "gy") for k in "abc"])


def landmark_fit(pairs: DataFrame) -> DataFrame:
    """Similarity fit per landmark set ``(grp, x, y) -> (u, v)``.

    Centred cross sums give the rotation in closed form and the scale per axis is
    a ratio of norms.  Mirrored sets get a negative scale on the axis that keeps
    the rotation within a quarter turn.
    """
    c = F.col
    mean = small(pairs.groupBy("grp").agg(*[F.avg(n).alias(f"m{n}") for n in "xyuv"]))
    d = pairs.join(mean, "grp").select("grp", *[(c(n) - c(f"m{n}")).alias(n) for n in "xyuv"])
    s = d.groupBy("grp").agg(*[F.sum(c(p) * c(q)).alias(p + q) for p in "xy" for q in "uv"])
    mirrored = c("xu") * c("yv") - c("xv") * c("yu") < 0
    s = s.withColumn("fy", F.when(mirrored & (c("xu") - c("yv") >= 0), -1.0).otherwise(1.0)).withColumn(
        "fx", F.when(mirrored & (c("xu") - c("yv") < 0), -1.0).otherwise(1.0))
    s = small(s.withColumn("rad", F.atan2(c("fy") * c("xv") - c("fx") * c("yu"), c("fx") * c("xu") + c("fy") * c("yv"))))
    r = d.join(s, "grp").withColumns({"rx": c("x") * F.cos("rad") - c("y") * F.sin("rad"),
                                      "ry": c("x") * F.sin("rad") + c("y") * F.cos("rad")})
    norm = lambda p, q: F.sqrt(F.try_divide(F.sum(c(p) * c(p)), F.sum(c(q) * c(q))))
    sc = small(r.groupBy("grp").agg((F.max("fx") * norm("u", "rx")).alias("scale_x"),
                                    (F.max("fy") * norm("v", "ry")).alias("scale_y")))
    return r.join(sc, "grp").groupBy("grp").agg(
        F.max(F.degrees("rad")).alias("angle"), F.max("scale_x").alias("scale_x"), F.max("scale_y").alias("scale_y"),
        F.sum(F.hypot(c("rx") * c("scale_x") - c("u"), c("ry") * c("scale_y") - c("v"))).alias("residual"))


def landmark_fit_triples(pairs: DataFrame) -> DataFrame:
    """Best exact affine over all triples of a hand-picked landmark set.

    Each triple ``i < j < k`` is solved with Cramer's rule; the residual over all
    pairs of the set decides, first triple on ties.
    """
    c = F.col
    p = lambda n: pairs.select("grp", *[F.col(q).alias(f"{q}{n}") for q in ("k", "x", "y", "u", "v")])
    tri = p(1).join(p(2), "grp").where("k1 < k2").join(p(3), "grp").where("k2 < k3")
    det = (c("x1") * (c("y2") - c("y3")) + c("x2") * (c("y3") - c("y1")) + c("x3") * (c("y1") - c("y2")))
    tri = tri.withColumn("det", det).where(F.abs("det") > 1e-9)
    for t in "uv":
        t1, t2, t3 = c(f"{t}1"), c(f"{t}2"), c(f"{t}3")
        tri = tri.withColumn(f"a_{t}", (t1 * (c("y2") - c("y3")) + t2 * (c("y3") - c("y1")) + t3 * (c("y1") - c("y2"))) / c("det"))
        tri = tri.withColumn(f"b_{t}", (t1 * (c("x3") - c("x2")) + t2 * (c("x1") - c("x3")) + t3 * (c("x2") - c("x1"))) / c("det"))
        tri = tri.withColumn(f"c_{t}", t1 - c(f"a_{t}") * c("x1") - c(f"b_{t}") * c("y1"))
    keys = ["k1", "k2", "k3", "a_u", "b_u", "c_u", "a_v", "b_v", "c_v"]
    res = (tri.select("grp", *keys).join(pairs.select("grp", "x", "y", "u", "v"), "grp").groupBy("grp", *keys)
           .agg(F.sum(F.hypot(c("a_u") * c("x") + c("b_u") * c("y") + c("c_u") - c("u"),
                              c("a_v") * c("x") + c("b_v") * c("y") + c("c_v") - c("v"))).alias("residual")))
    best = res.groupBy("grp").agg(F.min(F.struct(F.round("residual", 6).alias("residual"), *keys)).alias("m")).select("grp", "m.*")
    rad_x, rad_y = -F.atan(F.try_divide(c("b_u"), c("a_u"))), F.atan(F.try_divide(c("a_v"), c("b_v")))
    return best.select("grp", "k1", "k2", "k3", "residual",
                       F.try_divide(c("a_u"), F.cos(rad_x)).alias("scale_x"),
                       F.try_divide(c("a_v"), F.sin(rad_y)).alias("scale_y"),
                       F.degrees((rad_x + rad_y) / 2).alias("angle"))


def center_points(points: DataFrame, n: int, keys: tuple[str, ...]) -> DataFrame:
    """The ``n`` points of each group nearest to its mean; adds ``rank``."""
    mean = small(points.groupBy(*keys).agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my")))
    d2 = (F.col("x") - F.col("_mx")) ** 2 + (F.col("y") - F.col("_my")) ** 2
    order = Window.partitionBy(*keys).orderBy(F.round("_d2", 6), "id")
    return (points.join(mean, [*keys]).withColumn("_d2", d2).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= n).drop("_mx", "_my", "_d2"))


def rotate_search(points: DataFrame, keys: tuple[str, ...], search: int = 45, reach: float = 10.0,
                  n: int = 5) -> DataFrame:
    """Most populated line angle per group, by vote of the central points.

    A line through each central point is tried at every whole degree; more hits
    win, then the smaller mean distance, then the smaller angle.
    """
    center = center_points(points, n, keys).select(*keys, "rank", F.col("x").alias("cx"), F.col("y").alias("cy"))
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    tried = deal(points, *keys).join(spread(center), [*keys]).withColumn("angle", F.explode(F.sequence(F.lit(-search), F.lit(search - 1))))
    rad = F.radians("angle")
    dist = F.abs(F.sin(rad) * dx - F.cos(rad) * dy)
    hits = tried.withColumn("d", dist).where(F.round("d", 9) <= reach).groupBy(*keys, "rank", "angle").agg(
        F.count("*").alias("hits"), F.avg("d").alias("mean"))
    best = hits.groupBy(*keys, "rank").agg(F.max(F.struct(
        "hits", (-F.round("mean", 6)).alias("m"), (-F.col("angle")).alias("na"))).alias("b")).select(
        *keys, "rank", (-F.col("b.na")).alias("angle"))
    vote = best.groupBy(*keys, "angle").agg(F.count("*").alias("votes"), F.min("rank").alias("first"))
    top = vote.groupBy(*keys).agg(F.max(F.struct("votes", (-F.col("first")).alias("f"), "angle")).alias("v"))
    a = F.col("v.angle")
    return top.select(*keys, F.when(a < -45, a + 90).when(a > 45, a - 90).otherwise(a).cast("long").alias("angle"),
                      F.col("v.votes").cast("long").alias("votes"))


def _gaps(u: np.ndarray, pitch) -> np.ndarray:
    """Distance of each ``u`` to the nearest line of a lattice that has a line at 0, for each line of the period as that one."""
    lines, period = np.array(track_prefix(pitch), float), float(sum(pitch))
    out = np.empty((len(u), len(lines)))
    for i, start in enumerate(lines):
        gap = np.mod(u[:, None] - (lines - start) + period / 2, period)
        gap -= period / 2
        out[:, i] = np.abs(gap, out=gap).min(axis=1)
    return out


def _lattice_costs(rows: DataFrame, keys: tuple[str, ...], scales: tuple[float, ...], template) -> DataFrame:
    """``(keys, rank, scale, cost, ix, iy)``: the start indices of least cost for each centre and scale.

    ``rows(keys, rank, x, y, cx, cy)`` are sorted by keys and rank in their partitions and pass as a stream: a centre is
    held as its sums, one for each scale and pair of start indices, however many points it has.
    """
    types, by = dict(rows.dtypes), [*keys, "rank"]
    wide = len(template[1])
    size = len(template[0]) * wide

    def best(names: pa.Table, sums: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        cost = np.round(sums, 6)
        at = cost.argmin(axis=2)
        least = np.take_along_axis(cost, at[:, :, None], axis=2).reshape(-1)
        again = np.repeat(np.arange(len(sums)), len(scales))
        columns = [names.column(c).combine_chunks().take(pa.array(again)) for c in by]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.tile(np.array(scales, float), len(sums))), pa.array(least, mask=np.repeat(known == 0, len(scales))),
             pa.array((at.reshape(-1) // wide).astype(np.int32)), pa.array((at.reshape(-1) % wide).astype(np.int32))],
            names=[*by, "scale", "cost", "ix", "iy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sums = known = None  # of the last centre, which may go on
        for batch in batches:
            for a in range(0, batch.num_rows, CHUNK):
                part = pa.Table.from_batches([batch.slice(a, CHUNK)])
                x, y, cx, cy = (part.column(c).cast("double").to_numpy() for c in ("x", "y", "cx", "cy"))
                full = np.logical_and.reduce([part.column(c).is_valid().to_numpy() for c in ("x", "y", "cx", "cy")])
                heads = part.select(by) if names is None else pa.concat_tables([names, part.select(by)])
                first = starts(heads, by)
                own = 0 if names is None else 1
                begin = np.maximum(first - own, 0)  # in the part
                if own and len(first) > 1 and first[1] == 1:
                    begin = begin[1:]  # the centre that was held ended with the last part
                count = np.add.reduceat(full.astype(np.int64), begin)
                total = np.empty((len(begin), len(scales), size))
                for i, s in enumerate(scales):
                    dx, dy = _gaps((x - cx) / s, template[0]), _gaps((y - cy) / s, template[1])
                    cost = np.sqrt((dx * dx)[:, :, None] + (dy * dy)[:, None, :]).reshape(len(x), size) * s
                    cost[~full] = 0
                    total[:, i] = np.add.reduceat(cost, begin)
                if own:
                    if len(begin) == len(first):
                        total[0] += sums
                        count[0] += known
                    else:
                        total, count = np.concatenate([sums[None], total]), np.concatenate([[known], count])
                heads = heads.take(pa.array(first))
                if len(first) > 1:
                    yield best(heads.slice(0, len(first) - 1), total[:-1], count[:-1])
                names, sums, known = heads.slice(len(first) - 1), total[-1], count[-1]
        if names is not None:
            yield best(names, sums[None], np.array([known]))

    head = ", ".join(f"`{c}` {types[c]}" for c in by)
    return rows.mapInArrow(run, f"{head}, scale double, cost double, ix int, iy int")


def scale_search(points: DataFrame, keys: tuple[str, ...], scales: tuple[float, ...], n: int = 3,
                 rate: float = 1.2, template=TEMPLATE) -> DataFrame:
    """Template scale per group, by vote of the central points.

    The template is a lattice, so the distance to its nearest point splits into
    one term per axis, each a modular expression; all scales and all start
    indices are summed up for a centre as its points pass, none is a row.  A
    candidate is valid while its lattice is not much denser than the points.
    """
    center = center_points(points, n, keys).select(*keys, "rank", F.col("x").alias("cx"), F.col("y").alias("cy"))
    box = small(points.groupBy(*keys).agg(F.count("*").alias("_n"), (F.max("x") - F.min("x")).alias("_w"),
                                          (F.max("y") - F.min("y")).alias("_h")))
    tried = deal(points, *keys).join(spread(center), [*keys]).select(*keys, "rank", "x", "y", "cx", "cy")
    cost = _lattice_costs(tried.sortWithinPartitions(*keys, "rank"), keys, scales, template)
    s = F.col("scale")
    step_x, step_y = (sum(p) / len(p) for p in template)
    lattice = (F.floor(F.col("_w") / (s * step_x)) + 1) * (F.floor(F.col("_h") / (s * step_y)) + 1)
    valid = (lattice / F.col("_n") <= rate) | (lattice - F.col("_n") <= 10)
    best = (cost.join(box, [*keys]).where(valid).groupBy(*keys, "rank")
            .agg(F.min(F.struct("cost", "scale", "ix", "iy")).alias("b")))
    vote = best.groupBy(*keys, F.col("b.scale").alias("scale")).agg(
        F.count("*").alias("votes"), F.min(F.struct("rank", "b.ix", "b.iy")).alias("f"))
    top = vote.groupBy(*keys).agg(F.max(F.struct("votes", (-F.col("f.rank")).alias("r"), "scale",
                                                 F.col("f.ix").alias("ix"), F.col("f.iy").alias("iy"))).alias("t"))
    return top.select(*keys, F.col("t.scale").alias("scale"), F.col("t.ix").cast("long").alias("ix"),
                      F.col("t.iy").cast("long").alias("iy"), F.col("t.votes").cast("long").alias("votes"))


def fov_track_score(track: DataFrame, first: int = 5, second: int = 20, good: int = 5) -> DataFrame:
    """Track quality per chip: graded point counts times confidence, and the usual angle."""
    fov = track.groupBy("chip", "fov_row", "fov_col").agg(
        F.count("*").alias("n"), F.avg("conf").alias("conf"), F.min("angle").alias("angle"))
    grade = F.when(F.col("n") >= second, 2).when(F.col("n") >= first, 1).otherwise(0)
    scored = fov.withColumn("_s", grade / 2 * F.col("conf")).withColumn("_good", F.col("n") >= good)
    total = scored.groupBy("chip").agg(F.sum("_s").alias("score"), F.sum(F.col("_good").cast("long")).alias("good_fov"))
    votes = scored.where("_good").groupBy("chip", "angle").agg(F.count("*").alias("_v"))
    mode = votes.groupBy("chip").agg(F.max(F.struct("_v", (-F.col("angle")).alias("na"))).alias("m")).select(
        "chip", (-F.col("m.na")).alias("angle"))
    return total.join(mode, "chip", "left")
