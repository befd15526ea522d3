"""Measures that relate masks, images and tiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.intensity import histogram
from ..plans.buckets import bucket, overlap_pairs, overlap_runs, points_in_runs
from ..plans.islands import area, merge_runs, subtract
from ..plans.tiles import TILE
from ..session import small


def _flat(runs: DataFrame) -> DataFrame:
    return merge_runs(runs.select("chip", "y", "x0", "x1"), ("chip", "y")).withColumn("label", F.lit(1).cast("long"))


def area_ratio(cells: DataFrame, tissue: DataFrame) -> DataFrame:
    """Share of the tissue area covered by cells."""
    t = _flat(tissue)
    shared = overlap_pairs(_flat(cells), t).select("chip", "cnt")
    return area(t, ("chip",)).join(shared, "chip", "left").select(
        "chip", (F.coalesce("cnt", F.lit(0)) / F.col("area")).alias("ratio"))


def intensity_ratio(cells: DataFrame, tissue: DataFrame, pixels: DataFrame) -> DataFrame:
    """Share of the intensity inside tissue that lies in cells; ``pixels(chip, y, x, v)``."""
    inside = points_in_runs(pixels, _flat(tissue).drop("label"), "left_semi")
    marked = points_in_runs(inside, _flat(cells), "left")
    return marked.groupBy("chip").agg((F.coalesce(F.sum(F.when(F.col("label").isNotNull(), F.col("v"))), F.lit(0))
                                       / F.sum("v")).alias("ratio"))


def object_intensity(runs: DataFrame, pixels: DataFrame) -> DataFrame:
    """Mean intensity per object; pixels without a row count as 0."""
    total = points_in_runs(pixels, runs.select("chip", "label", "y", "x0", "x1"), "inner").groupBy(
        "chip", "label").agg(F.sum("v").alias("_s"))
    return area(runs).join(total, ["chip", "label"], "left").select(
        "chip", "label", (F.coalesce("_s", F.lit(0)) / F.col("area")).alias("mean"))


def intensity_histogram(means: DataFrame, width: float) -> DataFrame:
    return means.groupBy("chip", F.floor(F.col("mean") / width).cast("long").alias("bin")).agg(
        F.count("*").alias("n"))


def uncovered_tiles(tissue: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """Tiles of k x k that are all tissue and no cell, and their share of the tissue."""
    bare = subtract(_flat(tissue), cells)
    cut_x = bare.withColumn("tx", F.explode(F.sequence(bucket("x0", k), bucket("x1", k))))
    n = F.least("x1", F.col("tx") * k + (k - 1)) - F.greatest("x0", F.col("tx") * k) + 1
    full = (cut_x.groupBy("chip", bucket("y", k).alias("ty"), "tx").agg(F.sum(n).alias("n"))
            .where(F.col("n") == k * k).groupBy("chip").agg(F.count("*").alias("tiles")))
    return area(_flat(tissue), ("chip",)).join(full, "chip", "left").select(
        "chip", F.coalesce("tiles", F.lit(0)).cast("long").alias("tiles"),
        (F.coalesce("tiles", F.lit(0)) * (k * k) / F.col("area")).alias("missing_ratio"))


def clarity_counts(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("img", "cls").agg(F.count("*").alias("n"))


# Weight of each clarity class in the six- and the four-class model.
CLARITY_6 = {0: 0.0, 1: 1.0, 2: 0.2, 3: 0.0, 4: 0.9, 5: 0.0}
CLARITY_4 = {0: 0.0, 1: 0.0, 2: 1.0, 3: 0.0}


def clarity_score(tiles: DataFrame, weights: dict[int, float] = CLARITY_6) -> DataFrame:
    """Weighted share of tiles, class 0 (black) left out; 0 where nothing counts."""
    w = F.coalesce(*[F.when(F.col("cls") == k, F.lit(v)) for k, v in weights.items()], F.lit(0.0))
    known = F.col("cls").isin(*weights)
    agg = clarity_counts(tiles.where(known)).groupBy("img").agg(
        F.sum(w * F.col("n")).alias("_s"), F.sum(F.when(F.col("cls") != 0, F.col("n")).otherwise(0)).alias("_t"))
    return agg.select("img", F.coalesce(F.try_divide(F.col("_s"), F.col("_t").cast("double")), F.lit(0.0)).alias("score"))


def _cumulative(hist: DataFrame) -> DataFrame:
    """Histogram rows with running counts and the totals of their image."""
    up = Window.partitionBy("img").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("img")
    p = hist.withColumn("total", F.sum("n").over(whole)).withColumn("moment", F.sum(F.col("n") * F.col("v")).over(whole))
    return p.withColumn("w0", F.sum("n").over(up)).withColumn("s0", F.sum(F.col("n") * F.col("v")).over(up))


def hist_threshold(pixels: DataFrame, method: str) -> DataFrame:
    """Threshold per image from its value histogram (at most 256 rows per image).

    mean, otsu, yen and entropy are windows over the histogram; li, isodata,
    minimum, triangle and shanbhag iterate on the 256 counts of one image.
    """
    hist = histogram(pixels)
    if method == "mean":
        return hist.groupBy("img").agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("theta"))
    c = F.col
    first = lambda score: F.max(F.struct(F.round(score, 9).alias("s"), (-c("v")).alias("nv")))
    if method == "otsu":
        t = _cumulative(hist).where("w0 < total")
        gap = c("s0") / c("w0") - (c("moment") - c("s0")) / (c("total") - c("w0"))
        score = c("w0") / c("total") * ((c("total") - c("w0")) / c("total")) * gap * gap
    elif method == "yen":
        up = Window.partitionBy("img").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        q = _cumulative(hist).withColumn("p", c("n") / c("total"))
        q = q.withColumn("q0", F.sum(c("p") * c("p")).over(up)).withColumn(
            "q", F.sum(c("p") * c("p")).over(Window.partitionBy("img")))
        t = q.where((c("w0") < c("total")) & (c("q") - c("q0") > 1e-15))
        p0 = c("w0") / c("total")
        score = F.log(p0 * p0 * (1 - p0) * (1 - p0) / (c("q0") * (c("q") - c("q0"))))
    elif method == "entropy":
        up = Window.partitionBy("img").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        e = _cumulative(hist).withColumn("e", c("n") * F.log(c("n").cast("double")))
        e = e.withColumn("e0", F.sum("e").over(up)).withColumn("ent", F.sum("e").over(Window.partitionBy("img")))
        t = e.where("w0 < total")
        score = (F.log(c("w0").cast("double")) - c("e0") / c("w0")
                 + F.log((c("total") - c("w0")).cast("double")) - (c("ent") - c("e0")) / (c("total") - c("w0")))
    else:
        fn = _ITERATIVE[method]

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            h = np.zeros(256)
            np.add.at(h, pdf["v"].to_numpy(), pdf["n"].to_numpy())
            return pd.DataFrame({"img": [pdf["img"].iloc[0]], "theta": [float(fn(h))]})

        return hist.groupBy("img").applyInPandas(one, "img long, theta double")
    best = t.groupBy("img").agg(first(score).alias("m"))
    return best.select("img", (-c("m.nv")).cast("double").alias("theta"))


def _li(h: np.ndarray) -> float:
    """Minimum cross entropy by fixed-point iteration, shifted to start at the minimum."""
    v = np.arange(256.0) - np.nonzero(h)[0][0]
    t, last = (h * v).sum() / h.sum(), -1.0
    while abs(t - last) > 0.5:
        last, low = t, v <= t
        a = (h * v)[low].sum() / max(h[low].sum(), 1.0)
        b = (h * v)[~low].sum() / max(h[~low].sum(), 1.0)
        if a <= 0 or b <= 0 or a == b:
            break
        t = (b - a) / (np.log(b) - np.log(a))
    return t + np.nonzero(h)[0][0]


def _isodata(h: np.ndarray) -> float:
    """Smallest value that is the midpoint of the means on both of its sides."""
    v, n = np.arange(256.0), np.cumsum(h)
    s = np.cumsum(h * v)
    for t in range(255):
        if 0 < n[t] < n[-1] and np.floor((s[t] / n[t] + (s[-1] - s[t]) / (n[-1] - n[t])) / 2) == t:
            return float(t)
    return float(np.nonzero(h)[0][0])


def _minimum(h: np.ndarray) -> float:
    """Valley between the last two peaks left by repeated three-point smoothing."""
    f = h.astype(float)
    for _ in range(10000):
        peaks = [i for i in range(1, 255) if f[i - 1] < f[i] >= f[i + 1]]
        if len(peaks) <= 2:
            break
        f = np.convolve(np.pad(f, 1, mode="edge"), np.ones(3) / 3, mode="valid")
    if len(peaks) != 2:
        return float("nan")
    return float(peaks[0] + np.argmin(f[peaks[0]:peaks[1] + 1]))


def _triangle(h: np.ndarray) -> float:
    """Farthest histogram bar from the line between the peak and the longer tail."""
    used = np.nonzero(h)[0]
    lo, hi, peak = used[0], used[-1], int(np.argmax(h))
    flip = peak - lo < hi - peak
    g = h[::-1] if flip else h
    top, start = (255 - peak, 255 - hi) if flip else (peak, lo)
    if top == start:
        return float(peak)
    x = np.arange(start, top + 1)
    dist = (x - start) * g[top] / (top - start) - g[x]
    t = int(x[np.argmax(dist)])
    return float(255 - t if flip else t)


def _shanbhag(h: np.ndarray) -> float:
    """Level at which both sides carry the same fuzzy information."""
    p = h / h.sum()
    below = np.cumsum(p)
    best, theta = np.inf, 0
    for t in range(255):
        if below[t] <= 1e-12 or 1 - below[t] <= 1e-12:
            continue
        lo = -sum(p[i] * np.log(1 - 0.5 / below[t] * below[i - 1]) for i in range(1, t + 1) if below[i - 1] > 0)
        up = 1 - below
        hi = -sum(p[i] * np.log(1 - 0.5 / up[t] * up[i]) for i in range(t + 1, 256))
        gap = abs(0.5 / below[t] * lo - 0.5 / up[t] * hi)
        if gap < best:
            best, theta = gap, t
    return float(theta)


_ITERATIVE = {"li": _li, "isodata": _isodata, "minimum": _minimum, "triangle": _triangle, "shanbhag": _shanbhag}


def threshold_mask(pixels: DataFrame, theta: DataFrame) -> DataFrame:
    return pixels.join(small(theta), "img").where(F.col("v") > F.col("theta")).select("img", "y", "x")


def local_threshold(pixels: DataFrame, w: int = 15, k: float = 0.2, r: float = 128.0, size: int = TILE) -> DataFrame:
    """Pixels above ``mean * (1 + k (std / r - 1))`` of the w x w window around them.

    Window sums come from summed-area tables of halo tiles; pixels without a row
    and pixels outside the image count as 0.
    """
    half = w // 2

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        img, ty, tx = (int(v) for v in key)
        a = np.zeros((size + 2 * half, size + 2 * half))
        a[pdf["y"].to_numpy() - (ty * size - half), pdf["x"].to_numpy() - (tx * size - half)] = pdf["v"].to_numpy()

        def window(z):
            c = np.pad(z.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
            return c[w:, w:] - c[:-w, w:] - c[w:, :-w] + c[:-w, :-w]

        mean = window(a) / (w * w)
        std = np.sqrt(np.maximum(window(a * a) / (w * w) - mean * mean, 0))
        own = a[half:half + size, half:half + size]
        y, x = np.nonzero(own > mean * (1 + k * (std / r - 1)))
        return pd.DataFrame({"img": img, "y": y + ty * size, "x": x + tx * size})

    tiles = (pixels.withColumn("ty", F.explode(F.sequence(bucket(F.col("y") - half, size), bucket(F.col("y") + half, size))))
             .withColumn("tx", F.explode(F.sequence(bucket(F.col("x") - half, size), bucket(F.col("x") + half, size)))))
    return tiles.groupBy("img", "ty", "tx").applyInPandas(one, "img long, y long, x long")


def cluster_report(obs: DataFrame, size: int = 10) -> DataFrame:
    """Binned position of each cell with its cluster, and the cluster's size."""
    n = small(obs.groupBy("chip", "cluster").agg(F.count("*").alias("cluster_size")))
    order = Window.partitionBy("chip").orderBy(F.col("cluster").cast("long"))
    ranked = n.withColumn("cluster_rank", F.dense_rank().over(order).cast("long"))
    return obs.join(ranked, ["chip", "cluster"]).select(
        "chip", "cell_id", "cluster", "cluster_rank", "cluster_size", bucket("cx", size).alias("bx"), bucket("cy", size).alias("by"))
