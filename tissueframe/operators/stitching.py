"""Field-of-view offsets: cleaning, consensus, errors and locations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import deal, small, spread

KEYS = ("slide", "axis")


def _midpoint_quartiles(values: DataFrame, col: str) -> DataFrame:
    """First and third quartile as the mean of the two neighbouring order statistics.

    Works on distinct values with counts, so equal offsets are combined before
    the shuffle.
    """
    counts = values.groupBy(*KEYS, F.col(col).alias("val")).agg(F.count("*").alias("n"))
    up = Window.partitionBy(*KEYS).orderBy("val")
    c = (counts.withColumn("hi", F.sum("n").over(up)).withColumn("total", F.sum("n").over(Window.partitionBy(*KEYS)))
         .withColumn("lo", F.col("hi") - F.col("n")))
    def at(q, fn):
        i = fn(F.lit(q) * (F.col("total") - 1))
        return F.max(F.when((i >= F.col("lo")) & (i < F.col("hi")), F.col("val")))
    return c.groupBy(*KEYS).agg(F.max("total").alias("total"),
                                ((at(0.25, F.floor) + at(0.25, F.ceil)) / 2.0).alias("q1"),
                                ((at(0.75, F.floor) + at(0.75, F.ceil)) / 2.0).alias("q3"))


def filter_abnormal_offset(jitter: DataFrame, conf_thr: int = 2) -> DataFrame:
    """Null offsets outside the interquartile fence, component after component.

    Rows with more than three times the confidence threshold get a fence wider
    by 0.6 of the range.  A rejected row loses both components and its confidence.
    """
    for comp in ("dx", "dy"):
        quart = _midpoint_quartiles(jitter.where(F.col(comp).isNotNull() & (F.col("conf") > conf_thr)), comp)
        rng = F.col("q3") - F.col("q1")
        iqr = F.when(rng > 5, rng).otherwise(rng + 3)
        fence = small(quart.where("total > 3").select(*KEYS, (F.col("q1") - 1.5 * iqr).alias("_lo"),
                                                  (F.col("q3") + 1.5 * iqr).alias("_hi"), (0.6 * iqr).alias("_wide")))
        slack = F.when(F.col("conf") > conf_thr * 3, F.col("_wide")).otherwise(0.0)
        bad = F.coalesce((F.col(comp) > F.col("_hi") + slack) | (F.col(comp) < F.col("_lo") - slack), F.lit(False))
        jitter = (jitter.join(fence, [*KEYS], "left").withColumn("_bad", bad)
                  .select("slide", "r", "c", "axis", F.when(~F.col("_bad"), F.col("dx")).alias("dx"),
                          F.when(~F.col("_bad"), F.col("dy")).alias("dy"),
                          F.when(F.col("_bad"), 0).otherwise(F.col("conf")).alias("conf")))
    return jitter


def jitter_consensus(jitter: DataFrame, gap: int = 10, share: float = 0.1) -> DataFrame:
    """Keep offsets whose value belongs to a cluster holding at least ``share`` of the rows.

    Clusters are chains of distinct values at most ``gap`` apart.  A row keeps its
    offset only if both components survive.
    """
    kept = {}
    for comp in ("dx", "dy"):
        counts = (jitter.where(F.col(comp).isNotNull()).groupBy(*KEYS, F.col(comp).alias("val"))
                  .agg(F.count("*").alias("n")))
        order = Window.partitionBy(*KEYS).orderBy("val")
        start = F.when(F.col("val") - F.lag("val").over(order) <= gap, 0).otherwise(1)
        isl = counts.withColumn("_s", start).withColumn("_isl", F.sum("_s").over(order))
        size = F.sum("n").over(Window.partitionBy(*KEYS, "_isl"))
        total = F.sum("n").over(Window.partitionBy(*KEYS))
        kept[comp] = small(isl.withColumn("_k", size).withColumn("_t", total).where(F.col("_k") >= share * F.col("_t"))
                           .select(*KEYS, F.col("val").alias(comp), F.lit(True).alias(f"_{comp}")))
    out = jitter.join(kept["dx"], [*KEYS, "dx"], "left").join(kept["dy"], [*KEYS, "dy"], "left")
    ok = F.col("_dx").isNotNull() & F.col("_dy").isNotNull()
    return out.select("slide", "r", "c", "axis", F.when(ok, F.col("dx")).alias("dx"),
                      F.when(ok, F.col("dy")).alias("dy"), "conf")


def stitch_error(jitter: DataFrame, w: int, h: int, overlap: float = 0.1) -> DataFrame:
    """Residual offset per field of view after the nominal overlap; -1 where missing."""
    dx = F.col("dx") + F.when(F.col("axis") == "h", int(w * overlap)).otherwise(0)
    dy = F.col("dy") + F.when(F.col("axis") == "v", int(h * overlap)).otherwise(0)
    e = jitter.withColumn("_e", F.coalesce(F.floor(F.hypot(dx.cast("double"), dy.cast("double"))), F.lit(-1)).cast("long"))
    one = lambda a: F.max(F.when(F.col("axis") == a, F.col("_e")).otherwise(F.lit(-1))).cast("long")
    return e.groupBy("slide", "r", "c").agg(F.max("_e").alias("error"), one("h").alias("h_error"), one("v").alias("v_error"))


def snake_reorder(fov: DataFrame, rows: int, cols: int, start: str = "RD") -> DataFrame:
    """Scan index ``k`` of a row-wise snake to (row, column) for one of four start corners."""
    r, c = F.floor(F.col("k") / cols), F.col("k") % cols
    c = F.when(r % 2 == 1, cols - c - 1).otherwise(c)
    if "L" in start:
        c = cols - c - 1
    if "U" in start:
        r = rows - r - 1
    return fov.withColumns({"r": r.cast("long"), "c": c.cast("long")})


def mechanical_location(fov: DataFrame, w: int, h: int, overlap: float = 0.1) -> DataFrame:
    """Nominal location of every field of view ``(slide, r, c)``."""
    return fov.select("slide", "r", "c", (F.col("c") * (w - int(w * overlap))).cast("long").alias("x"),
                      (F.col("r") * (h - int(h * overlap))).cast("long").alias("y"))


def line_scan_location(fov: DataFrame, jitter: DataFrame, w: int, h: int, overlap: float = 0.1) -> DataFrame:
    """Locations of a column-wise line scan from the median offset of each column.

    Columns without offsets take the rounded mean of the even or odd columns;
    the columns of a slide are summed up from left to right.
    """
    base = mechanical_location(fov, w, h, overlap)
    med = lambda c: F.percentile(c, F.lit(0.5)).cast("long")
    cols = base.select("slide", "c").distinct().join(
        jitter.where("axis = 'h'").groupBy("slide", "c").agg(med("dx").alias("dx"), med("dy").alias("dy")),
        ["slide", "c"], "left")
    known = F.when(F.col("dx").isNotNull() & F.col("dy").isNotNull(), F.col("c") % 2)
    mean = lambda odd, d: F.rint(F.avg(F.when(known == odd, F.col(d))))
    par = small(cols.groupBy("slide").agg(mean(0, "dx").alias("ex"), mean(0, "dy").alias("ey"),
                                          mean(1, "dx").alias("ox"), mean(1, "dy").alias("oy")))
    odd = F.col("c") % 2 == 1
    fill_x = F.when(odd, F.coalesce("ox", "ex")).otherwise(F.coalesce("ex", "ox"))
    fill_y = F.when(odd, F.coalesce(F.col("oy"), -F.col("ey"))).otherwise(F.coalesce(F.col("ey"), -F.col("oy")))
    both = F.col("dx").isNotNull() & F.col("dy").isNotNull()
    step = cols.join(par, "slide").where("c > 0").select(
        "slide", "c", F.when(both, F.col("dx")).otherwise(fill_x).alias("sx"),
        F.when(both, F.col("dy")).otherwise(fill_y).alias("sy"))
    run = Window.partitionBy("slide").orderBy("c")
    first = (w - int(w * overlap)) + int(w * overlap)
    shift = step.select("slide", "c", (F.sum(F.col("sx") + F.when(F.col("c") == 1, first).otherwise(w)).over(run)).alias("_x"),
                        F.sum("sy").over(run).alias("_y"))
    out = base.join(small(shift), ["slide", "c"], "left")
    return out.select("slide", "r", "c", F.coalesce(F.col("_x"), F.col("x")).cast("long").alias("x"),
                      (F.col("y") + F.coalesce("_y", F.lit(0))).cast("long").alias("y"))


class _Slide:
    """Placement of the fields of one slide; a slide is a scanner's grid, so it is bounded."""

    def __init__(self, fields: list[tuple[int, int]], w: int, h: int, overlap: float):
        self.at = {f: i for i, f in enumerate(fields)}
        self.fields = np.array(fields, float).reshape(-1, 2)
        self.w, self.h = w, h
        self.step = {"h": (w, 0), "v": (0, h)}
        self.lost = {"h": np.array([-int(w * overlap), 0.0]), "v": np.array([0.0, -int(h * overlap)])}
        self.nominal = self.fields[:, ::-1] * [w - int(w * overlap), h - int(h * overlap)]
        self.place = np.full((len(fields), 2), np.nan)
        self.links: list[list[tuple[int, np.ndarray]]] = [[] for _ in fields]
        self.offsets: dict[str, list[tuple[int, int, np.ndarray]]] = {"h": [], "v": []}
        # running normal equations of the map from nominal to found places, about the mean
        self.n, self.mean, self.moments = 0, np.zeros(4), np.zeros((4, 4))

    def link(self, r: int, c: int, axis: str, dx: float, dy: float) -> None:
        self.offsets[axis].append((r, c, np.array([dx, dy])))
        here, before = self.at.get((r, c)), self.at.get((r, c - 1) if axis == "h" else (r - 1, c))
        if here is not None and before is not None:
            step = np.array([dx, dy]) + self.step[axis]
            self.links[before].append((here, step))
            self.links[here].append((before, -step))

    def domains(self) -> list[list[int]]:
        """Fields joined by links, the largest domain first, then as a walk over the grid from its first field meets them."""
        seen, found = set(), []
        for i, links in enumerate(self.links):
            if links and i not in seen:
                own, seen = [i], seen | {i}
                for j in own:
                    new = [k for k, _ in self.links[j] if k not in seen]
                    seen.update(new)
                    own += dict.fromkeys(new)
                found.append(sorted(own))
        if not found:
            return []
        main = min(found, key=lambda d: (-len(d), d[0]))
        far, ring = {main[0]: 0}, [main[0]]
        for j in ring:
            new = [k for k in self.beside(j) if k not in far]
            far |= {k: far[j] + 1 for k in new}
            ring += new
        last = len(self.fields)
        return [main, *sorted((d for d in found if d is not main), key=lambda d: min((far.get(i, last), i) for i in d))]

    def beside(self, i: int) -> list[int]:
        r, c = map(int, self.fields[i])
        return [self.at[f] for f in ((r - 1, c), (r, c - 1), (r, c + 1), (r + 1, c)) if f in self.at]

    def guess(self, i: int) -> np.ndarray:
        """Where the map puts a field; before the first domain it is the nominal place."""
        if not self.n:
            return self.nominal[i]
        slope = np.linalg.pinv(self.moments[:2, :2]) @ self.moments[:2, 2:]
        return self.mean[2:] + (self.nominal[i] - self.mean[:2]) @ slope

    def learn(self, some: list[int]) -> None:
        """Add placed fields to the normal equations."""
        for row in np.hstack([self.nominal[some], self.place[some]]):
            self.n += 1
            gap = row - self.mean
            self.mean += gap / self.n
            self.moments += np.outer(gap, row - self.mean)

    def spread(self, domain: list[int]) -> None:
        """Place a domain ring by ring from the field nearest its centre, each at the mean of what its neighbours say."""
        gap = ((self.fields[domain] - self.fields[domain].mean(axis=0)) ** 2).sum(axis=1).round(9)
        start = domain[int(gap.argmin())]
        self.place[start] = self.guess(start)
        front, done = [start], {start}
        while front:
            said: dict[int, list[np.ndarray]] = {}
            for i in front:
                for j, step in self.links[i]:
                    if j not in done:
                        said.setdefault(j, []).append(self.place[i] + step)
            for j, places in said.items():
                self.place[j] = np.mean(places, axis=0)
            front = list(said)
            done.update(front)
        self.learn(domain)

    def fill(self) -> None:
        """Fields without a link follow their placed neighbours by the mean offset of their column (beside) or row (above
        and below), of the slide where there is none, of the nominal overlap where the slide has none; round by round."""
        mean = lambda a, own: np.mean([o for _, _, o in own], axis=0) if own else self.lost[a]
        whole = {a: mean(a, x) for a, x in self.offsets.items()}
        by = {a: {} for a in "hv"}
        for a, part in (("h", 1), ("v", 0)):
            for o in self.offsets[a]:
                by[a].setdefault(o[part], []).append(o)
        open_ = [i for i in range(len(self.fields)) if np.isnan(self.place[i, 0])]
        while open_:
            new = {}
            for i in open_:
                r, c = map(int, self.fields[i])
                beside = np.mean([o for _, _, o in by["h"][c]], axis=0) if c in by["h"] else whole["h"]
                above = np.mean([o for _, _, o in by["v"][r]], axis=0) if r in by["v"] else whole["v"]
                said = []
                for f, axis, sign, off in (((r + 1, c), "v", -1, above), ((r - 1, c), "v", 1, above),
                                           ((r, c + 1), "h", -1, beside), ((r, c - 1), "h", 1, beside)):
                    j = self.at.get(f)
                    if j is not None and not np.isnan(self.place[j, 0]):
                        said.append(self.place[j] + sign * (np.array(self.step[axis]) + off))
                if said:
                    new[i] = np.mean(said, axis=0)
            if not new:
                break
            for i, place in new.items():
                self.place[i] = place
            open_ = [i for i in open_ if i not in new]
        for i in open_:  # no placed field can be reached over the grid
            self.place[i] = self.guess(i)


def fov_global_location(fov: DataFrame, jitter: DataFrame, w: int, h: int, overlap: float = 0.1) -> DataFrame:
    """Locations of all fields of view from pairwise offsets.

    Fields linked by a valid offset form domains.  The largest domain of a slide starts at the field nearest its centre,
    at its nominal place, and is placed ring by ring at the mean of what the placed neighbours say.  The other domains
    follow in the order in which a walk over the grid meets them; each starts where a linear map from nominal to found
    places puts it, and the map is fitted anew after each domain.  Fields without a link are filled in from their
    neighbours by mean offsets.  Shifted to start at 0, rounded.

    One call a slide: its fields are one scanner's grid.  Repeated fields and offsets count once.
    """

    def one(fields: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
        if not len(fields):
            return pd.DataFrame({c: [] for c in ("slide", "r", "c", "x", "y")})
        order = sorted(set(zip(fields["r"].tolist(), fields["c"].tolist())))
        slide = _Slide(order, w, h, overlap)
        for r, c, axis, dx, dy in sorted(offsets[["r", "c", "axis", "dx", "dy"]].drop_duplicates(["r", "c", "axis"]).itertuples(index=False)):
            slide.link(r, c, axis, dx, dy)
        for domain in slide.domains():
            slide.spread(domain)
        slide.fill()
        place = np.rint(slide.place - slide.place.min(axis=0)).astype(np.int64)
        return pd.DataFrame({"slide": fields["slide"].iloc[0], "r": [r for r, _ in order], "c": [c for _, c in order],
                             "x": place[:, 0], "y": place[:, 1]})

    good = jitter.where("dx is not null and dy is not null").select(
        "slide", "r", "c", "axis", F.col("dx").cast("double").alias("dx"), F.col("dy").cast("double").alias("dy"))
    return (fov.select("slide", "r", "c").groupBy("slide").cogroup(good.groupBy("slide"))
            .applyInPandas(one, "slide long, r long, c long, x long, y long"))


def _placed(pixels: DataFrame, loc: DataFrame) -> DataFrame:
    """Field pixels ``(slide, r, c, y, x, v)`` with the origin ``_ox, _oy`` of their field; places grow with the fields, so both sides shuffle."""
    at = loc.select("slide", "r", "c", F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    return pixels.join(spread(at), ["slide", "r", "c"])


def mosaic(pixels: DataFrame, loc: DataFrame, cols: int) -> DataFrame:
    """Place field pixels ``(slide, r, c, y, x, v)``; later fields in row order win."""
    placed = _placed(pixels, loc)
    return (placed.groupBy("slide", (F.col("y") + F.col("_oy")).alias("y"), (F.col("x") + F.col("_ox")).alias("x"))
            .agg(F.max(F.struct((F.col("r") * cols + F.col("c")).alias("k"), "v")).alias("m"))
            .select("slide", "y", "x", F.col("m.v").alias("v")))


def blend_tiles(pixels: DataFrame, loc: DataFrame, overlap: int) -> DataFrame:
    """Mosaic whose overlap bands fade with a sine ramp, first along x, then along y.

    Weight of a field rises as ``sin(90 deg * i / overlap)`` from its left and top
    edge; a pixel covered twice mixes both fields, each axis in turn.
    """
    placed = _placed(pixels, loc)
    ramp = lambda c: F.when(F.col(c) < overlap, F.sin(F.radians(F.col(c) * (90.0 / overlap)))).otherwise(1.0)
    p = placed.select("slide", "r", "c", (F.col("y") + F.col("_oy")).alias("gy"), (F.col("x") + F.col("_ox")).alias("gx"),
                      "v", ramp("x").alias("wx"), ramp("y").alias("wy"))
    fade = lambda old, new, w: F.when(old.isNull(), new).otherwise(old * (1 - w) + new * w)

    def mix(df, keys, order, w):
        win = Window.partitionBy(*keys).orderBy(order)
        pair = df.withColumn("_old", F.lag("v").over(win)).withColumn("_last", F.lead("v").over(win).isNull())
        return pair.where("_last").withColumn("v", fade(F.col("_old"), F.col("v"), F.col(w))).drop("_old", "_last")

    # one shuffle by the pixel of the mosaic serves both axes
    across = mix(deal(p, "slide", "gy", "gx"), ("slide", "r", "gy", "gx"), "c", "wx")
    down = mix(across, ("slide", "gy", "gx"), "r", "wy")
    return down.select("slide", F.col("gy").alias("y"), F.col("gx").alias("x"), F.col("v"))
