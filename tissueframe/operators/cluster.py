"""Feature reduction, neighbour graphs, communities and background correction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.buckets import bucket, near_join, square_distance
from ..plans.groups import group_apply
from ..session import cut, spread
from . import neighbours, reduction
from .components import consecutive_labels

#: Pairs of a mixture and a position that are scored at a time.
PAIRS = 200_000


def pca_features(df: DataFrame, col: str, k: int = 30) -> DataFrame:
    """Scale an array column and project it on its ``k`` first components, as the array column ``pca``.

    Component signs are fixed so that the largest loading is positive.
    """
    rows = df.withColumn("_idx", F.expr(f"sequence(0, size(`{col}`) - 1)")).withColumn("_val", F.col(col).cast("array<double>"))
    return reduction.fit(rows, "_idx", "_val", k).project(rows, "_idx", "_val", "pca").drop("_idx", "_val")


def knn_graph(df: DataFrame, id_col: str, col: str, k: int, by: tuple[str, ...] = (), block: int = neighbours.BLOCK) -> DataFrame:
    """Exact k nearest neighbours of array features, among the points that share the columns ``by``."""
    return neighbours.knn(df, id_col, col, k, by, block)


def spatial_knn(points: DataFrame, k: int, reach: int) -> DataFrame:
    """Exact k nearest neighbours ``(chip, src, dst, d2, rank)`` of points ``(chip, id, x, y)``.

    Looks in the nine buckets around a point; a point whose k-th neighbour is no
    farther than the bucket edge is done, the others retry with a doubled edge.
    A chip with at most k points stops when the edge spans the chip.  Of points
    at one position only the k + 1 smallest ids can be a neighbour of anything,
    so a pile of copies is met k + 1 times, not once per copy.
    """
    pts = cut(points.select("chip", "id", "x", "y"))
    pile = Window.partitionBy("chip", "x", "y").orderBy("id")
    sites = cut(pts.withColumn("_i", F.row_number().over(pile)).where(F.col("_i") <= k + 1).drop("_i"))
    span = pts.groupBy("chip").agg((F.max("x") - F.min("x") + F.max("y") - F.min("y") + 1).alias("_span"))
    open_pts = cut(pts.join(span, "chip"))
    done = None
    order = Window.partitionBy("chip", "id").orderBy("d2", "s_id")
    while True:
        near = near_join(open_pts, sites, reach, ("chip",)).where("id <> s_id").withColumn("d2", square_distance())
        top = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        full = top.groupBy("chip", "id").agg(F.count("*").alias("_c"), F.max("d2").alias("_far"))
        state = cut(open_pts.join(full, ["chip", "id"], "left").withColumn(
            "_ok", ((F.coalesce("_c", F.lit(0)) >= k) & (F.col("_far") <= reach * reach)) | (F.col("_span") <= reach)))
        final = state.where("_ok").select("chip", "id")
        hit = cut(top.join(final, ["chip", "id"], "left_semi").select(
            "chip", F.col("id").alias("src"), F.col("s_id").alias("dst"), "d2", F.col("rank").cast("long").alias("rank")))
        done = hit if done is None else done.unionByName(hit)
        open_pts = state.where(~F.coalesce(F.col("_ok"), F.lit(False))).select("chip", "id", "x", "y", "_span")
        if open_pts.isEmpty():
            return done
        reach *= 2


def community_labels(edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Communities of an undirected graph ``(src, dst)`` by label propagation, apart for each value of ``by``.

    Each round every node takes the most frequent label among itself and its
    neighbours, the smaller label on ties, until nothing changes.  Nodes that
    move at once can swap labels for ever.  So when a round does not move fewer
    nodes than every one before, only nodes move from then on that come before
    all their moving neighbours in a hash order: each such move makes more
    neighbours agree, which ends.
    """
    both = cut(edges.select(*by, "src", "dst").unionByName(
        edges.select(*by, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut(both.select(*by, F.col("src").alias("node")).distinct().withColumn("label", F.col("node")))
    fewest, alone, at = None, False, [*by, "node"]
    while True:
        votes = (both.join(labels.select(*by, F.col("node").alias("dst"), "label"), [*by, "dst"])
                 .select(*by, F.col("src").alias("node"), "label")
                 .unionByName(labels.select(*at, "label")).groupBy(*at, "label").agg(F.count("*").alias("n")))
        best = votes.groupBy(*at).agg(F.max(F.struct("n", (-F.col("label")).alias("neg"))).alias("m"))
        nxt = cut(labels.join(best, at).select(*at, (-F.col("m.neg")).alias("new"), "label"))
        moving = nxt.where("new <> label").select(*at)
        n = moving.count()
        if not n:
            break
        alone = alone or (fewest is not None and n >= fewest)
        fewest = n
        if not alone:
            labels = nxt.select(*at, F.col("new").alias("label"))
            continue
        order = lambda c: F.struct(F.xxhash64(c), c)
        waits = (both.join(moving.withColumnRenamed("node", "src"), [*by, "src"], "left_semi")
                 .join(moving.withColumnRenamed("node", "dst"), [*by, "dst"], "left_semi")
                 .where(order("dst") < order("src")).select(*by, F.col("src").alias("node")).distinct())
        first = moving.join(waits, at, "left_anti").withColumn("_first", F.lit(True))
        labels = cut(nxt.join(first, at, "left").select(*at, F.when(F.col("_first"), F.col("new")).otherwise(F.col("label")).alias("label")))
    keys = by or ("_all",)
    full = labels if by else labels.withColumn("_all", F.lit(0))
    dense = consecutive_labels(full.withColumn("label", F.col("label") + 1), keys, 0)
    return full.join(dense.select(*keys, (F.col("label") - 1).alias("label"), F.col("new_label").alias("community")),
                     [*keys, "label"]).select(*at, "community")


def _first_centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` of the points, drawn one after another by the squared distance to those drawn before."""
    rng = np.random.default_rng(seed)
    mu = [x[rng.integers(len(x))]]
    for _ in range(1, k):
        d2 = np.min([((x - m) ** 2).sum(1) for m in mu], axis=0)
        mu.append(x[rng.choice(len(x), p=d2 / d2.sum())])
    return np.array(mu, float)


def _fit_spherical(x: np.ndarray, group: np.ndarray, seeds: np.ndarray, k: int, rounds: int = 100):
    """Spherical Gaussian mixtures of many groups by expectation maximisation.

    ``group`` numbers the rows of ``x`` from 0, ``seeds`` has one for each group.  Groups of one size go through the
    rounds together, each until it settles.  Returns the groups that can be fitted, their means, variances and weights.
    """
    order = np.lexsort((*x.T[::-1], group))
    x, group, dim = x[order].astype(float), group[order], x.shape[1]
    new = np.append(True, (group[1:] != group[:-1]) | (x[1:] != x[:-1]).any(axis=1)) if len(x) else np.zeros(0, bool)
    n, different = np.bincount(group, minlength=len(seeds)), np.bincount(group[new], minlength=len(seeds))
    head = np.cumsum(n) - n
    able = np.flatnonzero(different >= k)
    mu, var, pi = np.zeros((len(able), k, dim)), np.zeros((len(able), k)), np.full((len(able), k), 1.0 / k)
    for size in np.unique(n[able]):
        at = np.flatnonzero(n[able] == size)
        y = x[head[able[at]][:, None] + np.arange(size)]
        mu[at] = [_first_centres(own, k, int(seed)) for own, seed in zip(y, seeds[able[at]])]
        var[at] = (y.var(axis=1).mean(axis=1) + 1e-6)[:, None]
        last = np.full(len(at), -np.inf)
        for _ in range(rounds):
            dens = _log_density(y, mu[at], var[at], pi[at])
            top = dens.max(axis=2, keepdims=True)
            norm = top[..., 0] + np.log(np.exp(dens - top).sum(axis=2))
            resp = np.exp(dens - norm[..., None])
            total = resp.sum(axis=1) + 1e-10
            mu[at], pi[at] = (resp.transpose(0, 2, 1) @ y) / total[..., None], total / size
            var[at] = (resp * ((y[:, :, None] - mu[at][:, None]) ** 2).sum(axis=3)).sum(axis=1) / (total * dim) + 1e-6
            mean = norm.mean(axis=1)
            open_ = ~(np.abs(mean - last) < 1e-3)
            if not open_.any():
                break
            at, y, last = at[open_], y[open_], mean[open_]
    return able, mu, var, pi


def _log_density(x, mu, var, pi):
    """Of points ``(..., n, dim)`` under each part ``(..., k, dim)`` of their mixture."""
    d2 = ((x[..., :, None, :] - mu[..., None, :, :]) ** 2).sum(axis=-1)
    return np.log(pi)[..., None, :] - 0.5 * ((x.shape[-1] * np.log(2 * np.pi * var))[..., None, :] + d2 / var[..., None, :])


def gmm_correct(assigned: DataFrame, cells: DataFrame, r: int = 50, thr: float = 20.0, k: int = 3) -> DataFrame:
    """Adopt background points that fit a cell's own mixture over (x, y, count).

    Candidates are scored at the largest count of their position; below ``thr``
    in negative log-likelihood they join the cell.  Own points outside the box of half-width ``r`` go.  A point goes to the smallest
    cell id that claims it.  Copies are collapsed first, so a cell receives at
    most the distinct rows of its box.

    A mixture is a few numbers, so mixtures go to the tiles that their cell's box reaches and a background point is
    shuffled once, however many boxes it lies in.  A tile has no more positions than a box.  Points without a count take
    no part in the fit, and positions without a count are no candidates.
    """
    from .cells import dedupe_first

    keys, by, tile = ("chip", "gene", "x", "y", "mid"), ("chip", "cell_id"), ("chip", "ty", "tx")
    size = max(1, 2 * int(r) - 1)
    flat = cut(assigned.select(*keys, "cell_id").distinct())
    box = cells.select(*by, F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy"))
    own = flat.where("cell_id > 0").join(spread(box), [*by]).where((F.abs(F.col("x") - F.col("cx")) < r) & (F.abs(F.col("y") - F.col("cy")) < r))
    own = cut(own.select(*keys, "cell_id"))

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        group = rows.groupby([*by], sort=False).ngroup().to_numpy()
        names = rows.drop_duplicates([*by])[[*by]].to_numpy()
        able, mu, var, pi = _fit_spherical(rows[["x", "y", "mid"]].to_numpy(float), group, names[:, 1], k)
        of, mu = names[np.repeat(able, k)], mu.reshape(-1, 3)
        return pd.DataFrame({"chip": of[:, 0], "cell_id": of[:, 1], "mx": mu[:, 0], "my": mu[:, 1], "mm": mu[:, 2], "var": var.reshape(-1), "pi": pi.reshape(-1)})

    shape = ("mx", "my", "mm", "var", "pi")
    fits = group_apply(own.where("mid is not null").select(*by, "x", "y", "mid"), by, fitted,
                       "chip long, cell_id long, " + ", ".join(f"{c} double" for c in shape), many=True)
    reach = lambda c: F.explode(F.sequence(bucket(F.col(c) - r, size), bucket(F.col(c) + r, size)))
    sites = (fits.join(spread(box.distinct()), [*by]).withColumn("ty", reach("cy")).withColumn("tx", reach("cx")))
    zero = lambda kind, *names: [F.lit(0).cast(kind).alias(c) for c in names]
    back = flat.where("cell_id = 0 and x is not null and y is not null")
    both = (sites.select(*tile, "cell_id", "cx", "cy", *shape, F.lit("").alias("gene"), *zero("long", "x", "y", "mid"), F.lit(True).alias("site"))
            .unionByName(back.select("chip", bucket("y", size).alias("ty"), bucket("x", size).alias("tx"), *zero("long", "cell_id"),
                                     *zero("double", "cx", "cy", *shape), "gene", "x", "y", "mid", F.lit(False).alias("site"))))

    def claimed(rows: pd.DataFrame) -> pd.DataFrame:
        is_site = rows["site"].to_numpy(bool)
        mine, back = rows[is_site], rows[~is_site]
        owner = np.zeros(len(back), np.int64)
        if len(mine) and len(back):
            x, y = back["x"].to_numpy(np.int64), back["y"].to_numpy(np.int64)
            _, first, at = np.unique((x - x.min()) * size + (y - y.min()), return_index=True, return_inverse=True)
            top = np.full(len(first), -np.inf)
            np.fmax.at(top, at, back["mid"].to_numpy(float))
            spots = np.column_stack([x[first], y[first], top])
            open_, taken = np.isfinite(top), np.zeros(len(first), np.int64)
            # every mixture has k rows; the smallest cell comes first
            mine = mine.sort_values(["cell_id", "cx", "cy"], kind="stable")
            cell = mine["cell_id"].to_numpy(np.int64)[::k]
            cx, cy, *fit = mine[["cx", "cy", *shape]].to_numpy(float).T.reshape(-1, len(cell), k)
            mu, var, pi = np.stack(fit[:3], axis=2), fit[3], fit[4]
            step = max(1, PAIRS // len(spots))
            for i in range(0, len(cell), step):
                free = np.flatnonzero(open_)
                inside = ((np.abs(spots[free, 0] - cx[i: i + step, :1]) < r) & (np.abs(spots[free, 1] - cy[i: i + step, :1]) < r))
                c, spot = np.nonzero(inside)
                c, spot = c + i, free[spot]
                dens = _log_density(spots[spot][:, None], mu[c], var[c], pi[c])[:, 0]
                best = dens.max(axis=1, initial=-np.inf)
                won = np.flatnonzero(-(best + np.log(np.exp(dens - best[:, None]).sum(axis=1))) < thr)[::-1]
                taken[spot[won]] = cell[c[won]]
                open_[spot[won]] = False
            owner = taken[at]
        return back.assign(cell_id=owner)[owner != 0][[*tile, "cell_id", "gene", "x", "y", "mid"]]

    grown = group_apply(both, tile, claimed, "chip long, ty long, tx long, cell_id long, gene string, x long, y long, mid long").select(*keys, "cell_id")
    return dedupe_first(own.unionByName(grown).where("cell_id > 0"), keys)
