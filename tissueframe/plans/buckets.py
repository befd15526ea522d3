"""Bucketed joins: range, overlap and radius joins as equi-joins.

Spark has no range-join strategy, so every spatial predicate is given an equality
on a coarse bucket.  Label runs of one layer are disjoint, so a bucket of one
pixel row holds at most ``width`` runs however dense the points are; hot buckets
on the point side are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import spread

RUN_BUCKET = 128


def bucket(col: Column | str, size: int) -> Column:
    """Floor division that also holds for negative coordinates."""
    col = F.col(col) if isinstance(col, str) else col
    return F.floor(col / F.lit(size)).cast("long")


def run_pieces(runs: DataFrame, size: int = RUN_BUCKET) -> DataFrame:
    """Cut runs at bucket borders; adds ``_xb`` and keeps ``x0, x1`` inside the bucket."""
    cut = runs.withColumn("_xb", F.explode(F.sequence(bucket("x0", size), bucket("x1", size))))
    return (cut.withColumn("x0", F.greatest("x0", F.col("_xb") * size))
               .withColumn("x1", F.least("x1", F.col("_xb") * size + (size - 1))))


def points_in_runs(points: DataFrame, runs: DataFrame, how: str = "left",
                   keys: tuple[str, ...] = ("chip",), size: int = RUN_BUCKET) -> DataFrame:
    """Join points ``(keys, y, x)`` to the runs that cover them.

    The run side keeps its other columns (``label``).  ``how`` is left, inner,
    left_semi or left_anti.  Runs of different labels that overlap give one row
    per label.
    """
    carry = [c for c in runs.columns if c not in {*keys, "y", "x0", "x1"}]
    if how in ("left_semi", "left_anti"):
        carry = []
    r = run_pieces(runs, size).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("y").alias("_y"), "_xb",
        F.col("x0").alias("_x0"), F.col("x1").alias("_x1"), *carry)
    p = points.withColumn("_pb", bucket("x", size))
    on = [p[k] == r[f"_{k}"] for k in keys]
    on += [p["y"] == r["_y"], p["_pb"] == r["_xb"], p["x"].between(r["_x0"], r["_x1"])]
    joined = p.join(spread(r), on, how)
    return joined.select(*points.columns, *carry)


def overlap_pairs(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("chip",),
                  size: int = RUN_BUCKET) -> DataFrame:
    """Pixels shared by every pair of labels: ``(keys, label_a, label_b, cnt)``."""
    pieces = overlap_runs(a, b, keys, size)
    return (pieces.groupBy(*keys, "label_a", "label_b")
            .agg(F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("cnt")))


def overlap_runs(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("chip",),
                 size: int = RUN_BUCKET) -> DataFrame:
    """The runs where a label of ``a`` and a label of ``b`` coincide."""
    l = run_pieces(a, size).select(*keys, "y", "_xb", F.col("label").alias("label_a"),
                                   F.col("x0").alias("_a0"), F.col("x1").alias("_a1"))
    r = run_pieces(b, size).select(*keys, "y", "_xb", F.col("label").alias("label_b"),
                                   F.col("x0").alias("_b0"), F.col("x1").alias("_b1"))
    j = l.join(spread(r), [*keys, "y", "_xb"]).where("_a0 <= _b1 and _b0 <= _a1")
    return j.select(*keys, "label_a", "label_b", "y", F.greatest("_a0", "_b0").alias("x0"),
                    F.least("_a1", "_b1").alias("x1"))


def near_join(probe: DataFrame, site: DataFrame, reach: int, keys: tuple[str, ...] = (),
              how: str = "inner") -> DataFrame:
    """Equi-join every probe to the sites in its own and the eight buckets around it.

    ``site`` is the side of bounded density (a pitch lattice, cell centres); it is
    the one that is repeated nine times.  Its columns get the prefix ``s_``.
    """
    step = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    s = (site.withColumn("_bx", F.explode(F.transform(step, lambda d: bucket("x", reach) + d)))
             .withColumn("_by", F.explode(F.transform(step, lambda d: bucket("y", reach) + d))))
    s = s.select("_bx", "_by", *keys, *[F.col(c).alias(f"s_{c}") for c in site.columns if c not in keys])
    p = probe.withColumn("_bx", bucket("x", reach)).withColumn("_by", bucket("y", reach))
    return p.join(spread(s), [*keys, "_bx", "_by"], how).drop("_bx", "_by")


def square_distance(x: str = "x", y: str = "y", sx: str = "s_x", sy: str = "s_y") -> Column:
    dx, dy = F.col(x) - F.col(sx), F.col(y) - F.col(sy)
    return dx * dx + dy * dy
