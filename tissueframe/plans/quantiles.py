"""Exact percentiles of groups by distributed selection.

An order statistic lies between the least and the greatest value of its group.  A pass deals the values between two such
bounds to ``BINS`` bins of equal width and counts them; the bin that holds the wanted rank gives narrower bounds, the
least and the greatest value in it.  Equal values are one counted row from the start.  Passes go on until at most ``BINS``
different values lie between the bounds, which takes none for counts and one or two for spread values; those are summed
up in order.  No aggregation buffer and no window holds more than ``BINS`` rows of a group, however many different values
it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut, small

BINS = 4096


def _equal(keys: Sequence[str], a: DataFrame, b: DataFrame) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[f"_{k}"])
    return same


def percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float], bins: int = BINS) -> DataFrame:
    """``(keys, q, n)``: the percentiles ``ps`` of ``value`` as the array ``q``, interpolated linearly as Spark's
    ``percentile`` does, and the number of values; nulls and NaN take no part, groups without values are absent."""
    keys = list(keys)
    v = F.col(value).cast("double")
    held = cut(df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("_v")).agg(F.count("*").alias("_c")))
    groups = held.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count("*").alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    spots = F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("_n") - 1) * F.lit(float(p))).alias("pos")) for i, p in enumerate(ps)])
    asked = groups.select(*keys, "_n", "_d", "_lo", "_hi", F.explode(spots).alias("s")).select(
        *keys, "_n", F.col("s.i").alias("_i"), F.col("s.pos").alias("_pos"), "_d", "_lo", "_hi")
    ends = F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))
    state = cut(asked.withColumn("_rank", F.explode(ends)).withColumn("_before", F.lit(0).cast("long")))

    def narrowed(some: DataFrame, dealt: Column) -> DataFrame:
        """``some`` with the bounds of the part that holds the rank, of the parts of its values named by ``dealt``."""
        spans = small(some.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_lo").alias("_a"), F.col("_hi").alias("_b")).distinct())
        inside = held.join(spans, _equal(keys, held, spans) & (held["_v"] >= spans["_a"]) & (held["_v"] <= spans["_b"]))
        counted = inside.groupBy(*keys, "_a", "_b", dealt.alias("_bin")).agg(
            F.sum("_c").alias("_c"), F.count("*").alias("_e"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        upto = Window.partitionBy(*keys, "_a", "_b").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        below = counted.withColumn("_below", F.coalesce(F.sum("_c").over(upto), F.lit(0))).withColumnsRenamed({k: f"_{k}" for k in keys})
        at = F.col("_rank") - F.col("_before")
        hit = (_equal(keys, some, below) & (some["_lo"] == below["_a"]) & (some["_hi"] == below["_b"])
               & (at >= below["_below"]) & (at < below["_below"] + below["_c"]))
        return some.join(below, hit).select(*[some[k] for k in keys], "_n", "_i", "_pos", F.col("_e").alias("_d"), F.col("_least").alias("_lo"),
                                            F.col("_most").alias("_hi"), "_rank", (F.col("_before") + F.col("_below")).alias("_before"))

    width = (F.col("_v") - F.col("_a")) / (F.col("_b") - F.col("_a")) * bins
    while not state.where(F.col("_d") > bins).isEmpty():
        state = cut(state.where(F.col("_d") <= bins).unionByName(
            narrowed(state.where(F.col("_d") > bins), F.least(F.floor(width), F.lit(bins - 1)).cast("int"))))
    state = narrowed(state, F.col("_v"))
    low = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col("_lo")))
    high = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col("_lo")))
    pos, exact = F.first("_pos"), F.first(F.floor("_pos") == F.ceil("_pos"))
    one = state.groupBy(*keys, "_i").agg(
        F.first("_n").alias("n"),
        F.when(exact, low).otherwise((F.ceil(pos) - pos) * low + (pos - F.floor(pos)) * high).alias("_q"))
    return one.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]).alias("q"), F.first("n").alias("n"))


def medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(keys, median of each column)``, named like the columns."""
    long = df.unpivot(list(keys), [F.col(c).cast("double").alias(c) for c in columns], "_name", "_value")
    found = percentiles(long, [*keys, "_name"], "_value", (0.5,))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == c, F.col("q")[0])).alias(c) for c in columns])
