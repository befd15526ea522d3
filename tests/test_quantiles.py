"""Percentiles by selection against the built-in ones, and cell density against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.operators import cells
from tissueframe.plans import quantiles

PS = (0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0)


@pytest.mark.parametrize("bins", [4096, 64])
def test_equal_the_built_in_percentiles(spark, bins):
    rng = np.random.default_rng(6)
    rows = [(0, float(v)) for v in rng.normal(size=301)] + [(1, float(v)) for v in rng.integers(0, 4, 200)]
    rows += [(2, 5.0)] * 50 + [(3, float(v)) for v in 10.0 ** rng.uniform(-200, 200, 60)] + [(4, 1.5), (5, None), (6, float("nan"))]
    rows += [(None, float(v)) for v in (3, 1, 2, 2)] + [(7, v) for v in (-1e-300, 0.0, 1e-300, 1e300, -1e300)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(4)
    want = {r["k"]: r["q"] for r in df.where("v is not null and not isnan(v)").groupBy("k").agg(
        F.percentile("v", F.array(*map(F.lit, PS))).alias("q")).collect()}
    got = {r["k"]: (r["q"], r["n"]) for r in quantiles.percentiles(df, ("k",), "v", PS, bins).collect()}
    assert got.keys() == want.keys() and got[0][1] == 301
    for k, q in want.items():
        assert got[k][0] == pytest.approx(q, rel=1e-12, abs=0), k
    assert quantiles.percentiles(df.limit(0), ("k",), "v", PS).count() == 0


def test_medians_of_columns(spark):
    df = spark.createDataFrame([(c, i, i * i, None if i % 3 else i) for c in (0, 1) for i in range(10 + c)], "chip long, a long, b long, d long")
    want = sorted(map(tuple, df.groupBy("chip").agg(*[F.percentile(c, F.lit(0.5)) for c in "abd"]).collect()))
    assert sorted(map(tuple, quantiles.medians(df, ("chip",), ("a", "b", "d")).select("chip", "a", "b", "d").collect())) == want


@pytest.mark.parametrize("r", [3, 40, 200])
def test_density_equals_all_pairs(spark, r):
    rng = np.random.default_rng(r)
    pos = [(int(c), int(x), int(y)) for c, x, y in zip(rng.integers(0, 2, 250), rng.integers(-300, 900, 250), rng.integers(-300, 900, 250))]
    pos += [(0, 511, 511), (0, 512, 512), (0, 512, 511)] + [(1, 100, 100)] * 30  # tile corners, a pile
    df = spark.createDataFrame([(c, i, x, y) for i, (c, x, y) in enumerate(pos)], "chip long, cell_id long, x long, y long")
    want = {i: sum(c == d and (x - a) ** 2 + (y - b) ** 2 <= r * r for d, a, b in pos) - 1 for i, (c, x, y) in enumerate(pos)}
    assert {row["cell_id"]: row["density"] for row in cells.cell_density(df, r).collect()} == want
