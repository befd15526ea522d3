"""Components of sparse rows against a dense solution."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.operators import cluster, reduction


def dense(x, k):
    y = x - x.mean(axis=0)
    sd = x.std(axis=0, ddof=1)
    y = np.divide(y, sd, out=np.zeros_like(y), where=sd > 1e-12)
    _, s, vt = np.linalg.svd(y, full_matrices=False)
    return y, s[:k] ** 2 / (len(x) - 1), vt[:k].T


def frame(spark, x):
    rows = [(i, np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist()) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, idx array<int>, val array<double>").repartition(4)


def test_30_components_of_5000_sparse_columns(spark):
    rng = np.random.default_rng(1)
    n, m, k = 400, 5000, 30
    kinds = rng.integers(0, 40, n)
    rate = rng.gamma(0.3, 0.3, (40, m)) * (1 + 6 * (rng.random((40, m)) < 0.05))
    x = np.log1p(rng.poisson(rate[kinds])).astype(float)
    x[:, 7] = 0.0
    y, values, loadings = dense(x, k)
    df = frame(spark, x)
    got = reduction.fit(df, "idx", "val", k, m)
    assert np.allclose(got.values, values, rtol=1e-6)
    assert np.abs(got.loadings @ got.loadings.T - loadings @ loadings.T).max() < 1e-4 and 1 < got.passes < 300
    assert (got.loadings[np.abs(got.loadings).argmax(axis=0), range(k)] > 0).all() and got.scale[7] == 0
    places = {r["id"]: r["pca"] for r in got.project(df, "idx", "val", "pca").collect()}
    assert np.allclose([places[i] for i in range(n)], y @ got.loadings, atol=1e-6)


def test_array_columns_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 9)) @ rng.normal(size=(9, 9)) + 5
    x[:, 4] = 3.0
    y, values, loadings = dense(x, 3)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(99, None)], "id long, f array<double>")
    got = {r["id"]: r["pca"] for r in cluster.pca_features(df, "f", 3).collect()}
    sign = np.where(loadings[np.abs(loadings).argmax(axis=0), range(3)] < 0, -1, 1)
    assert got[99] is None and np.allclose([got[i] for i in range(60)], y @ loadings * sign, atol=1e-8)
    assert cluster.pca_features(df.limit(0), "f", 3).count() == 0
    with pytest.raises(ValueError, match="more than"):
        reduction.fit(df.select(F.array(F.lit(200_000)).alias("idx"), F.array(F.lit(1.0)).alias("val")), "idx", "val", 2)


def test_a_row_without_entries_is_the_centred_zero(spark):
    x = np.array([[0, 0, 0], [1, 0, 2], [0, 3, 0], [2, 1, 1], [0, 0, 4]], float)
    y, _, _ = dense(x, 2)
    df = frame(spark, x)
    got = reduction.fit(df, "idx", "val", 2)
    places = {r["id"]: r["pca"] for r in got.project(df, "idx", "val", "pca").collect()}
    assert np.allclose([places[i] for i in range(5)], y @ got.loadings)
