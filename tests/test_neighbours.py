"""Exact neighbours by metric pruning against comparing all points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.operators import neighbours

SCHEMA = "chip long, id long, f array<double>"


def brute(rows, k):
    out = set()
    for chip in {r[0] for r in rows}:
        mine = [(i, np.array(f)) for c, i, f in rows if c == chip and f is not None]
        for i, f in mine:
            found = sorted((round(float(np.sqrt(((f - g) ** 2).sum())), 9), j) for j, g in mine if j != i)[:k]
            out |= {(chip, i, j, d, rank) for rank, (d, j) in enumerate(found, 1)}
    return out


def clustered(rng, groups, each, width, spread):
    centres = rng.normal(size=(groups, width)) * 50
    return [c + rng.normal(size=width) * spread for c in centres for _ in range(each)]


@pytest.mark.parametrize(("k", "block"), [(5, 16), (1, 7), (12, 512)])
def test_equals_brute_force(spark, k, block):
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 6, 20, 5, 1.0) + [rng.normal(size=5) * 80 for _ in range(30)]
    rows = [(0, i, [float(v) for v in f]) for i, f in enumerate(vectors)]
    rows += [(0, 500 + i, rows[3][2]) for i in range(60)]  # a pile of copies, more than a block
    rows += [(1, i, [float(v) for v in f]) for i, f in enumerate(vectors[:9])]  # fewer points than neighbours
    rows += [(2, 1, [1.0, 2.0, 3.0, 4.0, 5.0]), (0, 900, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = neighbours.knn(df, "id", "f", k, ("chip",), block, pivots=8)
    assert {(r["chip"], r["src"], r["dst"], round(r["dist"], 9), r["rank"]) for r in got.collect()} == brute(rows, k)


def test_far_blocks_are_never_compared(spark):
    rng = np.random.default_rng(5)
    rows = [(0, i, [float(v) for v in f]) for i, f in enumerate(clustered(rng, 10, 40, 6, 0.5))]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []
    plain = neighbours.block_pairs

    def counted(shells, reaches, by):
        pairs = plain(shells, reaches, by)
        seen.append((pairs.count(), shells.count()))
        return pairs

    neighbours.block_pairs = counted
    try:
        got = neighbours.knn(df, "id", "f", 4, ("chip",), 10, pivots=24)
        assert {(r["chip"], r["src"], r["dst"], round(r["dist"], 9), r["rank"]) for r in got.collect()} == brute(rows, 4)
    finally:
        neighbours.block_pairs = plain
    pairs, n = seen[0]
    assert n >= 40 and pairs < 0.3 * n * (n - 1)


def test_blocks_are_bounded(spark):
    rows = [(i % 2, i, [float(i % 7), 0.0]) for i in range(300)]
    filed = neighbours.blocks(spark.createDataFrame(rows, SCHEMA), ("chip",), np.array([[0.0, 0.0], [6.0, 0.0]]), 16)
    sizes = filed.groupBy("chip", "block").agg(F.count("*").alias("n"), F.countDistinct("pivot").alias("p")).collect()
    assert sum(r["n"] for r in sizes) == 300 and max(r["n"] for r in sizes) <= 16 and {r["p"] for r in sizes} == {1}
    assert neighbours.knn(spark.createDataFrame([], SCHEMA), "id", "f", 3, ("chip",)).count() == 0


@pytest.mark.parametrize(("parts", "part"), [(3, 1 << 15), (64, 20), (2, 40)])
def test_a_block_is_sent_once_to_each_of_few_parts(spark, monkeypatch, parts, part):
    rng = np.random.default_rng(6)
    rows = [(i % 2, i, [float(v) for v in rng.normal(size=8)]) for i in range(240)]  # without structure: all blocks meet
    rows += [(0, 1000 + i, rows[0][2]) for i in range(30)] + [(0, 2000, [float(v) * 1e-7 for v in rows[0][2]])]
    monkeypatch.setattr(neighbours, "PARTS", parts)
    monkeypatch.setattr(neighbours, "PART", part)
    monkeypatch.setattr(neighbours, "CHUNK", 7)
    seen, plain = [], neighbours.parts_of

    def counted(blocks, by, size):
        found = plain(blocks, by, size)
        seen.extend(found.groupBy("chip").agg(F.countDistinct("part").alias("p"), F.count("*").alias("n")).collect())
        return found

    monkeypatch.setattr(neighbours, "parts_of", counted)
    got = neighbours.knn(spark.createDataFrame(rows, SCHEMA), "id", "f", 6, ("chip",), 10, pivots=4)
    assert {(r["chip"], r["src"], r["dst"], round(r["dist"], 9), r["rank"]) for r in got.collect()} == brute(rows, 6)
    most = max(1, part // 10)
    assert all(r["n"] >= 12 and r["p"] <= max(parts, -(-r["n"] // most)) for r in seen) and len(seen) == 2


def test_small_groups_are_one_block_each(spark, monkeypatch):
    """Pivots do not cut a group that fits a block, so its points are sent to one part, not to one for each pivot."""
    from tissueframe.operators import neighbours

    rng = np.random.default_rng(3)
    rows = [(g, i, rng.normal(size=3).tolist()) for g in range(6) for i in range(20)]
    df = spark.createDataFrame(rows, "g long, id long, f array<double>")
    seen, plain = [], neighbours.compared
    monkeypatch.setattr(neighbours, "compared", lambda bounded, pairs, *a: seen.append((bounded, pairs)) or plain(bounded, pairs, *a))
    got = {(r["g"], r["src"], r["rank"]): r["dst"] for r in neighbours.knn(df, "id", "f", 4, ("g",)).collect()}
    bounded, pairs = seen[0]
    cuts = bounded.select("g", "block").distinct().count()
    assert cuts <= 6 + int(spark.conf.get("spark.sql.shuffle.partitions")) and pairs.count() <= 4 * cuts
    for g in range(6):
        x = np.array([f for h, _, f in rows if h == g])
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
        np.fill_diagonal(d, np.inf)
        want = np.argsort(d.round(9), axis=1, kind="stable")[:, :4]
        assert all(got[g, i, k + 1] == want[i, k] for i in range(20) for k in range(4))
