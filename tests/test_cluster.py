"""Communities, clustering of several chips and track templates."""

import itertools
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tissueframe import jobs
from tissueframe.operators import cluster, registration


def test_communities_are_stable(spark):
    """Also on graphs in which nodes that move at once would swap labels for ever."""
    rings = [(i, (i + 1) % 7) for i in range(7)]
    sides = [(10 + a, 20 + b) for a, b in itertools.product(range(4), range(3))]
    path = [(30 + i, 31 + i) for i in range(9)]
    edges = rings + sides + path
    got = {r["node"]: r["community"] for r in cluster.community_labels(spark.createDataFrame(edges, "src long, dst long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    assert set(got) == set(near)
    for node, others in near.items():
        votes = Counter(got[o] for o in others)
        votes[got[node]] += 1
        assert votes[got[node]] == max(votes.values())


def test_chips_are_clustered_apart(spark):
    """Equal cell ids on two chips are different cells."""
    rows = [(chip, cell, f"g{g}", 1 + (cell * 7 + g * 3 + chip * 5) % 11 + 20 * (g % 2 == cell % 2))
            for chip in (0, 1) for cell in range(1, 31) for g in range(8)]
    df = spark.createDataFrame(rows, "chip long, cell_id long, gene string, mid long")
    both = {(r["chip"], r["cell_id"]): r["community"] for r in jobs.cluster_job(df, 3, 4, min_counts=1, min_genes=1, n_bins=2).collect()}
    assert len(both) == 60
    graph = cluster.knn_graph(spark.createDataFrame([(c, i, [float(i), float(c)]) for c in (0, 1) for i in range(20)],
                                                    "chip long, id long, f array<double>"), "id", "f", 3, by=("chip",))
    assert graph.where(F.abs(F.col("src") - F.col("dst")) > 3).count() == 0 and graph.count() == 120


def test_template_of_each_axis(spark):
    """Real track steps, other steps along y, and a window whose last columns are empty."""
    steps = (registration.PITCH, (100, 150, 250))
    empty = {"x": {7 + p + 2940 * k for p in registration.track_prefix(steps[0]) for k in range(2)},
             "y": {31 + p + 500 * k for p in registration.track_prefix(steps[1]) for k in range(12)}}
    rows = [(0, a, i, 0 if i in empty[a] else 5) for a in "xy" for i in range(5880)]
    marginals = spark.createDataFrame(rows, "chip long, axis string, pos long, total long")
    first = registration.track_valley(marginals, template=steps)
    got = {r["axis"]: (r["first"], r["total"]) for r in first.collect()}
    assert got == {"x": (8, 0), "y": (32, 0)}
    pos = registration.cyclic_positions(first.select("chip", "axis", (F.col("first") - 1).alias("first"), F.lit(5880).cast("long").alias("length")), steps)
    seen = defaultdict(set)
    for r in pos.collect():
        seen[r["axis"]].add(r["pos"])
    assert {p for p in seen["x"] if p >= 7} == {p for p in empty["x"] if p <= 5880} | {p for p in seen["x"] if p > 5880}
    assert {p for p in empty["y"] if p <= 5880} <= seen["y"]
    center = spark.createDataFrame([(0, 1000.0, 1000.0)], "chip long, x double, y double")
    near = registration.track_valley(marginals.where("axis = 'y' and pos < 1900"), 900, center, steps).collect()
    assert [(r["first"], r["total"]) for r in near] == [(532, 0)]  # the first whole period in the window starts at 531


def test_product_score_is_zero_without_overlap(spark):
    one = lambda img, x: spark.createDataFrame([(img, 0, x, 3)], "img string, y long, x long, v long")
    got = registration.align_score(one("a", 0), one("a", 5), [(0, 0, 0), (0, -5, 0)]).collect()
    assert {(r["dx"], r["score"]) for r in got} == {(0, 0), (-5, 9)}
    assert registration.best_alignment(registration.align_score(one("a", 0), one("a", 50), [(0, 0, 0)])).first()["score"] == 0
