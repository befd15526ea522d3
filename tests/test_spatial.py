import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tissueframe.functions import geometry
from tissueframe.operators import borders, cells, cluster, components, images, masks, morphology, ranking, registration, stitching

RNG = np.random.default_rng(5)


def test_density_with_duplicates(spark):
    pts = [(0, i, int(x), int(y)) for i, (x, y) in enumerate(RNG.integers(0, 120, (150, 2)))]
    pts += [(0, 1000 + i, 60, 60) for i in range(80)]
    got = {r["cell_id"]: r["density"] for r in cells.cell_density(
        spark.createDataFrame(pts, "chip long, cell_id long, x long, y long"), 25).collect()}
    for _, i, x, y in pts:
        assert got[i] == sum((x - a) ** 2 + (y - b) ** 2 <= 625 for _, _, a, b in pts) - 1


def test_nms_equals_sequential_greedy(spark):
    n = 160
    det = pd.DataFrame({"img": 0, "id": range(n), "cx": RNG.integers(0, 150, n), "cy": RNG.integers(0, 150, n),
                        "w": RNG.integers(4, 30, n), "h": RNG.integers(4, 30, n), "score": RNG.integers(0, 40, n),
                        "cls": RNG.integers(0, 2, n)})
    det.loc[:60, ["cx", "cy"]] = 50  # a pile
    order = det.sort_values(["score", "id"], ascending=[False, True])
    kept, gone = [], set()
    for r in order.itertuples():
        if r.id in gone:
            continue
        kept.append(r.id)
        d2 = (order.cx - r.cx + (order.cls - r.cls) * 4096) ** 2 + (order.cy - r.cy + (order.cls - r.cls) * 4096) ** 2
        gone |= set(order.id[d2 <= min(r.w, r.h) ** 2])
    got = ranking.rotated_nms(spark.createDataFrame(det)).orderBy("rank").collect()
    assert [r["id"] for r in got] == kept
    assert ranking.rotated_nms(spark.createDataFrame(det), max_keep=5).count() == 5


def test_nms_with_one_huge_box(spark):
    rows = [(0, i, 20 * i, 0, 8, 8, 50 - i, 0) for i in range(30)] + [(0, 99, 2000, 0, 700, 700, 1, 0), (0, 100, 1500, 0, 8, 8, 0, 0)]
    det = spark.createDataFrame(rows, "img long, id long, cx long, cy long, w long, h long, score long, cls long")
    assert [r["id"] for r in ranking.rotated_nms(det).orderBy("rank").collect()] == [*range(30), 99]


def test_semantic_pixels_keep_the_frame_edge(spark):
    grid = np.array([[1, 1, 0, 2], [1, 1, 2, 2], [0, 3, 2, 2], [3, 3, 0, 2]])
    px = spark.createDataFrame([(0, int(v), y, x) for (y, x), v in np.ndenumerate(grid) if v], "chip long, label long, y long, x long")
    frame = spark.createDataFrame([(0, 4, 4)], "chip long, h long, w long")
    want = {(y, x) for (y, x), v in np.ndenumerate(grid) if v and (
        y == 3 or x == 3 or (grid[y + 1, x + 1] == v and grid[y + 1, x] == grid[y, x + 1]))}
    assert {(r["y"], r["x"]) for r in morphology.instance_to_semantic(px, frame).collect()} == want


def test_nearest_site_far_away(spark):
    sites = [(0, 0, 0, 1), (0, 500, 40, 2), (1, 9000, 9000, 3)]
    points = [(0, i, int(x), int(y)) for i, (x, y) in enumerate(RNG.integers(-400, 900, (60, 2)))] + [(1, 99, 5, 5), (2, 100, 1, 1)]
    got = masks.nearest_site(spark.createDataFrame(points, "chip long, id long, x long, y long"),
                             spark.createDataFrame(sites, "chip long, x long, y long, s long"), ("chip",), 8, ("s",)).collect()
    assert {r["id"] for r in got} == set(range(60)) | {99}
    for r in got:
        assert r["d2"] == min((r["x"] - x) ** 2 + (r["y"] - y) ** 2 for c, x, y, _ in sites if c == r["chip"])


def test_spatial_knn(spark):
    pts = [(0, i, int(x), int(y)) for i, (x, y) in enumerate(RNG.integers(0, 300, (80, 2)))] + [(1, 500, 0, 0), (1, 501, 9, 9)]
    pts += [(0, 900 + i, 40, 40) for i in range(40)]  # a pile of copies
    got = cluster.spatial_knn(spark.createDataFrame(pts, "chip long, id long, x long, y long"), 4, 10).collect()
    for c, i, x, y in pts:
        want = sorted(((x - a) ** 2 + (y - b) ** 2, j) for d, j, a, b in pts if d == c and j != i)[:4]
        assert sorted((r["d2"], r["dst"]) for r in got if r["src"] == i) == want


def test_feature_knn_is_exact(spark):
    x = RNG.normal(size=(900, 6))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, f array<double>")
    got = cluster.knn_graph(df, "id", "f", 5, block=128).collect()
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j)) for i in range(900) for j in np.argsort(d[i])[:5]}
    assert len(got) == 4500
    assert want == {(r["src"], r["dst"]) for r in got}


def test_communities_separate_cliques(spark):
    edges = [(a + k, b + k) for k in (0, 10) for a, b in itertools.combinations(range(6), 2)] + [(5, 10)]
    got = {r["node"]: r["community"] for r in cluster.community_labels(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(10, 16)}) == 1 and got[0] != got[12]


def test_point_components_and_hull(spark):
    pts = [(0, i, int(x), int(y)) for i, (x, y) in enumerate(RNG.integers(0, 100, (60, 2)))]
    got = {r["id"]: r["root"] for r in components.point_components(spark.createDataFrame(pts, "chip long, id long, x long, y long"), 9).collect()}
    parent = list(range(60))
    find = lambda a: a if parent[a] == a else find(parent[a])
    for (_, i, x, y), (_, j, a, b) in itertools.combinations(pts, 2):
        if (x - a) ** 2 + (y - b) ** 2 < 81:
            parent[find(i)] = find(j)
    for i, j in itertools.combinations(range(60), 2):
        assert (got[i] == got[j]) == (find(i) == find(j))
    square = [(0, i * 11 + j, 10 * i, 10 * j) for i in range(11) for j in range(11)] + [(0, 999, 900, 900)]
    r = registration.point_cluster_area(spark.createDataFrame(square, "chip long, id long, x long, y long"), 12, (1000, 1000)).first()
    assert r["area_ratio"] == pytest.approx(0.01)


def test_components_of_a_pile_cost_one_node(spark):
    df = spark.createDataFrame([(0, i, 5, 5) for i in range(2000)] + [(0, 5000, 9, 5)], "chip long, id long, x long, y long")
    assert [r["n"] for r in components.point_components(df, 5).groupBy("root").agg(F.count("*").alias("n")).collect()] == [2001]


def test_simplify_borders_matches_stepwise(spark):
    rings = {c: [(int(12 * math.cos(k * 2 * math.pi / n) + RNG.integers(0, 3)), int(12 * math.sin(k * 2 * math.pi / n) + RNG.integers(0, 3)))
                 for k in range(n)] for c, n in ((1, 20), (2, 9), (3, 6))}
    rows = [(0, c, k, x, y) for c, ring in rings.items() for k, (x, y) in enumerate(ring)]
    got = borders.simplify_borders(spark.createDataFrame(rows, "chip long, cell_id long, idx long, dx long, dy long"), 8).collect()
    for c, ring in rings.items():
        ring = list(ring)
        while len(ring) > 8:
            area = [abs((b[0] - a[0]) * (d[1] - a[1]) - (d[0] - a[0]) * (b[1] - a[1])) / 2
                    for a, b, d in zip(ring[-1:] + ring[:-1], ring, ring[1:] + ring[:1])]
            ring.pop(int(np.argmin(area)))
        assert [(r["dx"], r["dy"]) for r in sorted(got, key=lambda r: r["idx"]) if r["cell_id"] == c] == ring


def test_valid_border_length_single_pad(spark):
    def arr(*p):
        return [{"dx": a, "dy": b} for a, b in p]
    rows = [(0, arr((1, 1), (2, 2), (0, 0), (0, 0))), (1, arr((1, 1), (0, 0), (3, 3), (32767, 32767))),
            (2, arr((1, 1), (2, 2), (3, 3))), (3, arr((1, 1), (0, 0), (32767, 32767), (32767, 32767)))]
    df = spark.createDataFrame(rows, "i int, border array<struct<dx:int,dy:int>>")
    got = {r["i"]: r["n"] for r in df.select("i", borders.valid_border_length(F.col("border")).alias("n")).collect()}
    assert got == {0: 2, 1: 3, 2: 3, 3: 2}


def test_fov_locations_are_exact_on_consistent_offsets(spark):
    rows, cols, w, h = 4, 5, 100, 80
    true = {(r, c): (c * 90 + 2 * r, r * 72 - c) for r in range(rows) for c in range(cols)}
    jit = []
    for (r, c), (x, y) in true.items():
        for axis, (pr, pc) in (("h", (r, c - 1)), ("v", (r - 1, c))):
            if (pr, pc) in true:
                px, py = true[(pr, pc)]
                dx, dy = x - px - (w if axis == "h" else 0), y - py - (h if axis == "v" else 0)
                jit.append((7, r, c, axis, dx, dy, 9))
    fov = spark.createDataFrame([(7, r, c) for r, c in true], "slide long, r long, c long")
    schema = "slide long, r long, c long, axis string, dx long, dy long, conf long"
    base = min(v[0] for v in true.values()), min(v[1] for v in true.values())
    want = {k: (x - base[0], y - base[1]) for k, (x, y) in true.items()}
    run = lambda j: {(r["r"], r["c"]): (r["x"], r["y"]) for r in stitching.fov_global_location(
        fov, spark.createDataFrame(j, schema), w, h).collect()}
    assert run(jit) == want
    # a separate last column is placed by the linear map, so it stays exact too
    assert run([j for j in jit if not (j[3] == "h" and j[2] == 4)]) == want


def test_midpoint_fence(spark):
    vals = [0, 1, 2, 3, 4, 5, 90]
    df = spark.createDataFrame([(0, 0, i, "h", v, 0, 5) for i, v in enumerate(vals)],
                               "slide long, r long, c long, axis string, dx long, dy long, conf long")
    out = {r["c"]: r["dx"] for r in stitching.filter_abnormal_offset(df, 2).collect()}
    assert out == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: None}


def test_mad_border_cells(spark):
    rows = [(0, i, 10.0 * (i + 1), 10.0 * (i + 1), 50 + i, 5) for i in range(10)]
    df = spark.createDataFrame(rows, "chip long, cell_id long, cx double, cy double, area long, mid long")
    assert cells.mad_outliers(df).count() == 9  # the cell on the outer grid line belongs to no region
    assert cells.mad_outliers(df, keep_border=True).count() == 10


def test_local_threshold_brute(spark):
    img = RNG.integers(0, 256, (40, 50))
    rows = [(0, int(y), int(x), int(v)) for (y, x), v in np.ndenumerate(img)]
    got = images.local_threshold(spark.createDataFrame(rows, "img long, y long, x long, v long"), 7, 0.2, 128.0, size=16).collect()
    p = np.pad(img, 3).astype(float)
    want = set()
    for (y, x), v in np.ndenumerate(img):
        win = p[y:y + 7, x:x + 7]
        if v > win.mean() * (1 + 0.2 * (win.std() / 128 - 1)) + 1e-9:
            want.add((y, x))
    assert {(r["y"], r["x"]) for r in got} == want


def test_iterative_thresholds_split_two_modes(spark):
    h = np.zeros(256, dtype=int)
    for c in (60, 180):
        h[c - 15:c + 16] = 100 - 6 * np.abs(np.arange(-15, 16))
    px = [(0, i, 0, int(v)) for i, v in enumerate(np.repeat(np.arange(256), h))]
    df = spark.createDataFrame(px, "img long, y long, x long, v long")
    for m in ("otsu", "li", "isodata", "minimum", "yen", "entropy"):
        theta = images.hist_threshold(df, m).first()["theta"]
        assert 74 <= theta <= 166, m


def test_gmm_keeps_own_points_and_dedupes(spark):
    own = [(0, "g", 10 + i % 5, 10 + i // 5, 1 + i % 3, 1) for i in range(25)]
    back = [(0, "g", 12, 15, 2, 0), (0, "g", 59, 12, 2, 0), (0, "g", 12, 15, 2, 0)]
    df = spark.createDataFrame(own + back, "chip long, gene string, x long, y long, mid long, cell_id long")
    centre = spark.createDataFrame([(0, 1, 12, 12)], "chip long, cell_id long, cx long, cy long")
    got = {(r["x"], r["y"], r["mid"]) for r in cluster.gmm_correct(df, centre).collect()}
    assert {(x, y, m) for _, _, x, y, m, _ in own} <= got
    assert (12, 15, 2) in got and (59, 12, 2) not in got
    assert cluster.gmm_correct(df, centre).count() == len(got)


def test_scale_search_finds_scale(spark):
    lattice = [registration.track_prefix(registration.PITCH)[i % 9] + 2940 * (i // 9) for i in range(12)]
    pts = [(0, 0, 0, k, 1.2 * x, 1.2 * y) for k, (x, y) in enumerate(itertools.product(lattice, lattice))]
    df = spark.createDataFrame(pts, "chip long, fov_row long, fov_col long, id long, x double, y double")
    r = registration.scale_search(df, ("chip", "fov_row", "fov_col"), (0.9, 1.0, 1.1, 1.2, 1.3)).first()
    assert r["scale"] == 1.2 and r["votes"] == 3


def test_perspective_moves_corners(spark):
    src, dst = ((0, 0), (0, 10), (10, 10), (10, 0)), ((1, 2), (-1, 12), (13, 11), (12, 1))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in src], "x double, y double")
    got = [(r["x"], r["y"]) for r in geometry.perspective_points(df, src, dst).collect()]
    assert np.allclose(sorted(got), sorted(dst))


def test_reflected_landmarks(spark):
    p = RNG.normal(size=(6, 2)) * 50
    q = np.c_[-1.5 * p[:, 0], 2.0 * p[:, 1]] + [4, 9]
    df = spark.createDataFrame([(0, float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(p, q)],
                               "grp long, x double, y double, u double, v double")
    r = registration.landmark_fit(df).first()
    assert r["scale_x"] < 0 < r["scale_y"] and abs(r["angle"]) <= 90


def test_gmm_shuffles_a_background_point_once(spark, monkeypatch):
    """Points in the boxes of many cells, over tile borders, equal each cell's own candidates scored one by one."""
    rng = np.random.default_rng(4)
    cells_ = [(0, 1 + i, 12 * (i % 3) - 4, 12 * (i // 3)) for i in range(9)]
    rows = {(0, "ab"[int(g)], int(x), int(y), int(m), 0) for g, x, y, m in zip(
        rng.integers(0, 2, 300), rng.integers(-20, 45, 300), rng.integers(-15, 40, 300), rng.integers(1, 9, 300))}
    rows |= {(0, "a", cx + int(dx), cy + int(dy), int(m), cell) for _, cell, cx, cy in cells_[:8]
             for dx, dy, m in zip(rng.integers(-3, 4, 6), rng.integers(-3, 4, 6), rng.integers(1, 9, 6))}
    rows.add((0, "a", 0, 0, None, 0))
    r, thr, sent = 16, 12.0, []
    plain = cluster.group_apply
    monkeypatch.setattr(cluster, "group_apply", lambda df, keys, *a, **o: sent.append((keys, df)) or plain(df, keys, *a, **o))
    df = spark.createDataFrame(sorted(rows, key=str), "chip long, gene string, x long, y long, mid long, cell_id long")
    centre = spark.createDataFrame(cells_, "chip long, cell_id long, cx long, cy long")
    got = {tuple(v) for v in cluster.gmm_correct(df, centre, r, thr).collect()}
    tiles = [d for keys, d in sent if keys == ("chip", "ty", "tx")]
    assert len(tiles) == 1 and tiles[0].where("not site").count() == sum(v[5] == 0 for v in rows)
    want = {}
    top = {}
    for _, _, x, y, m, cell in rows:
        if cell == 0 and m is not None:
            top[x, y] = max(m, top.get((x, y), 0))
    for _, cell, cx, cy in cells_:
        box = [v for v in rows if abs(v[2] - cx) < r and abs(v[3] - cy) < r]
        own = [v for v in box if v[5] == cell]
        x = np.array([[v[2], v[3], v[4]] for v in own], float).reshape(-1, 3)
        able, mu, var, pi = cluster._fit_spherical(x, np.zeros(len(x), int), np.array([cell]), 3)
        claimed = list(own)
        if len(able):
            for v in (v for v in box if v[5] == 0 and (v[2], v[3]) in top):
                p = np.array([v[2], v[3], top[v[2], v[3]]], float)
                dens = sum(w * (2 * np.pi * s) ** -1.5 * np.exp(-((p - m) ** 2).sum() / (2 * s)) for m, s, w in zip(mu[0], var[0], pi[0]))
                if dens > np.exp(-thr):
                    claimed.append(v)
        for v in claimed:
            want[v[:5]] = min(cell, want.get(v[:5], cell))
    assert got == {(*k, c) for k, c in want.items()} and len(got) > 60
