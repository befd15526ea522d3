import numpy as np
import pytest

from tissueframe import jobs
from tissueframe.operators import registration


def test_slides_from_file_names_to_mosaic(spark):
    rows, cols, side, step = 2, 3, 10, 9
    paths = spark.createDataFrame([(0, f"/a/0/img_{r + 1}_{c + 1}_z.tif") for r in range(rows) for c in range(cols)], "slide long, path string")
    jitter = spark.createDataFrame(
        [(0, r, c, "h", -1, 0, 9) for r in range(rows) for c in range(1, cols)] + [(0, 1, c, "v", 0, -1, 9) for c in range(cols)],
        "slide long, r long, c long, axis string, dx long, dy long, conf long")
    pixels = spark.createDataFrame([(0, r, c, y, x, 10 * r + c + 1) for r in range(rows) for c in range(cols)
                                    for y in range(side) for x in range(side)],
                                   "slide long, r long, c long, y long, x long, v long")
    want = np.zeros((step * (rows - 1) + side, step * (cols - 1) + side), dtype=int)
    for r in range(rows):
        for c in range(cols):
            want[r * step:r * step + side, c * step:c * step + side] = 10 * r + c + 1
    for line in (False, True):
        out = jobs.stitch_slides(paths, jitter, pixels, side, side, cols, pattern="*_{x}_{x}_*", index0=False, line_scan=line)
        got = np.zeros_like(want)
        for p in out["mosaic"].collect():
            got[p["y"], p["x"]] = p["v"]
        assert (got == want).all()
    snake = jobs.stitch_slides(paths, jitter, pixels, side, side, cols, pattern="*_{x}_{x}_*", index0=False, snake=(rows, "RD"))
    place = {f["path"]: (f["r"], f["c"]) for f in snake["fov"].collect()}
    assert place["/a/0/img_1_1_z.tif"] == (0, 0) and place["/a/0/img_2_1_z.tif"] == (1, 2) and len(set(place.values())) == rows * cols


def test_field_fit_measures_the_mosaic_not_the_fields(spark):
    half = [(0, f, i * 4 + j, 10 * i, 10 * j, 0.9) for f in (0, 1) for i in range(2) for j in range(4)]
    track = spark.createDataFrame([(1, *p) for p in half] + [(2, 0, 0, k, 10 * k, 0, 0.9) for k in range(3)]
                                  + [(1, 0, 0, 99, 90, 90, 0.2)],
                                  "chip long, fov_row long, fov_col long, id long, x long, y long, conf double")
    boxes = spark.createDataFrame([(1, 0, 0, 0, 0), (1, 0, 1, 20, 0), (2, 0, 0, 0, 0)],
                                  "chip long, fov_row long, fov_col long, x0 long, y0 long")
    out = jobs.field_fit(track, boxes, (100, 100), (1.0,), 11, min_area=0.05)
    got = {r["chip"]: (round(r["area_ratio"], 6), r["passed"]) for r in out["area"].collect()}
    assert got == {1: (0.09, True), 2: (0.0, False)}
    assert out["points"].where("chip = 1").count() == 16
    assert {r["scale"] for r in out["scale"].collect()} == {1.0}


def test_register_points(spark):
    template = spark.createDataFrame([(1, 50, 50, 0, 0), (1, 80, 50, 1, 0), (1, 50, 80, 0, 1)], "chip long, x long, y long, ix long, iy long")
    found = spark.createDataFrame([(1, 0, 52, 49), (1, 1, 82, 49), (1, 2, 52, 79), (1, 3, 20, 20)], "chip long, id long, x long, y long")
    out = jobs.register_points(found, template, (100, 100), (50, 50))
    assert sorted(r["id"] for r in out["pairs"].collect()) == [0, 1, 2]
    off, turn = out["offset"].first(), out["turn"].first()
    assert (off["dx"], off["dy"]) == (-2.0, 1.0)
    assert (turn["rot"], turn["offset_x"], turn["offset_y"], turn["dist"]) == (0, 0, 0, 0.0)


def test_written_matrix_and_variants(spark, grid, tmp_path):
    mask = np.zeros((8, 8), dtype=int)
    mask[1:3, 1:3], mask[5:7, 5:7] = 1, 2
    wide = np.zeros((8, 8), dtype=int)
    wide[0:4, 0:4], wide[4:8, 4:8] = 1, 2
    tissue = np.ones((8, 8), dtype=int)
    tissue[:, 7] = 0
    points = spark.createDataFrame([(0, "a", 1, 1, 2), (0, "b", 3, 0, 5), (0, "a", 6, 6, 1), (0, "b", 7, 7, 9)],
                                   "chip long, gene string, x long, y long, mid long")
    tables = jobs.extract_matrix(points, grid.runs(tissue), grid.runs(mask), grid.runs(wide))
    jobs.write_matrix(tables, f"{tmp_path}/m")
    cell = {r["cell_id"]: (r["area"], r["mid"]) for r in spark.read.parquet(f"{tmp_path}/m/cell/cell").collect()}
    core = {r["cell_id"]: (r["area"], r["mid"]) for r in spark.read.parquet(f"{tmp_path}/m/nuclear/cell").collect()}
    assert cell == {1: (16, 7), 2: (16, 1)} and core == {1: (4, 2), 2: (4, 1)}
    variants = {"nuclear": grid.runs(mask), "cell": grid.runs(wide)}
    got = {r["variant"]: r["value"] for r in jobs.metrics_by_variant(points, variants, grid.runs(tissue), radius=2)
           .where("section = 'area' and name = 'ratio'").collect()}
    assert got == {"nuclear": pytest.approx(8 / 56), "cell": pytest.approx(28 / 56)}
    pixels = points.selectExpr("chip", "y", "x", "mid v")
    out = jobs.metrics_tables(points, variants, grid.runs(tissue), pixels, size=4, width=0.25)
    heat = sorted((r["variant"], r["by"], r["bx"], r["mid"]) for r in out["heatmap"].collect())
    assert heat == [("cell", 0, 0, 7), ("cell", 1, 1, 1), ("nuclear", 0, 0, 2), ("nuclear", 1, 1, 1), ("tissue", 0, 0, 7), ("tissue", 1, 1, 1)]
    assert {r["variant"]: r["ratio"] for r in out["ratio"].collect()} == {"nuclear": 3 / 8, "cell": 1.0}
    bins = sorted((r["variant"], r["bin"], r["n"]) for r in out["intensity"].collect())
    assert bins == [("cell", 1, 1), ("cell", 2, 1), ("nuclear", 1, 1), ("nuclear", 2, 1)]


@pytest.mark.parametrize("support, step, box", [(10, 4, 24), (1, 4, 16), (3, 2, 10)])
def test_chip_box_equals_every_box(spark, support, step, box):
    rng = np.random.default_rng(support)
    rows = [(c, int(x), int(y), 1) for c in (1, 2) for x, y in rng.integers(0, 60, (25 * c, 2))] + [(3, 47, 47, 1)] + [(4, 2, 2, 1)]
    df = spark.createDataFrame(rows, "chip long, x long, y long, mid long")
    got = {r["chip"]: (r["x"], r["y"], r["covered"]) for r in registration.chip_box_from_expression(df, box, support, step).collect()}
    side, want = box // step, {}
    for chip in (1, 2, 3, 4):
        spots = [(x, y) for c, x, y, _ in rows if c == chip]
        gw, gh = (max(x for x, _ in spots) + 1) // step, (max(y for _, y in spots) + 1) // step
        near = lambda g, p: abs(g * step + step // 2 - p) <= support
        on = np.array([[any(near(gx, x) and near(gy, y) for x, y in spots) for gx in range(gw)] for gy in range(gh)]).reshape(gh, gw)
        boxes = [(-int(on[y:y + side, x:x + side].sum()), y, x) for y in range(gh - side) for x in range(gw - side)]
        if boxes:
            t, y, x = min(boxes)
            want[chip] = (x * step, y * step, -t)
    assert got == want
