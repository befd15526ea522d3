import numpy as np
import pytest
from conftest import flood
from pyspark.sql import functions as F

from tissueframe.operators import components, masks, morphology
from tissueframe.operators.components import STRIDE
from tissueframe.plans import islands
from tissueframe.plans.buckets import overlap_pairs, points_in_runs

RNG = np.random.default_rng(3)


def noise(h=40, w=70, p=0.55, seed=0):
    return (np.random.default_rng(seed).random((h, w)) < p).astype(int)


@pytest.mark.parametrize("conn", [4, 8])
def test_components_match_flood_fill_across_tiles(grid, conn):
    mask = noise(p=0.5 if conn == 8 else 0.6, seed=conn)
    want = flood(mask, conn)
    got = grid.dense(components.connected_components(grid.runs(mask), conn, size=16), mask.shape)
    assert ((got > 0) == (mask > 0)).all()
    for n in range(1, want.max() + 1):
        y, x = np.nonzero(want == n)
        assert set(got[y, x]) == {y[0] * STRIDE + x[0] + 1}


def test_diagonal_contact(grid):
    mask = np.eye(6, dtype=int)
    count = lambda conn: components.connected_components(grid.runs(mask), conn, size=4).select("label").distinct().count()
    assert (count(4), count(8)) == (6, 1)


def test_long_spiral_settles(grid):
    mask = np.zeros((33, 33), dtype=int)
    mask[::4, :] = 1
    for i, y in enumerate(range(0, 29, 4)):
        mask[y:y + 4, -1 if i % 2 == 0 else 0] = 1
    assert components.connected_components(grid.runs(mask), 4, size=8).select("label").distinct().count() == 1


def test_subtract_union_and_iou(grid):
    a, b = noise(seed=1), noise(seed=2)
    got = grid.dense(islands.subtract(grid.runs(a), grid.runs(b)), a.shape)
    assert (got == (a & ~b.astype(bool))).all()
    assert (grid.dense(masks.mask_union(grid.runs(a), grid.runs(b)), a.shape) == (a | b)).all()
    iou = masks.mask_iou(grid.runs(a), grid.runs(b)).first()["iou"]
    assert iou == pytest.approx((a & b).sum() / ((a | b).sum() + 1e-5))


def test_subtract_over_bucket_borders(grid):
    a = np.ones((3, 400), dtype=int)
    b = np.zeros((3, 400), dtype=int)
    b[1, 100:300], b[2, ::7] = 1, 1
    assert (grid.dense(islands.subtract(grid.runs(a), grid.runs(b)), a.shape) == a - b).all()


@pytest.mark.parametrize("k", [1, 3])
def test_dilate_erode_outline(grid, k):
    mask = flood(noise(p=0.3, seed=5), 8)
    on = mask > 0
    pad = np.pad(on, k)
    win = [pad[k + dy:k + dy + on.shape[0], k + dx:k + dx + on.shape[1]] for dy in range(-k, k + 1) for dx in range(-k, k + 1)]
    got = morphology.dilate(grid.runs(mask), k)
    big = np.zeros(np.add(on.shape, 2 * k), dtype=bool)
    for r in got.collect():
        big[r["y"] + k, r["x0"] + k:r["x1"] + k + 1] = True
    want = np.zeros_like(big)
    for y, x in zip(*np.nonzero(on)):
        want[y:y + 2 * k + 1, x:x + 2 * k + 1] = True
    assert (big == want).all()
    solid = np.ones((20, 30), dtype=int)
    solid[5, 5] = 0
    on, pad = solid > 0, np.pad(solid > 0, k)
    win = [pad[k + dy:k + dy + 20, k + dx:k + dx + 30] for dy in range(-k, k + 1) for dx in range(-k, k + 1)]
    assert (grid.dense(morphology.erode(grid.runs(solid), k), solid.shape) == np.logical_and.reduce(win)).all()
    p = np.pad(mask, 1)
    inner = np.logical_and.reduce([p[1 + dy:p.shape[0] - 1 + dy, 1 + dx:p.shape[1] - 1 + dx] == mask
                                   for dy, dx in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    assert (grid.dense(morphology.outline(grid.runs(mask)), mask.shape) == np.where(inner, 0, mask)).all()


def test_expand_keeps_gap_and_reach(grid):
    seeds = np.zeros((60, 80), dtype=int)
    pts = RNG.integers(5, 55, (25, 2))
    for y, x in pts:
        seeds[y:y + 2, x:x + 3] = 1
    labels = flood(seeds, 8)
    r = 5
    small = grid.dense(morphology.expand_labels(grid.runs(labels), r, labelled=True, size=16), labels.shape + np.array([20, 20]))
    large = grid.dense(morphology.expand_labels(grid.runs(labels), r, labelled=True), labels.shape + np.array([20, 20]))
    assert (small == large).all()  # tiles do not change the result
    got = small[:60, :80]
    assert (got[labels > 0] == labels[labels > 0]).all()
    ys, xs = np.nonzero(labels)
    for y, x in zip(*np.nonzero(got)):
        own = labels[ys, xs] == got[y, x]
        assert ((ys - y) ** 2 + (xs - x) ** 2).min() <= r * r and own.any()
    p = np.pad(got, 1)
    for dy in (0, 1):
        for dx in (-1, 0, 1):
            other = p[1 + dy:p.shape[0] - 1 + dy, 1 + dx:p.shape[1] - 1 + dx]
            assert not ((other > 0) & (got > 0) & (other != got)).any()


def test_expand_two_seeds_leave_gap(grid):
    a = np.zeros((9, 20), dtype=int)
    a[4, 5], a[4, 8] = 1, 1
    got = grid.dense(morphology.expand_labels(grid.runs(a), 3), (20, 30))
    assert len(np.unique(got[got > 0])) == 2
    assert (got[:9, 6:8] == 0).any()


def test_fill_holes(grid):
    a = np.ones((30, 40), dtype=int)
    a[3:6, 4:9], a[10:20, 10:30], a[25:, 35] = 0, 0, 0
    a[0, 0] = 0
    want = a.copy()
    want[3:6, 4:9] = 1
    assert (grid.dense(morphology.fill_holes(grid.runs(a), 50), a.shape) == want).all()
    want[10:20, 10:30] = 1
    assert (grid.dense(morphology.fill_holes(grid.runs(a)), a.shape) == want).all()


def brute_overlap_merge(sec, pri, thr, min_size=15):
    left = flood((sec > 0) & (pri == 0), 4)
    for n in range(1, left.max() + 1):
        if (left == n).sum() < min_size:
            left[left == n] = 0
    objects, kept = flood(sec, 8), np.zeros_like(left)
    for n in range(1, objects.max() + 1):
        inside = flood((left > 0) & (objects == n), 4)
        for m in range(1, inside.max() + 1):
            if (inside == m).sum() / (objects == n).sum() >= thr:
                kept[inside == m] = 1
    p = np.pad(kept, 1)
    edge = (kept > 0) & np.logical_or.reduce([p[1 + dy:p.shape[0] - 1 + dy, 1 + dx:p.shape[1] - 1 + dx] == 0
                                              for dy, dx in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    return kept, np.where(edge, 0, ((pri > 0) | (kept > 0)).astype(int))


def test_overlap_merge_matches_brute_force(grid):
    sec, pri = np.zeros((60, 90), dtype=int), np.zeros((60, 90), dtype=int)
    for i, (y, x) in enumerate((y, x) for y in (4, 24, 44) for x in (4, 24, 44, 64)):
        sec[y:y + 12, x:x + 12] = 1
        pri[y + i:y + i + 6, x + 2:x + 16] = 1
    kept, merged = masks.overlap_merge(grid.runs(sec), grid.runs(pri), 0.3)
    want_kept, want = brute_overlap_merge(sec, pri, 0.3)
    assert (grid.dense(kept, sec.shape) == want_kept).all()
    assert (grid.dense(merged, sec.shape) == want).all()


def test_keep_large_fragments_keeps_outside(grid):
    orig, frag = np.zeros((10, 30), dtype=int), np.zeros((10, 30), dtype=int)
    orig[2:8, 2:12] = 1
    frag[2:8, 2:4], frag[2:8, 6:12], frag[2:5, 20:25] = 1, 1, 1
    want = frag.copy()
    want[2:8, 2:4] = 0  # 12 of 60 pixels
    assert (grid.dense(masks.keep_large_fragments(grid.runs(orig), grid.runs(frag), 0.4), orig.shape) == want).all()


def test_merge_layers_branches(grid):
    empty = grid.runs(np.zeros((1, 1)))
    box = np.zeros((30, 30), dtype=int)
    box[5:12, 5:12] = 1
    cell, _ = masks.merge_layers(empty, grid.runs(box), empty, empty)
    assert cell.agg(F.sum(F.col("x1") - F.col("x0") + 1)).first()[0] == 49
    cell, core = masks.merge_layers(grid.runs(box), empty, empty, empty, r=2)
    grown = grid.dense(cell, (30, 30)) > 0
    assert grown[box > 0].all() and grown.sum() > 49
    assert ((grid.dense(core, (30, 30)) > 0) == (box > 0)).all()


def test_split_multi_cells(grid):
    src, ref = np.zeros((20, 50), dtype=int), np.zeros((20, 50), dtype=int)
    src[5:15, 5:35], src[5:10, 40:45] = 1, 2
    ref[9:11, 9:11], ref[9:11, 28:30], ref[6:8, 41:43] = 1, 2, 3
    got = grid.dense(masks.split_multi_cells(grid.runs(src), grid.runs(ref)), src.shape) > 0
    assert got[5:10, 40:45].all()
    part = flood(got, 8)
    assert part.max() == 3 and part[10, 10] != part[10, 29]
    assert (~got[5:15, 5:35]).sum() == 20  # two pixel columns of seam


def test_best_partner_tie_takes_larger_label(grid):
    a = np.ones((2, 4), dtype=int)
    b = np.array([[1, 1, 2, 2], [1, 1, 2, 2]])
    rows = {(r["direction"], r["label"]): r["partner"] for r in masks.largest_overlap_map(grid.runs(a), grid.runs(b)).collect()}
    assert rows[("a_to_b", 1)] == 2


def test_tissue_holes_drop_cells(grid):
    tissue = np.ones((10, 20), dtype=int)
    tissue[4, 4] = 0
    cell = np.zeros((10, 20), dtype=int)
    cell[3:6, 3:6], cell[3:6, 10:13] = 1, 2
    kept = masks.cells_inside_tissue(grid.runs(cell), grid.runs(tissue))
    assert {r["label"] for r in kept.collect()} == {2}


def test_point_assignment_with_hot_spot(spark, grid):
    """A third of all points on one pixel; every point is kept exactly once."""
    labels = flood(noise(p=0.4, seed=9), 4)
    pts = [(0, 7, 9)] * 1000 + [(0, int(y), int(x)) for y, x in RNG.integers(0, 40, (2000, 2))]
    df = spark.createDataFrame(pts, "chip long, y long, x long")
    got = points_in_runs(df, grid.runs(labels), "left")
    assert got.count() == 3000
    for r in got.distinct().collect():
        assert (r["label"] or 0) == labels[r["y"], r["x"]]


def test_overlap_pairs_conserve_area(grid):
    a, b = flood(noise(seed=11), 4), flood(noise(seed=12), 8)
    got = {(r["label_a"], r["label_b"]): r["cnt"] for r in overlap_pairs(grid.runs(a), grid.runs(b), size=16).collect()}
    both = (a > 0) & (b > 0)
    pairs, n = np.unique(np.stack([a[both], b[both]]), axis=1, return_counts=True)
    assert got == {(int(p), int(q)): int(c) for (p, q), c in zip(pairs.T, n)}


def test_consecutive_labels_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 2, 1000 - 7 * i) for i in range(100)], "chip long, label long")
    one = sorted(map(tuple, components.consecutive_labels(df.repartition(1)).collect()))
    many = sorted(map(tuple, components.consecutive_labels(df.repartition(9)).collect()))
    assert one == many
    for chip in (0, 1):
        new = [n for c, _, n in one if c == chip]
        assert new == list(range(1, len(new) + 1))


def test_components_of_runs_that_overlap_and_repeat(grid, spark):
    rng = np.random.default_rng(5)
    rows = [(0, int(n), int(y), int(x), int(x + w)) for n, y, x, w in
            zip(rng.integers(1, 9, 120), rng.integers(-6, 20, 120), rng.integers(-9, 25, 120), rng.integers(0, 9, 120))]
    mask = np.zeros((30, 50), int)
    for _, _, y, x0, x1 in rows:
        mask[y + 8, x0 + 10:x1 + 11] = 1
    got = components.connected_components(spark.createDataFrame(rows + rows[:40], grid.schema), 4, size=8).collect()
    seen = np.zeros(mask.shape, int)
    for r in got:
        assert (seen[r.y + 8, r.x0 + 10:r.x1 + 11] == 0).all()
        seen[r.y + 8, r.x0 + 10:r.x1 + 11] = r.label + (1 << 40)
    want = flood(mask, 4)
    assert ((seen > 0) == (want > 0)).all()
    assert len({(a, b) for a, b in zip(seen[mask > 0], want[mask > 0])}) == want.max() == len({r.label for r in got})
    for r in got:
        y, x = (spark.range(1).select(*components.first_pixel(F.lit(r.label))).first())
        assert seen[y + 8, x + 10] == r.label + (1 << 40)
        break


def test_split_of_few_and_many_centroids_is_the_same(grid, spark, monkeypatch):
    rng = np.random.default_rng(6)
    src, ref = np.zeros((40, 300), int), np.zeros((40, 300), int)
    src[2:20, 5:290], src[24:38, 3:40], src[24:38, 60:90] = 7, 8, 9
    for n, (y, x) in enumerate([(4, 9), (4, 60), (12, 140), (15, 131), (8, 250), (26, 6), (33, 30), (30, 70)], 1):
        ref[y:y + 1 + n % 3, x:x + 2 + n % 2] = n
    one = sorted(map(tuple, masks.split_multi_cells(grid.runs(src), grid.runs(ref)).collect()))
    monkeypatch.setattr(masks, "FEW_SITES", 2)
    two = sorted(map(tuple, masks.split_multi_cells(grid.runs(src), grid.runs(ref)).collect()))
    monkeypatch.setattr(masks, "FEW_SITES", 0)
    assert one == two == sorted(map(tuple, masks.split_multi_cells(grid.runs(src), grid.runs(ref)).collect()))
    assert sum(r[4] - r[3] + 1 for r in one) < (src > 0).sum()


def test_run_owners_shuffle_no_pixels(grid, monkeypatch):
    """Objects of few centroids are cut run by run: the pixels of their runs are never rows."""
    src, ref = np.ones((4, 40), int), np.zeros((4, 40), int)
    ref[1, 3], ref[1, 30] = 1, 2
    monkeypatch.setattr(masks, "pixels_from_runs", lambda *a: pytest.fail("pixels became rows"))
    got = masks.split_multi_cells(grid.runs(src), grid.runs(ref))
    assert sorted((r.y, r.x0, r.x1) for r in got.collect()) == sorted(
        (y, a, b) for y in range(4) for a, b in ((0, 15), (18, 39)))
