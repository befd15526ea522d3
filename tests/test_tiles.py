"""Operators on tiles against brute force, with tiles small enough that every border is crossed."""

import numpy as np
import pytest

from tissueframe.operators import morphology, registration

RUNS = "chip long, label long, y long, x0 long, x1 long"


def as_runs(mask, chip=1):
    return [(chip, int(v), y - 7, x - 9, x - 9) for (y, x), v in np.ndenumerate(mask) if v]


@pytest.mark.parametrize("r", [1, 4, 13])
def test_distance_band(spark, r):
    on = np.random.default_rng(r).random((30, 26)) < 0.01
    on[3, 4:20] = True
    rows = as_runs(on.astype(int))
    got = {(p["y"], p["x"]): p["d2"] for p in morphology.distance_band(
        spark.createDataFrame(rows + rows[:5], RUNS), r, size=11).collect()}
    objects = {(y, x) for _, _, y, x, _ in rows}
    want = {}
    for y in range(-7 - r, 24 + r):
        for x in range(-9 - r, 18 + r):
            d2 = min((y - a) ** 2 + (x - b) ** 2 for a, b in objects)
            if 0 < d2 <= r * r:
                want[y, x] = d2
    assert got == want
    assert morphology.distance_band(spark.createDataFrame([], RUNS), r).count() == 0


def grown(label, r):
    """Synchronous growth, pixel by pixel."""
    start, label = dict(label), dict(label)
    ring = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]
    for _ in range(r):
        fresh = {}
        for y, x in {(y + a, x + b) for y, x in label for a, b in ring} - set(label):
            near = {label[y + a, x + b] for a, b in ring if (y + a, x + b) in label}
            if len(near) == 1 and min((y - a) ** 2 + (x - b) ** 2 for a, b in start) <= r * r:
                fresh[y, x] = near.pop()
        label |= {p: v for p, v in fresh.items() if all(fresh.get((p[0] + a, p[1] + b), v) >= v for a, b in ring)}
    return label


@pytest.mark.parametrize("r", [1, 3, 6])
def test_expand_labels(spark, r):
    rng = np.random.default_rng(r)
    seed = np.where(rng.random((28, 25)) < 0.02, rng.integers(1, 1 << 40, (28, 25)), 0)
    rows = as_runs(seed)
    out = morphology.expand_labels(spark.createDataFrame(rows, RUNS), r, labelled=True, size=9).collect()
    got = {(p["y"], x): p["label"] for p in out for x in range(p["x0"], p["x1"] + 1)}
    assert got == grown({(y, x): v for _, v, y, x, _ in rows}, r)


def image(rng, n, low, kind=int):
    at = rng.choice(40 * 37, n, replace=False)
    return [("a", int(p // 37) - 12, int(p % 37) - 8, kind(rng.integers(low, 9))) for p in at]


@pytest.mark.parametrize("k", [1, 4])
def test_max_filter(spark, k):
    rows = image(np.random.default_rng(k), 60, -5)
    rows.append((*rows[0][:3], rows[0][3] + 3))
    got = {(p["y"], p["x"]): p["v"] for p in registration.max_filter(
        spark.createDataFrame(rows, "img string, y long, x long, v long"), k, size=6).collect()}
    want = {}
    for _, y, x, v in rows:
        for a in range(y - k, y + k + 1):
            for b in range(x - k, x + k + 1):
                want[a, b] = max(v, want.get((a, b), v))
    assert got == want


@pytest.mark.parametrize("method", ["product", "absdiff"])
@pytest.mark.parametrize("kind", [int, float])
def test_align_score(spark, method, kind):
    rng, (h, w) = np.random.default_rng(5), (31, 33)
    fixed, moving = image(rng, 300, 0, kind), image(rng, 200, 0, kind)
    schema = "img string, y long, x long, v " + ("long" if kind is int else "double")
    moves = [(r, dx, dy) for r in (0, 1, 2, 3) for dx in (-13, 0, 2) for dy in (-1, 0, 55)]
    got = {(p["rot"], p["dx"], p["dy"]): p["score"] for p in registration.align_score(
        spark.createDataFrame(fixed, schema), spark.createDataFrame(moving, schema), moves, method, (h, w), size=8).collect()}
    a = {(y, x): v for _, y, x, v in fixed}
    b = {(y, x): v for _, y, x, v in moving}
    if method == "absdiff":
        wide = {}
        for (y, x), v in b.items():
            for p in range(y - 4, y + 5):
                for q in range(x - 4, x + 5):
                    wide[p, q] = max(v, wide.get((p, q), v))
        b = wide
    turn = {0: lambda y, x: (y, x), 1: lambda y, x: (x, h - y), 2: lambda y, x: (h - y, w - x), 3: lambda y, x: (w - x, y)}
    want = {}
    for r, dx, dy in moves:
        put = {(turn[r](y, x)[0] + dy, turn[r](y, x)[1] + dx): v for (y, x), v in b.items()}
        want[r, dx, dy] = (sum(a[p] * v for p, v in put.items() if p in a) if method == "product"
                           else sum(abs(a.get(p, 0) - put.get(p, 0)) for p in a.keys() | put.keys()))
    assert got == want
