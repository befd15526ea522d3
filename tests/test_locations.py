"""Fields of view: domains in turn, the refitted map, filled fields."""

import itertools
import random

import numpy as np
import pytest

from tissueframe.operators import stitching

JITTER = "slide long, r long, c long, axis string, dx double, dy double, conf long"
W, H = 100, 80


def located(spark, fields, jitter):
    fov = spark.createDataFrame([(0, r, c) for r, c in fields], "slide long, r long, c long")
    rows = [(0, r, c, a, None if d is None else float(d[0]), None if d is None else float(d[1]), 5) for (r, c, a), d in jitter.items()]
    got = stitching.fov_global_location(fov, spark.createDataFrame(rows, JITTER), W, H, 0.1).collect()
    assert len(got) == len(fields)
    return {(r["r"], r["c"]): (r["x"], r["y"]) for r in got}


def shifted(places):
    x0, y0 = min(x for x, _ in places.values()), min(y for _, y in places.values())
    return {f: (int(np.rint(x - x0)), int(np.rint(y - y0))) for f, (x, y) in places.items()}


def test_three_domains_and_isolated_fields_with_consistent_offsets(spark):
    """A tilted stage: every field lies on one linear map, so links, map and means all agree."""
    fields = list(itertools.product(range(7), range(9)))
    place = {(r, c): (92 * c - 2 * r, 71 * r + 3 * c) for r, c in fields}
    step = {"h": (92 - W, 3), "v": (-2, 71 - H)}
    alone = {(0, 8), (3, 4), (6, 0), (6, 1)}
    jitter = {}
    for r, c in fields:
        for axis, before in (("h", (r, c - 1)), ("v", (r - 1, c))):
            if before in place:
                apart = {(r, c), before} & alone or (axis == "h" and c in (3, 6)) or (axis == "v" and c >= 6 and r == 4)
                jitter[r, c, axis] = None if apart else step[axis]
    assert located(spark, fields, jitter) == shifted(place)


def plain(fields, jitter):
    """The rule again, on grids with NaN and whole refits by least squares."""
    rows, cols = max(r for r, _ in fields) + 1, max(c for _, c in fields) + 1
    have = np.zeros((rows, cols), bool)
    for f in fields:
        have[f] = True
    near = {f: [] for f in fields}
    for (r, c, a), d in jitter.items():
        b = (r, c - 1) if a == "h" else (r - 1, c)
        if d is not None and (r, c) in near and b in near:
            e = np.array(d, float) + ((W, 0) if a == "h" else (0, H))
            near[b].append(((r, c), e))
            near[r, c].append((b, -e))
    left, parts = {f for f in fields if near[f]}, []
    while left:
        part, stack = set(), [min(left)]
        while stack:
            f = stack.pop()
            if f not in part:
                part.add(f)
                stack += [g for g, _ in near[f]]
        parts.append(sorted(part))
        left -= part
    nominal = {(r, c): np.array([c * (W - W // 10), r * (H - H // 10)], float) for r, c in fields}
    loc = {}
    if parts:
        parts.sort(key=lambda p: (-len(p), p[0]))
        walk, ring = {parts[0][0]: 0}, [parts[0][0]]
        while ring:
            ring = sorted({(r + a, c + b) for r, c in ring for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))} & near.keys() - walk.keys())
            walk |= dict.fromkeys(ring, max(walk.values()) + 1)
        parts = [parts[0], *sorted(parts[1:], key=lambda p: min((walk.get(f, 10**6), f) for f in p))]
    for part in parts:
        mid = np.mean(part, axis=0)
        start = min(part, key=lambda f: (round(float(((np.array(f) - mid) ** 2).sum()), 9), f))
        if loc:
            x, y = np.array([nominal[f] for f in loc]), np.array([loc[f] for f in loc])
            slope = np.linalg.lstsq(x - x.mean(0), y - y.mean(0), rcond=None)[0]
            loc[start] = y.mean(0) + (nominal[start] - x.mean(0)) @ slope
        else:
            loc[start] = nominal[start]
        ring, done = [start], {start}
        while ring:
            said = {}
            for f in ring:
                for g, e in near[f]:
                    if g not in done:
                        said.setdefault(g, []).append(loc[f] + e)
            loc |= {g: np.mean(v, axis=0) for g, v in said.items()}
            ring = list(said)
            done |= said.keys()
    good = [(k, np.array(d, float)) for k, d in jitter.items() if d is not None]

    def mean(axis, at, number):
        own = [d for (r, c, a), d in good if a == axis and (r, c)[at] == number] or [d for (_, _, a), d in good if a == axis]
        return np.mean(own, axis=0) if own else np.array([-(W // 10), 0.0] if axis == "h" else [0.0, -(H // 10)])

    while True:
        new = {}
        for r, c in near.keys() - loc.keys():
            h, v = mean("h", 1, c) + (W, 0), mean("v", 0, r) + (0, H)
            said = [loc[g] + e for g, e in (((r + 1, c), -v), ((r - 1, c), v), ((r, c + 1), -h), ((r, c - 1), h)) if g in loc]
            if said:
                new[r, c] = np.mean(said, axis=0)
        if not new:
            break
        loc |= new
    for f in near.keys() - loc.keys():
        loc[f] = nominal[f]
    return loc


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_rule_on_grids_for_inconsistent_offsets(spark, seed):
    rng = random.Random(seed)
    fields = [f for f in itertools.product(range(6), range(7)) if rng.random() > 0.05]
    jitter = {(r, c, a): None if rng.random() < 0.45 else (rng.randint(-16, -4) if a == "h" else rng.randint(-3, 3),
                                                         rng.randint(-3, 3) if a == "h" else rng.randint(-12, -4))
              for r, c in itertools.product(range(6), range(7)) for a in "hv" if (c if a == "h" else r) > 0}
    got, loc = located(spark, fields, jitter), plain(fields, jitter)
    x0, y0 = min(x for x, _ in loc.values()), min(y for _, y in loc.values())
    assert all(abs(got[f][0] - (x - x0)) <= 0.5 + 1e-6 and abs(got[f][1] - (y - y0)) <= 0.5 + 1e-6 for f, (x, y) in loc.items())


def test_without_any_link_the_nominal_places_stay(spark):
    fields = list(itertools.product(range(2), range(3)))
    assert located(spark, fields, {(0, 1, "h"): None}) == {(r, c): (90 * c, 72 * r) for r, c in fields}
    empty = stitching.fov_global_location(spark.createDataFrame([], "slide long, r long, c long"), spark.createDataFrame([], JITTER), W, H)
    assert empty.count() == 0
