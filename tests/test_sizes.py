"""Plans and memory of steps whose tables grow: nothing that an explode made is broadcast."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tissueframe.catalog.bindings import Tables
from tissueframe.operators import cells, masks, registration
from tissueframe.plans.buckets import overlap_pairs, points_in_runs
from tissueframe.plans.islands import merge_runs, pixels_from_runs, subtract


def plan(df) -> str:
    """The physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def stored(spark, tmp_path):
    """Tables read from files, as the planner knows their size."""
    def write(rows, schema):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return spark.read.parquet(path)
    return write


@pytest.fixture
def runs(stored):
    return stored([(0, 1, 0, 0, 300), (0, 2, 1, 5, 9)], "chip long, label long, y long, x0 long, x1 long")


@pytest.fixture
def points(stored):
    return stored([(0, 1, 4, 0), (0, 2, 200, 0), (0, 3, 7, 1), (0, 4, 50, 5)], "chip long, id long, x long, y long")


def test_points_in_runs_shuffles_both_sides(runs, points):
    got = points_in_runs(points, runs, "inner")
    assert "Broadcast" not in plan(got)
    assert sorted((r.id, r.label) for r in got.collect()) == [(1, 1), (2, 1), (3, 2)]
    semi = points_in_runs(points, runs, "left_semi")
    assert "Broadcast" not in plan(semi) and sorted(r.id for r in semi.collect()) == [1, 2, 3]


def test_overlaps_and_areas_shuffle_both_sides(runs):
    assert "Broadcast" not in plan(overlap_pairs(runs, runs))
    got = masks.overlap_fraction(runs, runs, "b")
    assert "Broadcast" not in plan(got)
    assert sorted((r.label, r.partner, r.fraction) for r in got.collect()) == [(1, 1, 1.0), (2, 2, 1.0)]


def test_near_join_shuffles_both_sides(points):
    sites = points.select("chip", F.col("id").alias("ix"), F.lit(0).alias("iy"), (F.col("x") + 1).alias("x"), "y")
    got = registration.pair_nearest(points, sites, 10)
    assert "Broadcast" not in plan(got)
    assert sorted((r.id, r.ix, r.dist) for r in got.collect()) == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (4, 4, 1.0)]


def test_cell_flags_shuffle_both_sides(stored):
    matrix = stored([(0, 1, "a", 3), (0, 2, "b", 4)], "chip long, cell_id long, gene string, mid long")
    flags = stored([(0, 1, 0), (0, 2, 1)], "chip long, cell_id long, flag int")
    got = cells.filter_cells_by_list(matrix, flags)
    assert "Broadcast" not in plan(got) and [r.cell_id for r in got.collect()] == [1]


def test_runs_shuffle_once_before_they_gather(runs):
    got = merge_runs(runs)
    text = plan(got)
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text
    # nothing is gathered in the task that reads the files
    assert "HashAggregate" not in text[text.index("Exchange"):]
    assert sorted((r.label, r.x0, r.x1) for r in got.collect()) == [(1, 0, 300), (2, 5, 9)]
    free = plan(subtract(runs, runs.where("label = 2")))
    assert "Aggregate" not in free[free.rindex("Union"):]


def test_pixels_are_dealt_before_the_explode(runs):
    got = pixels_from_runs(runs)
    text = plan(got)
    assert text.index("Generate") < text.index("REPARTITION_BY_NUM")
    assert got.count() == 306


def test_rotation_is_tried_on_dealt_points(stored):
    rows = [(0, 0, 0, i, 12 * i, 12 * i) for i in range(6)]
    track = stored(rows, "chip long, fov_row long, fov_col long, id long, x long, y long")
    got = registration.rotate_search(track, ("chip", "fov_row", "fov_col"))
    assert "REPARTITION_BY_NUM" in plan(got)
    assert len(got.collect()) == 1


def test_bindings_shuffle_what_grows(spark, tmp_path):
    """The points' joins with orders, cells and parts, whose files are small and whose rows are not."""
    tables = {
        "customer": ([(0, 3, 1.0, "BUILDING"), (1, 7, -1.0, "MACHINERY")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": ([(5, 0), (6, 1), (6, 1), (None, 1)], "o_orderkey long, o_custkey long"),
        "part": ([(2, "a"), (3, None), (None, "b")], "p_partkey long, p_brand string"),
        "lineitem": ([(5, 2, 1, 1, 4.0, 9.0), (6, 3, 1, 1, 2.0, 9.0), (None, 2, 1, 1, 1.0, 9.0), (6, None, 1, 2, 1.0, 9.0)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    for points in (t.expression, t.transcript):
        assert "Broadcast" not in plan(points)
    assert sorted((r.chip, r.gene or "", r.mid) for r in t.expression.collect()) == [(0, "", 2), (0, "", 2), (0, "a", 4)]
    assert sorted((r.l_orderkey or 0, r.feature_name or "") for r in t.transcript.collect()) == [(0, "a"), (5, "a"), (6, "")]


def tasks_of(df, fn: str) -> int:
    """Tasks that the step with the Python function ``fn`` gets, whatever the size of its input."""
    text = plan(df)
    at = text.index(fn)
    return int(re.search(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", text[at:]).group(1))


def test_tiles_are_dealt_to_a_fixed_number_of_tasks(runs):
    from tissueframe.plans.tiles import map_label_tiles
    runs.sparkSession.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = map_label_tiles(runs, lambda a: a, 0, whole=False)
        assert tasks_of(got, "FlatMapGroupsInPandas") == 4  # a quarter, not put together
        assert sorted((r.label, r.y, r.x0, r.x1) for r in got.collect()) == [(1, 0, 0, 300), (2, 1, 5, 9)]
    finally:
        runs.sparkSession.conf.set("spark.sql.shuffle.partitions", "4")


def test_joined_tiles_shuffle_border_runs_only(stored):
    from tissueframe.plans.tiles import join_tiles
    pieces = stored([(0, 1, 0, 2, 4), (0, 1, 0, 6, 7), (0, 1, 0, 8, 15), (0, 1, 0, 16, 16), (0, 2, 0, 17, 18), (0, 1, 1, 7, 7)],
                    "chip long, label long, y long, x0 long, x1 long")
    got = sorted((r.label, r.y, r.x0, r.x1) for r in join_tiles(pieces, ("chip", "label", "y"), 8).collect())
    assert got == [(1, 0, 2, 4), (1, 0, 6, 16), (1, 1, 7, 7), (2, 0, 17, 18)]
    inner = join_tiles(pieces.where("y = 0 and x1 = 4"), ("chip", "label", "y"), 8)
    assert [tuple(r) for r in inner.collect()] == [(0, 1, 0, 2, 4)]


def test_cells_are_dealt_before_they_become_runs(spark, tmp_path):
    """One task reads the small file of cells; the runs that an explode makes of them come from many."""
    rows = [(c, c % 25, 1.0, "BUILDING") for c in range(300)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    text = plan(Tables(spark, str(tmp_path)).nuclei)
    assert text.index("Generate") < text.index("REPARTITION_BY_NUM") < text.index("FileScan")
    assert Tables(spark, str(tmp_path)).nuclei.select("chip", "label").distinct().count() == 300


def test_fields_and_their_places_shuffle_both_sides(stored):
    from tissueframe.operators import stitching
    pixels = stored([(0, 0, c, 0, x, 10 * c + x) for c in range(2) for x in range(3)], "slide long, r long, c long, y long, x long, v long")
    loc = stored([(0, 0, 0, 0, 0), (0, 0, 1, 2, 0)], "slide long, r long, c long, x long, y long")
    whole = stitching.mosaic(pixels, loc, 2)
    assert "Broadcast" not in plan(whole)
    assert sorted((r.x, r.v) for r in whole.collect()) == [(0, 0), (1, 1), (2, 10), (3, 11), (4, 12)]
    mixed = stitching.blend_tiles(pixels, loc, 1)
    text = plan(mixed)
    # the two of the join and one for both axes
    assert "Broadcast" not in text and text.count("Exchange") == 3
    assert sorted((r.x, r.v) for r in mixed.collect()) == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 11.0), (4, 12.0)]


def test_field_pixels_are_made_where_the_join_wants_them(spark, tmp_path):
    """Fields are dealt before the explode, and the join with their places does not shuffle the pixels again."""
    import __spark_entry__ as entry
    spark.createDataFrame([(p,) for p in range(45)], "p_partkey long").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("g06_blend_tiles", "g07_mosaic"):
        got = entry.queries()[name](spark, str(tmp_path))
        text = plan(got)
        assert "Broadcast" not in text and text.rindex("Generate") < text.index("REPARTITION_BY_NUM", text.rindex("Generate"))
        assert got.count() == _mosaic_size(45)


def _mosaic_size(fields: int) -> int:
    """Pixels of fields of 6 by 6 on a lattice of 4, twenty in a row."""
    return len({(p // 20 * 4 + y, p % 20 * 4 + x) for p in range(fields) for y in range(6) for x in range(6)})


def test_scale_search_makes_no_row_for_a_candidate(spark, stored):
    import math
    import random
    rng = random.Random(5)
    steps = ((7, 9, 8), (6, 10, 11))
    rows = [(0, f, i, rng.randrange(60), rng.randrange(60)) for f in range(3) for i in range(12 + f)]
    scales = (0.8, 1.0, 1.25)
    points = stored(rows, "chip long, fov long, id long, x long, y long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")  # a centre goes on over batches
    try:
        got = registration.scale_search(points, ("chip", "fov"), scales, n=2, rate=1e9, template=steps)
        assert "Generate" not in plan(got)
        found = {r.fov: (r.scale, r.ix, r.iy, r.votes) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    def gap(u, pitch, i):
        lines = registration.track_prefix(pitch)
        return min(abs((u - (q - lines[i]) + sum(pitch) / 2) % sum(pitch) - sum(pitch) / 2) for q in lines)

    for f in range(3):
        own = [(i, x, y) for _, g, i, x, y in rows if g == f]
        mx, my = (sum(p[a] for p in own) / len(own) for a in (1, 2))
        near = sorted(own, key=lambda p: (round((p[1] - mx) ** 2 + (p[2] - my) ** 2, 6), p[0]))[:2]
        best = [min((round(sum(math.hypot(gap((x - cx) / s, steps[0], i), gap((y - cy) / s, steps[1], j)) * s for _, x, y in own), 6), s, i, j)
                    for s in scales for i in range(3) for j in range(3)) for _, cx, cy in near]
        votes = {s: [k for k, b in enumerate(best) if b[1] == s] for _, s, _, _ in best}
        s = max(votes, key=lambda v: (len(votes[v]), -votes[v][0], v))
        assert found[f] == (s, *best[votes[s][0]][2:], len(votes[s]))
