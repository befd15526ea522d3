"""Running tables and cell sums over chunks: any order, restarts, crashes, bounded reads."""

import random

import pytest

from tissueframe.operators import cells
from tissueframe.session import scratch
from tissueframe.streaming import incremental
from tissueframe.streaming.tables import RunningTable

ROW = "k long, v long"


def _table(spark, fan=4):
    return RunningTable(spark, scratch(spark, "running"), ("k",), fan)


def test_reads_stay_bounded_after_50_batches(spark):
    table, want, rng = _table(spark), {}, random.Random(3)
    for batch in range(50):
        rows = {rng.randrange(30): batch * 100 + i for i in range(5)}
        want |= rows
        table.add(spark.createDataFrame(list(rows.items()), ROW).coalesce(1), batch)
    folders = table.folders()
    assert len(folders) <= 3 * 3 + 1 and max(f["tier"] for f in folders) == 2
    read = table.read(ROW)
    assert {r["k"]: r["v"] for r in read.collect()} == want
    named = {f.split("/")[-2] for f in read.inputFiles()}
    assert named == {f["folder"] for f in folders} and len(read.inputFiles()) <= 40
    assert table.vacuum() > 40 and {r["k"]: r["v"] for r in table.read(ROW).collect()} == want


def test_a_crash_before_the_swap_changes_nothing_and_one_after_it_is_not_repeated(spark, monkeypatch):
    table = _table(spark, 2)
    one = lambda v: spark.createDataFrame([(1, v)], ROW)
    assert table.add(one(10), 0)
    swap = RunningTable._swap

    def lost(self, version, folders):
        raise OSError("lost")

    monkeypatch.setattr(RunningTable, "_swap", lost)
    with pytest.raises(OSError, match="lost"):
        table.add(one(20), 1)  # its rows and the merge are written, the manifest is not
    assert table.read(ROW).collect()[0]["v"] == 10
    monkeypatch.setattr(RunningTable, "_swap", swap)
    assert table.add(one(20), 1) and table.read(ROW).collect()[0]["v"] == 20
    assert not table.add(one(30), 1) and table.read(ROW).collect()[0]["v"] == 20
    table.vacuum(1)
    assert table.read(ROW).collect()[0]["v"] == 20


def test_empty(spark):
    assert _table(spark).read(ROW).count() == 0


def _points(n=400):
    rng = random.Random(8)
    return [(rng.randrange(2), rng.choice(["a", "b", "c", None, ""]), rng.randrange(12), rng.randrange(12), rng.choice([1, 2, 7, None]))
            for _ in range(n)]


RUNS = [(chip, label, y, x0, x0 + 3) for chip in (0, 1) for label, x0 in ((1, 0), (2, 6)) for y in range(2, 9)] + [(1, 3, 50, 50, 55)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cell_sums_equal_the_batch_table_for_any_order_and_after_a_restart(spark, seed):
    points = _points()
    runs = spark.createDataFrame(RUNS, "chip long, label long, y long, x0 long, x1 long")
    whole = spark.createDataFrame(points, incremental.POINTS)
    want = {(r["chip"], r["cell_id"]): r for r in cells.cell_obs(cells.assign_cells(whole, runs), runs).collect()}
    random.Random(seed).shuffle(points)
    source, out, state = (scratch(spark, x) for x in ("in", "out", "state"))
    table = RunningTable(spark, out, incremental.CELL)
    for part in range(2):  # the second query goes on from the state folder of the first
        for i in range(2):
            spark.createDataFrame(points[(2 * part + i) * 100:][:100], incremental.POINTS).coalesce(1).write.mode("append").parquet(source)
        incremental.stream_cell_counts(spark, source, runs, out, state, 1).awaitTermination()
        assert len(table.folders()) == 2 * (part + 1)
    got = incremental.read_cell_obs(spark, out, runs).collect()
    assert len(got) == len(want) == 5
    for r in got:
        w = want[r["chip"], r["cell_id"]]
        assert all(r[c] == w[c] for c in ("area", "cx", "cy", "mid", "n_gene", "n_dnb"))
    inside = [any(c == k and y == w and a <= x <= b for c, _, w, a, b in RUNS) for k, _, x, y, _ in points]
    assert sum(r["n"] for r in got) == sum(inside)


def test_dnb_stream_equals_the_batch_heat_map(spark):
    points = [p for p in _points() if p[4] is not None]
    source, out, state = (scratch(spark, x) for x in ("in", "out", "state"))
    for i in range(0, len(points), 60):
        spark.createDataFrame(points[i: i + 60], incremental.POINTS).coalesce(1).write.mode("append").parquet(source)
    incremental.stream_dnb(spark, source, out, state, 2).awaitTermination()
    want = sorted(map(tuple, cells.dnb_heatmap(spark.createDataFrame(points, incremental.POINTS)).collect()))
    assert sorted(map(tuple, incremental.read_dnb(spark, out).collect())) == want


def test_cell_sums_are_kept_by_gene_and_spot_without_python(spark):
    """A crowded cell is many rows of state, which many tasks hold; no row of the stream goes through Python."""
    runs = spark.createDataFrame([(0, 1, 0, 0, 99)], "chip long, label long, y long, x0 long, x1 long")
    source, out, state = (scratch(spark, x) for x in ("in", "out", "state"))
    points = [(0, "ab"[x % 2], x, 0, 1) for x in range(100)]
    spark.createDataFrame(points, incremental.POINTS).coalesce(1).write.parquet(source)
    query = incremental.stream_cell_counts(spark, source, runs, out, state, 1)
    query.awaitTermination()
    kept = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert {s["operatorName"] for s in kept} == {"stateStoreSave"} and max(s["numRowsTotal"] for s in kept) == 2 + 100
    assert [tuple(r) for r in incremental.read_cell_counts(spark, out).collect()] == [(0, 1, 100, 100, 2, 100)]
