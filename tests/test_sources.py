import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tissueframe.session import cut, scratch, shared_dir
from tissueframe.sources import cell_tables, gem, masks, records


def test_gzip_gem_with_header(spark, tmp_path):
    path = tmp_path / "a.gem.gz"
    with gzip.open(path, "wt") as f:
        f.write("#x_start=5\n#bin_size=0\n#y_start=-7\ngeneID\tx\ty\tUMICount\nA\t1\t2\t3\nB\t4\t5\t6\n")
    expr, meta = gem.read_gem(spark, str(path))
    assert sorted(map(tuple, expr.collect())) == [(0, "A", 1, 2, 3), (0, "B", 4, 5, 6)]
    m = meta.first()
    assert (m["x_start"], m["y_start"], m["binx"]) == (5, -7, 1)


def test_gem_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        gem.read_gem(spark, str(tmp_path / "a.csv"))
    bad = tmp_path / "b.gem"
    bad.write_text("geneID\tx\ty\tvalue\nA\t1\t2\t3\n")
    with pytest.raises(ValueError):
        gem.read_gem(spark, str(bad))


def test_empty_store_is_an_error(spark):
    path = scratch(spark, "store")
    gem.write_expression(spark.createDataFrame([], "chip long, gene string, x long, y long, mid long"), path)
    with pytest.raises(ValueError):
        gem.read_expression(spark, path)


def test_half_even_rounding(spark):
    df = spark.createDataFrame([("a", 0.5, 1.5), ("b", 2.5, 3.5)], "feature_name string, x_location double, y_location double")
    assert [(r["x"], r["y"]) for r in gem.transcripts_to_expression(df, 1.0).orderBy("gene").collect()] == [(0, 2), (2, 4)]


def test_file_listing(spark, tmp_path):
    for r in (1, 2):
        (tmp_path / f"img_{r:04d}_{r + 1:04d}_x.tif").write_bytes(b"x" * 10)
    files = records.list_files(spark, str(tmp_path))
    assert sorted((r["r"], r["c"]) for r in records.scan_fov_listing(files, index0=False).collect()) == [(0, 1), (1, 2)]
    (tmp_path / "other.tif").write_bytes(b"x")
    with pytest.raises(PySparkException):
        records.scan_fov_listing(records.list_files(spark, str(tmp_path))).collect()


def test_multiline_parameters(spark, tmp_path):
    (tmp_path / "kit A.json").write_text("""{
  "image_process": {"0": {"file_path": "a.tif", "tech_type": "DAPI", "chip_detect": true, "registration": {"reuse": -1}}},
  "molecular_classify": {"0": {"exp_matrix": 1, "cell_mask": {"nuclei": [0]}, "correct_r": 10}},
  "run": {"qc": true, "alignment": true, "matrix_extract": true, "report": false, "annotation": false}}""")
    slots, mol, run = records.read_params(spark, str(tmp_path))
    assert slots.first()["tech_type"] == "DAPI" and mol.first()["cell_mask"] == {"nuclei": [0]} and run.first()["qc"]
    assert records.kit_table(spark, str(tmp_path)).first()["radius"] == 10


def test_rle_round_trip_with_full_rows(spark):
    rows = [(0, "a", 0, 3, 9), (0, "a", 1, 0, 9), (0, "a", 2, 0, 4), (0, "a", 4, 2, 5)]
    runs = spark.createDataFrame(rows, "chip long, layer string, y long, x0 long, x1 long")
    extent = spark.createDataFrame([(0, 10)], "chip long, width long")
    rle = masks.rle_encode(runs, extent)
    assert sorted((r["start"], r["length"]) for r in rle.collect()) == [(4, 22), (43, 4)]
    assert sorted(map(tuple, masks.rle_decode(rle, extent).collect())) == sorted(rows)


def test_bucketed_cells(spark):
    path = scratch(spark, "cells")
    cell = spark.range(100).select(F.lit(0).alias("chip"), F.col("id").alias("cell_id"))
    cell_tables.write_cells(cell, cell.withColumn("gene", F.lit("g")), path, table="bucketed_test", buckets=4)
    both = spark.table("bucketed_test_cell").hint("merge").join(spark.table("bucketed_test_cell_gene"), "cell_id")
    assert both.count() == 100
    assert "Exchange hashpartitioning(cell_id" not in both._jdf.queryExecution().executedPlan().toString()


def test_cut_is_a_written_table(spark):
    df = cut(spark.range(10).withColumn("s", F.struct("id")))
    assert shared_dir(spark).rstrip("/").replace("file:", "") in df.inputFiles()[0].replace("file:", "").replace("//", "/")
    assert df.count() == 10
