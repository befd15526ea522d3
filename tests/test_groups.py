"""Functions on groups: hot groups, combiners, schema checks; functions in SQL."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tissueframe.functions import chip, intensity, sql
from tissueframe.plans import groups

SCHEMA = "chip long, total long, rows long, largest long"


def functions():
    """Made here, so that workers get them by value and need not import the test."""
    def part(pdf):
        return pd.DataFrame({"largest": [pdf["v"].max()], "chip": [pdf["chip"].iloc[0]], "total": [pdf["v"].sum()], "rows": [len(pdf)]})

    def merge(pdf):
        return pd.DataFrame({"chip": [pdf["chip"].iloc[0]], "total": [pdf["total"].sum()], "rows": [pdf["rows"].sum()], "largest": [pdf["largest"].max()]})

    return part, merge


part, merge = functions()


@pytest.fixture(scope="module")
def table(spark):
    """One group has half of the rows, one key is null, and rows repeat."""
    rows = [(7, i % 5) for i in range(1000)] + [(i % 20, i) for i in range(980)] + [(None, 3)] * 20
    return spark.createDataFrame(rows, "chip long, v long").repartition(4).cache()


@pytest.mark.parametrize("limit", [100_000, 300, 4])
def test_a_group_with_half_of_the_rows(spark, table, limit):
    seen = spark.sparkContext.accumulator(0)

    part, merge = functions()

    def watched(pdf):
        if len(pdf) > 1.8 * max(limit, 60):
            seen.add(1)
        return part(pdf)

    want = {r["chip"]: (r["t"], r["n"], r["m"]) for r in table.groupBy("chip").agg(
        F.sum("v").alias("t"), F.count("*").alias("n"), F.max("v").alias("m")).collect()}
    got = groups.group_apply(table, ("chip",), watched, SCHEMA, merge, limit, fan=8).collect()
    assert {r["chip"]: (r["total"], r["rows"], r["largest"]) for r in got} == want and len(got) == len(want) == 21
    assert seen.value == 0


def test_without_a_combiner_a_hot_group_is_named(spark, table):
    with pytest.raises(ValueError, match=r"group \[7\] has 1049 rows"):
        groups.group_apply(table, ("chip",), part, SCHEMA, limit=300)
    assert groups.group_apply(table, ("chip",), part, SCHEMA, limit=2000).count() == 21
    assert groups.group_apply(table.limit(0), ("chip",), part, SCHEMA, merge).count() == 0


def test_schemas_are_checked(spark, table):
    with pytest.raises(ValueError, match="lacks the keys"):
        groups.group_apply(table, ("chip",), part, "total long")
    with pytest.raises(Exception, match="the function gave columns"):
        groups.group_apply(table, ("chip",), lambda p: part(p).drop(columns="rows"), SCHEMA).collect()


def test_functions_in_sql_equal_the_column_functions(spark):
    assert set(sql.register(spark)) == set(sql.SCALARS)
    names = ["A12345A1", "Y00394AB", "SS200000123TL_A1", "DP8400012345_B4A1", "X", "", None, "FP200000239TL_A4E6"]
    df = spark.createDataFrame([(n, v) for n in names for v in (0.0, 12.3456, -98765.4, 1e12, None)], "sn string, v double")
    sn, v = F.col("sn"), F.col("v")
    w, h = chip.chip_spec(sn)
    want = df.select(chip.name_type(sn), chip.is_large(sn), chip.is_late(sn), w, h, intensity.human_format(v)).collect()
    made = spark.sql("select chip_name_type(sn), chip_is_large(sn), chip_is_late(sn), chip_width(sn), chip_height(sn), human_format(v) from {df}", df=df)
    assert list(map(tuple, made.collect())) == list(map(tuple, want))
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()


def test_table_function_on_tiles(spark):
    def stats(pdf):
        return pd.DataFrame({"img": [pdf["img"].iloc[0]], "tile": [pdf["tile"].iloc[0]], "n": [len(pdf)], "top": [pdf["v"].max()]})

    sql.tile_function(spark, "tile_stats_test", stats, "img bigint, tile bigint, n bigint, top bigint")
    df = spark.createDataFrame([(i % 3, i % 7, i) for i in range(200)], "img long, tile long, v long").repartition(5)
    got = sorted(map(tuple, sql.map_tiles(spark, "tile_stats_test", df, ("img", "tile")).collect()))
    assert got == sorted(map(tuple, df.groupBy("img", "tile").agg(F.count("*"), F.max("v")).collect()))


def test_table_function_gets_arrow_batches(spark):
    def stats(pdf):
        return pd.DataFrame({"img": [pdf["img"].iloc[0]], "v": [pdf["v"].sum(min_count=1)], "names": ["".join(sorted(pdf["name"].dropna()))]})

    sql.tile_function(spark, "tile_batches_test", stats, "img bigint, total bigint, names string")
    rows = [(1, 5, "a"), (1, None, "b"), (None, 7, None), (None, 7, "c"), (2, None, "d")]
    df = spark.createDataFrame(rows, "img long, v long, name string").repartition(3)
    made = sql.map_tiles(spark, "tile_batches_test", df, ("img",))
    assert "ArrowEvalPythonUDTF" in made._jdf.queryExecution().executedPlan().toString()
    got = {(r["img"], r["total"], r["names"]) for r in made.collect()}
    assert got == {(1, 5, "ab"), (None, 14, "c"), (2, None, "d")}
    sql.tile_function(spark, "tile_none_test", lambda pdf: stats(pdf).iloc[:0], "img bigint, total bigint, names string")
    assert sql.map_tiles(spark, "tile_none_test", df, ("img",)).count() == 0
    # more than one batch a tile, and tiles that go over the end of a batch
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = spark.range(100).selectExpr("id % 3 img", "id v", "'x' name")
        got = {r["img"]: (r["total"], len(r["names"])) for r in sql.map_tiles(spark, "tile_batches_test", many, ("img",)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: (sum(range(k, 100, 3)), len(range(k, 100, 3))) for k in range(3)}


def test_small_groups_come_in_batches_of_many(spark):
    """Groups with null keys, nulls in some groups only, and groups that go over the end of a batch."""
    def part(pdf):
        kinds = "f" if pdf["v"].dtype.kind == "f" else "i"
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "name": [pdf["name"].iloc[0]], "kinds": [kinds], "n": [len(pdf)],
                             "total": [None if pdf["v"].isna().all() else int(pdf["v"].fillna(0).sum())]}).iloc[:0 if len(pdf) == 1 else 1]

    big = (1 << 60) + 1
    rows = [(k, n, big if n != "b" else None if i % 2 else i) for k in (1, None, big) for n in ("a", "b", None) for i in range(8)] + [(5, "one", 1)]
    df = spark.createDataFrame(rows, "k long, name string, v long").repartition(3)
    schema = "k long, name string, n long, total long, kinds string"
    want = {(k, n, 8, 12 if n == "b" else 8 * big % (1 << 64) - (1 << 64 if 8 * big % (1 << 64) >> 63 else 0), "f" if n == "b" else "i")
            for k in (1, None, big) for n in ("a", "b", None)}
    for size in ("10000", "5"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            made = groups.group_apply(df, ("k", "name"), part, schema)
            assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
            got = [tuple(r) for r in made.collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(got) == 9 and set(got) == want
    # types that pandas would get otherwise take the plain way
    other = groups.group_apply(df.withColumn("k", F.col("k").cast("double")), ("k",), lambda p: p[["k"]].iloc[:1], "k double")
    assert "FlatMapGroupsInPandas" in other._jdf.queryExecution().executedPlan().toString() and other.count() == 4


def test_many_groups_at_once(spark):
    """A function of many groups sees whole groups, also those that go on over batches."""
    rows = [(g, i) for g in range(9) for i in range(4 + g)]
    df = spark.createDataFrame(rows, "g long, v long")

    def sums(pdf):
        return pdf.groupby("g", as_index=False).agg(v=("v", "sum"), n=("v", "size"))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = sorted(map(tuple, groups.group_apply(df, ("g",), sums, "g long, v long, n long", many=True).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(g, sum(range(4 + g)), 4 + g) for g in range(9)]
    with pytest.raises(ValueError, match="no combiner"):
        groups.group_apply(df, ("g",), sums, "g long, v long, n long", combine=sums, many=True)
