"""The library's functions for use in SQL.

``register`` makes the Column functions below callable from ``spark.sql``.  Their bodies are the expressions that the
Column functions build, so they are inlined by the optimizer and no Python runs for a row.  ``tile_function`` registers a
user's function on tiles as a table function with a partitioned table argument:

    select * from stats(table(select img, tile, y, x, v from pixels) partition by (img, tile))
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udtf
from pyspark.sql.types import StructType

from . import chip, intensity

#: Name, arguments with types, result type, and the Column function of the arguments.
SCALARS: dict[str, tuple[str, str, Callable[..., Column]]] = {
    "chip_name_type": ("sn string", "string", chip.name_type),
    "chip_is_large": ("sn string", "boolean", chip.is_large),
    "chip_is_late": ("sn string", "boolean", chip.is_late),
    "chip_width": ("sn string", "double", lambda sn: chip.chip_spec(sn)[0]),
    "chip_height": ("sn string", "double", lambda sn: chip.chip_spec(sn)[1]),
    "human_format": ("v double", "string", intensity.human_format),
}


def _body(spark: SparkSession, arguments: str, fn: Callable[..., Column]) -> str:
    """SQL text of the expression that ``fn`` builds on the arguments."""
    names = [x.split()[0] for x in arguments.split(",")]
    empty = spark.createDataFrame([], arguments)
    plan = empty.select(fn(*[F.col(n) for n in names]).alias("result"))._jdf.queryExecution().analyzed()
    return plan.projectList().head().child().sql()


def register(spark: SparkSession) -> list[str]:
    """Make the functions of ``SCALARS`` callable in SQL for this session; returns their names."""
    for name, (arguments, result, fn) in SCALARS.items():
        spark.sql(f"create or replace temporary function {name}({arguments}) returns {result} return {_body(spark, arguments, fn)}")
    return list(SCALARS)


def tile_function(spark: SparkSession, name: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> None:
    """Register ``fn`` (rows of one tile to rows of ``schema``) as the table function ``name``.

    The caller's ``partition by`` says what a tile is; a tile's rows are held by one task, so it must be of bounded
    size, and each tile is a call of its own.  Rows come and go as Arrow batches, so no Python object is made for a row.
    """
    names = StructType.fromDDL(schema).names

    class Tile:
        def __init__(self):
            self._batches: list[pa.RecordBatch] = []

        def eval(self, rows: pa.RecordBatch):
            self._batches.append(rows)

        def terminate(self):
            if self._batches:
                out = fn(pa.Table.from_batches(self._batches).to_pandas(use_threads=False))
                if len(out):
                    columns = [pa.array(out.iloc[:, i], from_pandas=True) for i in range(out.shape[1])]
                    yield pa.Table.from_arrays(columns, names=names)

    spark.udtf.register(name, arrow_udtf(Tile, returnType=schema))


def map_tiles(spark: SparkSession, name: str, tiles: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The registered table function ``name`` over ``tiles``, one call for each value of ``by``."""
    return spark.sql(f"select * from {name}(table(select * from {{tiles}}) partition by ({', '.join(by)}))", tiles=tiles)
