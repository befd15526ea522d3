"""User functions on groups, with hot groups split and put together again."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import cut, deal

#: Rows of a group that one task may hold.
ROWS = 1_000_000

#: Types that are equal in Arrow where they are one group in Spark, and those that Arrow and Spark give to pandas alike.
KEYS = {"bigint", "int", "smallint", "tinyint", "string", "boolean", "date"}
VALUES = KEYS | {"double", "float"}


def _checked(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType, what: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """``fn`` with its columns checked by name and put in order."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        out = fn(part)
        names = [f.name for f in schema]
        if not isinstance(out, pd.DataFrame) or set(out.columns) != set(names):
            raise ValueError(f"{what} gave columns {list(getattr(out, 'columns', []))}, not {names}")
        return out[names]

    return run


def starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where the groups of a table sorted by ``keys`` begin."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        codes = pa.concat_arrays(table.column(k).chunks).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _apply(df: DataFrame, keys: tuple[str, ...], fn: Callable[[pd.DataFrame], pd.DataFrame], kind: StructType,
           many: bool = False) -> DataFrame:
    """``fn`` on the rows of each group, as ``applyInPandas`` does, for many small groups.

    Rows are shuffled and sorted by the keys and come in batches of many groups, so that a group costs a slice and not
    a stream of its own; the last group of a batch waits for the next.  With ``many`` the function gets the whole groups of
    a batch at once.  Types that pandas would get otherwise take the plain way.
    """
    types = dict(df.dtypes)
    if not {types[k] for k in keys} <= KEYS or not {*types.values(), *(f.dataType.simpleString() for f in kind)} <= VALUES:
        return df.groupBy(*keys).applyInPandas(fn, kind)
    schema = to_arrow_schema(kind)

    def made(table: pa.Table, heads: np.ndarray) -> Iterator[pa.RecordBatch]:
        if many:
            out = fn(table.to_pandas(use_threads=False))
            if len(out):
                yield packed([out])
            return
        # without nulls a column has the same type in all groups
        whole = None if any(c.null_count for c in table.columns) else table.to_pandas(use_threads=False)
        found: list[pd.DataFrame] = []
        for a, b in zip(heads, [*heads[1:], table.num_rows]):
            rows = table.slice(a, b - a).to_pandas(use_threads=False) if whole is None else whole.iloc[a:b].reset_index(drop=True)
            out = fn(rows)
            if found and not out.dtypes.equals(found[0].dtypes):
                yield packed(found)
                found = []
            if len(out):
                found.append(out)
        if found:
            yield packed(found)

    def packed(found: list[pd.DataFrame]) -> pa.RecordBatch:
        out = pd.concat(found, ignore_index=True)
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type, from_pandas=True, safe=False) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            heads = starts(table, keys)
            if len(heads) > 1:
                yield from made(table.slice(0, heads[-1]), heads[:-1])
            held = table.slice(heads[-1])
        if held is not None:
            yield from made(held, np.zeros(1, int))

    return deal(df, *keys).sortWithinPartitions(*keys).mapInArrow(run, kind)


def group_apply(df: DataFrame, keys: tuple[str, ...], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None, limit: int = ROWS, fan: int = 64,
                many: bool = False) -> DataFrame:
    """Apply ``fn`` to the rows of each group; rows of ``schema`` hold the keys.

    With ``combine`` a group of more than ``limit`` rows is dealt to parts by a hash of its rows, ``fn`` makes partial
    rows of each part, and ``combine`` makes one partial result of up to ``fan`` parts, on as many levels as it takes,
    so that no task holds the group.  ``combine`` takes rows of ``schema`` and gives rows of ``schema``; it has to be
    associative and must not depend on the order of its rows.  It also runs, as the last step, on groups of one part.

    Without ``combine`` a group cannot be split, and one of more than ``limit`` rows is an error that names it: the
    caller bounds the group (a tile, a cell's box) or gives a combiner.  Null keys are a group; empty tables give empty
    tables; the columns that the function gives are checked by name.

    With ``many`` (and no ``combine``) ``fn`` takes the rows of several whole groups at once and tells them apart itself.
    """
    if many and combine:
        raise ValueError("a function of many groups has no combiner")
    kind = StructType.fromDDL(schema)
    missing = [k for k in keys if k not in kind.names]
    if missing:
        raise ValueError(f"the schema lacks the keys {missing}")
    work = _checked(fn, kind, "the function")
    rows = cut(df)
    hot = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit))
    if hot.isEmpty():
        out = _apply(rows, keys, work, kind, many)
        return _apply(out, keys, _checked(combine, kind, "the combiner"), kind) if combine else out
    if not combine:
        found = hot.orderBy(F.desc("_n")).first()
        raise ValueError(f"group {[found[k] for k in keys]} has {found['_n']} rows, more than {limit}, and there is no combiner")
    marks = hot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.ceil(F.col("_n") / limit).cast("long").alias("_parts"))
    same = None
    for i, k in enumerate(keys):
        one = rows[k].eqNullSafe(marks[f"_k{i}"])
        same = one if same is None else same & one
    # a running number tells equal rows apart; the table is written, so it is the same in every attempt
    dealt = (rows.withColumn("_row", F.monotonically_increasing_id()).join(marks, same, "left")
             .withColumn("_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1)))))
    part = dealt.select(*rows.columns, "_part")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)

    def made(pdf: pd.DataFrame) -> pd.DataFrame:
        number = pdf["_part"].iloc[0]
        return work(pdf.drop(columns="_part")).assign(_part=number)

    join = _checked(combine, kind, "the combiner")

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        number = pdf["_part"].iloc[0]
        return join(pdf.drop(columns="_part")).assign(_part=number)

    both = StructType.fromDDL(f"{names}, `_part` long")
    partial = _apply(part, (*keys, "_part"), made, both)
    most = hot.agg(F.ceil(F.max("_n") / limit)).first()[0]
    while most > 1:
        most = -(-most // fan)
        partial = _apply(partial.withColumn("_part", F.floor(F.col("_part") / fan)), (*keys, "_part"), joined, both)
    return partial.drop("_part")
