"""Principal components of sparse rows by subspace iteration.

A row is two arrays, the columns it has and their values; columns it lacks are 0.  Columns are centred and scaled to unit
variance without ever writing the zeros: with X the sparse rows, D the inverse deviations and m the means, a row of the
scaled matrix times a basis V is (x D) V - m D V.

One iteration is one pass over the written rows.  A task multiplies its rows with the basis and back, and hands on its
part of the product in blocks of columns; Spark adds the blocks up, in two steps, so a sum never gathers all tasks.  The
driver holds matrices of columns x (k + ``EXTRA``) and factors those; nothing of columns x columns is made.  A basis that
spans all columns is exact in one pass.

Columns are at most ``WIDEST`` (checked), which bounds what is sent to the tasks.

Defined cases: a constant column has no weight; null arrays give a null result; an empty table has no components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

EXTRA, WIDEST, STEP, CHUNK = 64, 100_000, 512, 30_000


def _products(part: pd.DataFrame, basis: np.ndarray, offset: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, columns, values, product)`` of consecutive rows with about ``CHUNK`` entries together."""
    idx, val = part["idx"].to_numpy(), part["val"].to_numpy()
    size = np.fromiter(map(len, idx), np.int64, len(idx))
    group = np.cumsum(size) // CHUNK
    for at in np.split(np.arange(len(idx)), np.flatnonzero(np.diff(group)) + 1):
        if not len(at):
            continue
        cols = np.concatenate([np.asarray(idx[i], np.int64) for i in at]) if len(at) else np.zeros(0, np.int64)
        vals = np.concatenate([np.asarray(val[i], float) for i in at])
        row = np.repeat(np.arange(len(at)), size[at])
        product = np.zeros((len(at), basis.shape[1]))
        if len(cols):
            some = vals[:, None] * basis[cols]
            full = size[at] > 0
            product[full] = np.add.reduceat(some, (np.cumsum(size[at]) - size[at])[full])
        yield at, cols, vals, row, product - offset


class Components:
    """``k`` components: ``loadings`` (columns x k), ``values`` (variance along each), ``mean`` and ``scale`` of the columns."""

    def __init__(self, loadings: np.ndarray, values: np.ndarray, mean: np.ndarray, scale: np.ndarray, passes: int):
        self.loadings, self.values, self.mean, self.scale, self.passes = loadings, values, mean, scale, passes

    def project(self, df: DataFrame, idx: str, val: str, out: str) -> DataFrame:
        """``df`` with its rows' places along the components as the array column ``out``."""
        basis = self.scale[:, None] * self.loadings
        offset = self.mean @ basis
        width = basis.shape[1]
        sent = df.sparkSession.sparkContext.broadcast((basis, offset))

        @F.pandas_udf("array<double>")
        def places(i: pd.Series, v: pd.Series) -> pd.Series:
            basis, offset = sent.value
            result = pd.Series([None] * len(i), index=i.index, dtype=object)
            known = np.flatnonzero((i.notna() & v.notna()).to_numpy())
            part = pd.DataFrame({"idx": i.to_numpy()[known], "val": v.to_numpy()[known]})
            for at, _, _, _, product in _products(part, basis, offset):
                for row, place in zip(known[at], product):
                    result.iat[row] = place
            return result

        return df.withColumn(out, places(idx, val) if width else F.array().cast("array<double>"))


def _sum_blocks(parts: DataFrame, rows: int, width: int) -> np.ndarray:
    """Sum of ``(block, lane, data)`` rows, blocks of ``STEP`` rows of a matrix."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x) for x in pdf["data"]], axis=0)
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "lane": [0], "data": [total.tobytes()]})

    schema = "block int, lane int, data binary"
    lanes = parts.groupBy("block", "lane").applyInPandas(add, schema)
    out = np.zeros((rows, width))
    for r in lanes.groupBy("block").applyInPandas(add, schema).collect():  # rows x width numbers
        at = r["block"] * STEP
        out[at: at + STEP] = np.frombuffer(r["data"]).reshape(-1, width)
    return out


def fit(df: DataFrame, idx: str, val: str, k: int, width: int | None = None, tol: float = 1e-9, most: int = 300) -> Components:
    """The ``k`` first components of rows given by the array columns ``idx`` (from 0) and ``val``."""
    from ..session import cut

    spark = df.sparkSession
    rows = cut(df.where(F.col(idx).isNotNull() & F.col(val).isNotNull()).select(F.col(idx).cast("array<int>").alias("idx"),
                                                                              F.col(val).cast("array<double>").alias("val")))
    n = rows.count()
    if width is None:
        width = (rows.select(F.max(F.array_max("idx"))).first()[0] or 0) + 1 if n else 0
    if width > WIDEST:
        raise ValueError(f"{width} columns, more than {WIDEST}")
    mean, square = np.zeros(width), np.zeros(width)
    entry = rows.select(F.explode(F.arrays_zip("idx", "val")).alias("e"))
    for r in entry.groupBy("e.idx").agg(F.sum("e.val").alias("s"), F.sum(F.col("e.val") * F.col("e.val")).alias("q")).collect():
        mean[r["idx"]], square[r["idx"]] = r["s"] / n, r["q"]
    spread = np.maximum(square - n * mean * mean, 0) / max(1, n - 1)
    spread[spread <= 1e-12 * np.maximum(square / max(1, n), 1e-300)] = 0  # rounding of a constant column
    scale = np.where(spread > 0, 1 / np.sqrt(np.where(spread > 0, spread, 1)), 0.0)
    k = min(k, width)
    if not n or not k:
        return Components(np.zeros((width, 0)), np.zeros(0), mean, scale, 0)
    span = min(width, k + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(17).normal(size=(width, span)))[0]

    def multiplied(v: np.ndarray) -> np.ndarray:
        """Covariance of the scaled columns times ``v``, in one pass over the rows."""
        scaled = scale[:, None] * v
        sent = spark.sparkContext.broadcast((scaled, mean @ scaled))

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            basis, offset = sent.value
            total, ones = np.zeros((width, span)), np.zeros(span)
            for part in it:
                for _, cols, vals, row, product in _products(part, basis, offset):
                    ones += product.sum(axis=0)
                    if len(cols):
                        order = np.argsort(cols, kind="stable")
                        own = cols[order]
                        head = np.flatnonzero(np.diff(own, prepend=-1))
                        total[own[head]] += np.add.reduceat(vals[order, None] * product[row[order]], head)
            total -= np.outer(mean, ones)
            lane = TaskContext.get().partitionId() % 32
            for at in range(0, width, STEP):
                yield pd.DataFrame({"block": [at // STEP], "lane": [lane], "data": [total[at: at + STEP].tobytes()]})

        found = _sum_blocks(rows.mapInPandas(run, "block int, lane int, data binary"), width, span)
        sent.unpersist()
        return scale[:, None] * found / max(1, n - 1)

    last, passes = None, 0
    while True:
        image = multiplied(basis)
        passes += 1
        ritz = basis.T @ image
        value, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        if span == width or (last is not None and np.abs(value[:k] - last).max() <= tol * max(value[0], 1e-300)):
            break
        if passes == most:
            raise RuntimeError("components did not settle")
        last = value[:k]
        basis = np.linalg.qr(image @ turn)[0]
    loadings = (basis @ turn)[:, :k]
    loadings *= np.where(loadings[np.abs(loadings).argmax(axis=0), range(k)] < 0, -1.0, 1.0)
    return Components(loadings, value[:k], mean, scale, passes)
