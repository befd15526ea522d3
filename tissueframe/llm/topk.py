"""Exact top-k by inner product without random access, in blocks.

Candidates are dealt to blocks.  In a block each component is a list sorted by value, which a query reads from its best
end.  After reading to some depth, a component that was read counts as it is; one that was not lies between the end of
the list and the value at that depth.  That gives each candidate a lower and an upper score.  A query is done when no
candidate outside its k best lower scores, read or not, has an upper score that could enter; depths double until then.
Final scores of what is left are then resolved from the lists.  All queries of a block read at the same depth, so bounds
are matrix products.

Scores are integers; work is exact in doubles as long as sums stay below 2^53, else it is done in 64-bit integers.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without an
id; of rows that repeat an id the smallest vector counts; vectors only meet vectors of the same length; equal scores go
to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut

BLOCK, SCALE = 4096, 1024
_OUT = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, n, v)``: usable vectors with components floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(
        F.col("id").isNotNull() & (F.size("x") > 0)).where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    whole = usable.select("id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))
    return whole.groupBy("id").agg(F.min("v").alias("v")).select("id", F.size("v").alias("n"), "v")


def _bounds(q_up: np.ndarray, q_down: np.ndarray, x: np.ndarray, lists: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper score of each query and candidate after reading ``depth`` entries of each list."""
    top, low = lists[len(lists) - depth], lists[depth - 1]
    first, last = lists[0], lists[-1]
    upper = q_up @ np.maximum(x, top).T + q_down @ np.minimum(x, low).T
    lower = q_up @ np.where(x >= top, x, first).T + q_down @ np.where(x <= low, x, last).T
    return lower, upper


def _block(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, candidate, score)`` of the k best candidates of each query in one block, ties by smaller id."""
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    largest = float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1]
    kind = np.float64 if largest < 2 ** 53 else np.int64
    x, q = x.astype(kind), q.astype(kind)
    lists = np.sort(x, axis=0)
    found = []
    open_q, depth = np.arange(len(q)), min(len(x), max(64, len(x) // 4))
    while len(open_q):
        part = q[open_q]
        lower, upper = _bounds(np.maximum(part, 0), np.minimum(part, 0), x, lists, depth)
        own = queries[open_q][:, None] == ids[None, :]
        lower[own] = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
        if len(x) > k:
            kth = np.partition(lower, len(x) - k - 1, axis=1)[:, len(x) - k - 1: len(x) - k]  # k best besides own
        else:
            kth = lower.min(axis=1, keepdims=True)
        left = (upper >= kth) & ~own
        done = left.sum(axis=1) <= max(8 * k, 64) if depth < len(x) else np.ones(len(open_q), bool)
        for i in np.flatnonzero(done):
            at = np.flatnonzero(left[i])
            score = x[at] @ part[i]
            best = np.lexsort((ids[at], -score))[:k]
            found.append((np.full(len(best), queries[open_q[i]]), ids[at[best]], score[best].astype(np.int64)))
        open_q, depth = open_q[~done], min(len(x), depth * 2)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``(id, n, v)`` tables; a query never meets its own id."""
    numbers = vectors.groupBy("n").agg(F.count("*").alias("all"))
    asked = queries.groupBy("n").agg(F.count("*").alias("asked"))
    sizes = numbers.join(asked, "n").select(
        F.col("n"), F.ceil(F.col("all") / block).cast("int").alias("nc"), F.ceil(F.col("asked") / block).cast("int").alias("nq"))

    def dealt(rows: DataFrame, own: str, other: str, own_n: str, other_n: str) -> DataFrame:
        mine = rows.join(F.broadcast(sizes), "n")  # a row for each vector length
        return mine.withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))).select(
                *[F.col(x).alias(x) for x in ("n", "c", "q", "id", "v")])  # columns of its own, as both sides may be one table

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": [], "vec_id": [], "score": []}, schema=pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")]))
        found = _block(left["id"].to_numpy(), _matrix(left["v"]), right["id"].to_numpy(), _matrix(right["v"]), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    c = dealt(vectors, "c", "q", "nc", "nq").groupBy("n", "c", "q")
    q = dealt(queries, "q", "c", "nq", "nc").groupBy("n", "c", "q")
    best = c.cogroup(q).applyInArrow(search, _OUT)
    top = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return best.groupBy("query_id").agg(top.alias("top")).select("query_id", F.posexplode("top")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.s")).alias("score"))


def search(table: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The rows whose id is divisible by ``every`` against all others."""
    vectors = cut(integers(table))
    return top_k(vectors, vectors.where(F.col("id") % every == 0), k)
