"""Exact k nearest neighbours of feature vectors by metric pruning.

1. A few pivots are taken from the points, a group takes as many of them as it fills blocks.  Every point belongs to its
   nearest pivot and keeps its distance to it.
2. Points are sorted by pivot and distance over range partitions and cut into blocks of at most ``BLOCK`` points, each a
   shell around its pivot with an inner and an outer radius.  A region with very many points is many blocks.
3. Inside its own block a point finds ``k`` neighbours, which bound its k-th distance from above.  The largest bound of a
   block's points is the block's reach.
4. By the triangle inequality a point of block Q can only be within that reach of a point of block C if the distances
   from Q to C's pivot, widened by the reach, meet C's shell.  Pairs of blocks that do not meet are never compared.
5. Neighbouring blocks form at most ``PARTS`` parts.  A part gets each block that is paired with one of its own once, as a
   stream; its points keep the best ``k`` of what has passed, which narrows their bounds, and a point skips the blocks
   whose shell its bound does not meet.  So a point is shuffled at most ``PARTS`` times and ``k`` rows of it come back,
   however many blocks there are, until a part would hold more than ``PART`` points.

The result is that of comparing all points at every size; only the number of compared blocks depends on the data: vectors
without structure cost all pairs of points in time.  A task holds a part, a batch and ``CHUNK`` rows of distances to it.
What is sent to all tasks is the pivots, ``PIVOTS`` rows.

Defined cases: rows with a null id or vector, with null or non-finite components, or of another length than most of its
group's first pivot are errors of the caller except null vectors, which take no part; repeated vectors are neighbours at
distance 0; a point with fewer than ``k`` others has all of them; an empty table gives an empty graph.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, deal, spread

PIVOTS, BLOCK = 64, 512
#: Parts whose points are sent all blocks that they are compared with, most points of a part, and points compared at a time.
PARTS, PART, CHUNK = 64, 1 << 15, 2048
#: Room for the rounding of distances when blocks and points are ruled out.
SLACK = 1e-6


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` and ``b``; equal rows may be off by rounding."""
    sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of rows side by side."""
    gap = a - b
    return np.sqrt((gap * gap).sum(axis=1))


def blocks(points: DataFrame, by: tuple[str, ...], pivots: np.ndarray, size: int) -> DataFrame:
    """``(by, id, f, pivot, r, block)`` of points ``(by, id, f)``, written.

    A group of n points takes the first n / ``size`` pivots, as many blocks of a few points would cost more than they rule out.
    """
    types = dict(points.dtypes)
    head = "".join(f"`{c}` {types[c]}, " for c in by)

    def nearest(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            if len(part):
                d = _distances(np.stack(part["f"].to_numpy()), pivots)
                d[np.arange(len(pivots)) >= part["several"].to_numpy()[:, None]] = np.inf
                yield part.drop(columns="several").assign(pivot=d.argmin(axis=1).astype("int32"), r=d.min(axis=1))

    def numbered(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        last, held, number = None, 0, -1
        for part in it:
            out = np.empty(len(part), np.int64)
            for i, key in enumerate(zip(*(part[c] for c in (*by, "pivot")))):
                if key != last or held == size:
                    last, held, number = key, 0, number + 1
                held += 1
                out[i] = first + number
            yield part.assign(block=out)

    order = [*by, "pivot", "r", "id"]
    several = points.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.ceil(F.count("*") / size).alias("several"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    counted = points.join(several, same) if by else points.crossJoin(F.broadcast(several))  # without groups it is one row
    near = cut(counted.select(*by, "id", "f", "several").mapInPandas(nearest, f"{head}id {types['id']}, f array<double>, pivot int, r double"))
    ranged = near.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(ranged.mapInPandas(numbered, f"{head}id {types['id']}, f array<double>, pivot int, r double, block long"))


def block_pairs(shells: DataFrame, reaches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Pairs ``(by, block, other)`` of different blocks that may hold neighbours of each other.

    ``shells(by, block, pivot, inner, outer)`` and ``reaches(by, block, reach, pivot, nearest, farthest)``, the latter
    with the range of distances to every pivot.
    """
    other = shells.select(*by, "pivot", F.col("block").alias("other"), "inner", "outer")
    meets = (F.col("nearest") - F.col("reach") <= F.col("outer")) & (F.col("farthest") + F.col("reach") >= F.col("inner"))
    return reaches.join(other, [*by, "pivot"]).where(meets & (F.col("block") != F.col("other"))).select(*by, "block", "other")


def parts_of(blocks: DataFrame, by: tuple[str, ...], size: int) -> DataFrame:
    """``(by, block, part)``: neighbouring blocks in at most ``PARTS`` parts, of more only beyond ``PART`` points each."""
    every = Window.partitionBy(*by)  # one row a block
    row = F.row_number().over(every.orderBy("block")) - 1
    several = F.greatest(F.lit(1), F.least(F.ceil(F.count("*").over(every) / PARTS), F.lit(PART // size)))
    return blocks.select(*by, "block", F.floor(row / several).alias("part"))


class Nearest:
    """The ``k`` nearest of the points that have been seen, for each point of a part."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int, pivots: np.ndarray):
        self.ids, self.x, self.bound, self.k = ids, x, bound.copy(), k
        self._sq, self._to_pivot = (x * x).sum(axis=1), _distances(x, pivots)
        self.row, self.dst, self.dist = np.zeros(0, np.int64), ids[:0], np.zeros(0)

    def see(self, ids: np.ndarray, y: np.ndarray, pivot: int, r: np.ndarray) -> None:
        """Points of one block, at the distances ``r`` from the pivot."""
        sq = (y * y).sum(axis=1)
        right = np.concatenate([y, np.ones((len(y), 1)), sq[:, None]], axis=1).T
        to = self._to_pivot[:, pivot]
        meets = np.flatnonzero((to - self.bound <= r.max() + SLACK) & (to + self.bound >= r.min() - SLACK))
        for i in range(0, len(meets), CHUNK):
            at = meets[i: i + CHUNK]
            # squared distances less the squared bounds, which have room for the rounding of the squares
            room = self._sq[at] - np.minimum(self.bound[at], 1e150) ** 2 - 1e-12 * (self._sq[at] + sq.max())
            hit, of = np.nonzero(np.concatenate([-2 * self.x[at], room[:, None], np.ones((len(at), 1))], axis=1) @ right <= 0)
            row = at[hit]
            other = self.ids[row] != ids[of]
            row, of = row[other], of[other]
            if len(row):
                self._add(row, ids[of], _exact(self.x[row], y[of]))

    def _add(self, row: np.ndarray, dst: np.ndarray, dist: np.ndarray) -> None:
        old = np.isin(self.row, row)
        kept = [(v[~old], np.concatenate([v[old], new])) for v, new in ((self.row, row), (self.dst, dst), (self.dist, dist))]
        row, dst, dist = (new for _, new in kept)
        order = np.lexsort((dst, dist, row))
        row, dst, dist = row[order], dst[order], dist[order]
        first = np.searchsorted(row, row, "left")
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (dist[1:] != dist[:-1])
        place = np.arange(len(row))
        alike = place - np.maximum.accumulate(np.where(new, place, 0))
        last = first + self.k - 1
        full = (last < len(row)) & (row[np.minimum(last, len(row) - 1)] == row)
        far = np.where(full, dist[np.minimum(last, len(row) - 1)], np.inf)
        # of equal distances the k smallest ids are enough, and ranks go by distances rounded to nine places
        keep = (alike < self.k) & (dist <= far + 2e-9)
        self.bound[row] = np.minimum(self.bound[row], far * (1 + SLACK) + SLACK)
        self.row, self.dst, self.dist = (np.concatenate([a, b[keep]]) for (a, _), b in zip(kept, (row, dst, dist)))


def _vectors(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(column) and set(np.diff(column.offsets.to_numpy())) != {len(x) // len(column)}:
        raise ValueError("vectors of different lengths")
    return x.reshape(len(column), -1)


def compared(bounded: DataFrame, pairs: DataFrame, by: tuple[str, ...], k: int, pivots: np.ndarray, size: int, kind: str) -> DataFrame:
    """``(by, src, dst, dist)``: at least the ``k`` nearest of each point, over all blocks paired with its own.

    Each part of blocks gets its points, then the points of all blocks paired with one of its own, block after block.
    A point keeps its best ``k`` as they pass, so blocks are sent once to a part and nothing else leaves it.
    """
    types = dict(bounded.dtypes)
    head = "".join(f"`{c}` {types[c]}, " for c in by)
    parts = cut(parts_of(bounded.select(*by, "block").distinct(), by, size))
    vector = F.col("f").cast(f"array<{kind}>").alias("f")
    none = F.lit(None).cast("double")
    mine = bounded.join(spread(parts), [*by, "block"]).select(*by, "part", F.lit(-1).cast("long").alias("other"), "id", vector, "pivot", none.alias("r"), "bound")
    wanted = pairs.join(spread(parts), [*by, "block"]).select(*by, "part", "other").distinct()
    theirs = bounded.withColumnRenamed("block", "other").join(spread(wanted), [*by, "other"]).select(
        *by, "part", "other", "id", vector, "pivot", "r", none.alias("bound"))
    keys = [*by, "part"]
    rows = deal(mine.unionByName(theirs), *keys).sortWithinPartitions(*keys, "other")
    schema = f"{head}src {types['id']}, dst {types['id']}, dist double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, state = None, [], None

        def result() -> Iterator[pa.RecordBatch]:
            if state is not None and len(state.row):
                n = len(state.row)
                for a in range(0, n, 100_000):
                    row = state.row[a: a + 100_000]
                    yield pa.RecordBatch.from_pandas(pd.DataFrame({**{c: [v] * len(row) for c, v in zip(by, now)}, "src": state.ids[row],
                                                                   "dst": state.dst[a: a + 100_000], "dist": state.dist[a: a + 100_000]}), preserve_index=False)

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "other")]
            change = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            ids, x = batch.column("id").to_numpy(zero_copy_only=False), _vectors(batch.column("f"))
            pivot, r, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "r", "bound"))
            for a, b in zip(edges, edges[1:]):
                key = tuple(c[a] for c in columns[:-1])
                if key != now:
                    yield from result()
                    now, own, state = key, [], None
                if columns[-1][a] < 0:
                    own.append((ids[a:b], x[a:b], bound[a:b]))
                    continue
                state = state or Nearest(*map(np.concatenate, zip(*own)), k, pivots)
                state.see(ids[a:b], x[a:b], int(pivot[a]), r[a:b])
        yield from result()

    return rows.mapInArrow(run, schema)


def knn(df: DataFrame, id_col: str, col: str, k: int, by: tuple[str, ...] = (), block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """Exact k nearest neighbours ``(by, src, dst, dist, rank)``; ties of distance go to the smaller id."""
    points = cut(df.where(F.col(col).isNotNull() & F.col(id_col).isNotNull())
                 .select(*by, F.col(id_col).alias("id"), F.col(col).cast("array<double>").alias("f")))
    types = dict(points.dtypes)
    head = "".join(f"`{c}` {types[c]}, " for c in by)
    # a fixed number of points, chosen by hash
    chosen = [r["f"] for r in points.orderBy(F.xxhash64("f"), "f").select("f").limit(pivots).collect()]
    if not chosen:
        return points.select(*by, F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("dist"),
                             F.lit(0).cast("long").alias("rank")).limit(0)
    centre = np.random.default_rng(7).permutation(np.unique(np.array(chosen, float), axis=0))
    filed = blocks(points, by, centre, block)
    keys = [*by, "block"]

    def own(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["f"].to_numpy())
        n = len(part)
        bound = np.full(n, np.inf)
        if n > k:
            d = _distances(x, x)
            np.fill_diagonal(d, np.inf)
            bound = np.partition(d, k - 1, axis=1)[:, k - 1] * (1 + SLACK) + SLACK
        return part.assign(bound=bound)

    bounded = cut(deal(filed, *keys).groupBy(*keys).applyInPandas(
        own, f"{head}id {types['id']}, f array<double>, pivot int, r double, block long, bound double"))

    def ranges(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Range of distances of a block's points to every pivot, of the points in this batch."""
        for part in it:
            if not len(part):
                continue
            d = _distances(np.stack(part["f"].to_numpy()), centre)
            for key, at in part.groupby(keys).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                yield pd.DataFrame({**{c: [v] * len(centre) for c, v in zip(keys, key)}, "pivot": np.arange(len(centre), dtype="int32"),
                                    "reach": part["bound"].to_numpy()[at].max(), "nearest": d[at].min(axis=0), "farthest": d[at].max(axis=0)})

    seen = bounded.mapInPandas(ranges, f"{head}block long, pivot int, reach double, nearest double, farthest double")
    reaches = seen.groupBy(*keys, "pivot").agg(F.max("reach").alias("reach"), F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest"))
    # the reach of a block is the largest of all its points, not of those with this pivot
    shells = bounded.groupBy(*keys, "pivot").agg((F.min("r") - SLACK).alias("inner"), (F.max("r") + SLACK).alias("outer"))
    pairs = cut(block_pairs(shells, reaches, by).unionByName(shells.select(*by, "block", F.col("block").alias("other"))))
    found = compared(bounded, pairs, by, k, centre, block, "float" if dict(df.dtypes)[col] == "array<float>" else "double")
    order = Window.partitionBy(*by, "src").orderBy(F.round("dist", 9), "dst")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)
