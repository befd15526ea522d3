"""SimHash near-duplicates with pigeonring filtering.

A fingerprint of 64 bits is a ring of 4 segments.  If two fingerprints differ in at most ``MAX_BITS`` = 3 bits, some
segment starts a chain in which the first l segments together differ in at most l * 3 / 4 bits, for every l: none in
the first, at most one in two, at most two in three, at most three in all.

1. Equal fingerprints are one node, so copies cost one row.
2. A node is filed under 8 keys: each start of a chain (16 equal bits) with each half of the next segment, one of which
   is equal if that segment differs in at most one bit.
3. Inside a bucket the cumulative differences along the chain prune pairs, then the full distance is checked.
   A bucket gives the links of a spanning forest of its nodes, not all pairs, and a bucket above ``BLOCK`` nodes is
   dealt to tasks as pairs of blocks, so no task holds more than two blocks.
4. Components of the links are labelled by distributed rounds.

Defined cases: null or blank text has fingerprint zero and is linked like any other; a text of fewer words than a
shingle is one shingle; repeated rows get one component; a null id never names a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.fixpoint import label_components
from ..session import cut
from .textops import text_bytes

MAX_BITS, SEGMENTS, SEED, BLOCK = 3, 4, 42, 2048
#: A byte's bits, most significant first, as 8 counters of one byte.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]


def shingle_hashes(text: bytes, size: int = 3, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle of lower-cased (A to Z) words, repeats included."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - size].tolist()]
    return [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def fingerprints(hashes: list[int], sizes: list[int]) -> np.ndarray:
    """Majority vote per bit over the hashes of each text; ``sizes`` has the number of hashes of each."""
    sizes = np.asarray(sizes, np.int64)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    spread = _SPREAD[np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)]
    first = np.cumsum(n) - n
    blocks = -(-n // 255)  # 255 rows fit in a counter of one byte
    head = np.cumsum(blocks) - blocks
    at = np.repeat(first, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(head, blocks))
    part = np.add.reduceat(spread, at, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
    votes = np.add.reduceat(part, head, axis=0)
    out[full] = np.packbits(2 * votes > n[:, None], axis=1).view(">u8")[:, 0]
    return out


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(doc_id, tag, fp)`` for each row; ``tag`` is a hash of the text that tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, hashes, sizes = [], [], []
            for text in text_bytes(batch.column(2)):
                mine = shingle_hashes(text, size)
                hashes += mine
                sizes.append(len(mine))
                if len(hashes) > 100_000:
                    found.append(fingerprints(hashes, sizes))
                    hashes, sizes = [], []
            found.append(fingerprints(hashes, sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(found).view(np.int64))],
                                             names=["doc_id", "tag", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tag"),
                       F.col(text_col).alias("t")).mapInArrow(run, "doc_id long, tag long, fp long")


def chain_holds(differ: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the chain of segments from ``start`` stays within its budgets, the last of which is the full distance."""
    total, holds = np.zeros(len(differ), np.int64), np.ones(len(differ), bool)
    for length in range(1, SEGMENTS + 1):
        shift = ((start + length - 1) % SEGMENTS * 16).astype(np.uint64)
        total += np.bitwise_count(differ >> shift & np.uint64(0xFFFF))
        holds &= total <= length * MAX_BITS // SEGMENTS
    return holds


def _forest(fp: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
    """Links that join the nodes of a bucket as all its links would."""
    left = np.arange(1, len(fp))
    queue, start_of = [0], np.full(len(fp), start)
    while queue or len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        node = queue.pop()
        near = chain_holds(fp[left] ^ fp[node], start_of[: len(left)])
        for other in left[near]:
            queue.append(other)
            yield node, other
        left = left[~near]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each group in rows sorted by group; a group may span batches."""
    rest = None

    def links(group: np.ndarray, start: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        u, v = [], []
        head = np.flatnonzero(np.diff(group, prepend=group[0] - 1) if len(group) else [])
        size = np.diff(head, append=len(group))
        for step in range(1, 8):  # small groups: every pair, all groups at once
            a = np.concatenate([head[(size <= 8) & (size > step)] + i for i in range(8 - step)])
            a = a[(a + step < len(group))]
            a = a[group[a] == group[a + step]]
            hit = a[chain_holds(fp[a] ^ fp[a + step], start[a])]
            u.append(fp[hit])
            v.append(fp[hit + step])
        for h, n in zip(head[size > 8], size[size > 8]):
            own = fp[h: h + n]
            pairs = np.array(list(_forest(own, start[h])), np.int64).reshape(-1, 2)
            u.append(own[pairs[:, 0]])
            v.append(own[pairs[:, 1]])
        u, v = np.concatenate(u).view(np.int64), np.concatenate(v).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    for batch in batches:
        key, lo, hi, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        now = np.stack([key, lo, hi, fp])
        now = now if rest is None else np.concatenate([rest, now], axis=1)
        new = np.flatnonzero((np.diff(now[:3], axis=1) != 0).any(axis=0)) + 1
        if not len(new):
            rest = now
            continue
        done, rest = now[:, : new[-1]], now[:, new[-1]:]
        group = np.zeros(done.shape[1], np.int64)
        group[new[:-1]] = 1
        yield links(np.cumsum(group), done[0] >> 25, done[3].view(np.uint64))
    if rest is not None:
        yield links(np.zeros(rest.shape[1], np.int64), rest[0] >> 25, np.ascontiguousarray(rest[3]).view(np.uint64))


def links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fp`` that connect what all near pairs would connect."""
    filed = []
    for start in range(SEGMENTS):
        segment = F.shiftrightunsigned("fp", 16 * start).bitwiseAND(0xFFFF)
        after = F.shiftrightunsigned("fp", 16 * ((start + 1) % SEGMENTS))
        for half in range(2):
            part = F.shiftrightunsigned(after, 8 * half).bitwiseAND(0xFF)
            filed.append(F.lit((start * 2 + half) << 24).cast("long") + F.shiftleft(segment, 8) + part)
    keys = nodes.select("fp", F.explode(F.array(*filed)).alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("long")
    own = F.pmod(F.xxhash64("fp"), blocks)
    dealt = (keys.join(sizes, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    return (dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(_buckets, "u long, v long").distinct())


def classes(table: DataFrame) -> DataFrame:
    """``(fp, root, component_id)`` for each distinct fingerprint of ``(doc_id, fp)`` rows."""
    nodes = cut(table.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = label_components(links(nodes.select("fp")))
    rooted = cut(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                 .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs``."""
    table = cut(fingerprint_table(docs, id_col, text_col))
    return table.join(classes(table), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: the one with the smallest id (then text hash), all columns unchanged."""
    table = cut(fingerprint_table(docs, id_col, text_col))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tag")
    best = (table.join(classes(table).select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("b"))
            .select(F.col("b.doc_id").alias("__id"), F.col("b.tag").alias("__tag")))
    tagged = docs.withColumn("__tag", F.xxhash64(text_col))
    same = F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("b.__id")) & (F.col("d.__tag") == F.col("b.__tag"))
    kept = tagged.alias("d").join(best.alias("b"), same, "left_semi")
    once = Window.partitionBy("__tag", id_col).orderBy("__tag")
    return kept.withColumn("__n", F.row_number().over(once)).where("__n = 1").select(*docs.columns)
