"""Tokens of two tokenizers aligned by the bytes they cover, with how often two ids meet in the corpus.

Both tokenizers cut the same bytes, a space and the text.  Where a token of each ends at the same byte, both sides are
cut; the tokens between two cuts are a group, and every token of one side in it is linked with every one of the other.

Work inside a task is Arrow columns: token lists are flattened with their parent indices, ends are running sums of the
tokens' bytes within a document, common ends are a hash join of the two sides on (document, end), and links are a hash
join of the two sides on the group, after equal ids of a group are counted together.  So a long group costs its
different ids, not its tokens squared.

1. One pass encodes the texts and writes a row for each document: its figures and its different linked id pairs with how
   often each is linked in it.
2. ``Table.group_by`` counts the documents of each pair inside a task, Spark merges the counts.
3. The counts, one row a pair and no more than the two vocabularies allow, are dealt by hash into shards of at most
   ``SHARD`` rows (checked).  Each shard is sent out in turn and meets the documents' pairs in a pass over the written
   rows; a document's sums over the shards are added.  No link leaves its row.

Defined cases: null and empty texts, and texts whose tokens do not give back their bytes (a U+2581 in the text, bytes that
are not UTF-8), have no tokens: all figures are 0 and the digest is ''.  Repeated rows are documents of their own, also
for the counts.  Strings of special tokens in a text are plain text.  A text longer than a pack is a pack of its own.
An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import cut
from .memo import WordMemo, split_by_bytes
from .textops import packs, text_bytes

#: Bytes of text aligned at a time, pairs a task counts before it hands them on, and rows of a shard of counts.
PACK, HELD, SHARD = 500_000, 1_000_000, 1 << 21
#: Ids of the second tokenizer are below this, so a pair of ids is one number.
SIDE = 1 << 15
ROW = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "pairs array<int>, times array<int>")


class ByteSide:
    """Byte-level BPE; a space stands before each word, so words are encoded apart at single spaces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        names = [self._tokenizer.id_to_token(i) for i in range(self._tokenizer.get_vocab_size())]
        # the printable characters that byte-level vocabularies write for bytes (a fixed rule of the format)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.bytes = [bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode() for x in names]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.memo = WordMemo(lambda t: t.split(b" "), self._learn, self._whole)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")

    def _whole(self, text: bytes) -> bytes:
        return self._ids(" " + text.decode("utf-8", "replace")).tobytes()

    def _learn(self, words: list[bytes]) -> list[bytes | None]:
        texts = [w.decode("utf-8", "replace") for w in words]
        # a word that begins or ends with white space joins it to the space beside it
        good = [i for i, t in enumerate(texts) if t and not t[0].isspace() and not t[-1].isspace()]
        out: list[bytes | None] = [None] * len(words)
        if good:
            ids = self._ids("".join(" " + texts[i] for i in good))
            for i, own in zip(good, split_by_bytes(ids, self.sizes, [len(texts[i].encode()) + 1 for i in good])):
                out[i] = own
        return out


class PieceSide:
    """Sentence pieces that never cross the border before a space; the library puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        if m.get_piece_size() > SIDE:
            raise ValueError(f"more than {SIDE} pieces")
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any("▁" in x.lstrip("▁") for x in names):
            raise ValueError("a piece crosses the border between words")
        self.bytes = [bytes([int(x[3:5], 16)]) if m.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.memo = WordMemo(lambda t: t.split(b" "), self._learn, self._whole)

    def _whole(self, text: bytes) -> bytes:
        return np.array(self._model.encode(text.decode("utf-8", "replace"), num_threads=1), "<u2").tobytes()

    def _learn(self, words: list[bytes]) -> list[bytes | None]:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self._model.encode(texts, num_threads=1)
        return [np.array(ids, "<u2").tobytes() if t and "▁" not in t else None for t, ids in zip(texts, found)]


@cache
def _sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    """One of each for a worker."""
    return ByteSide(path_a), PieceSide(path_b)


def _covered(side, ids: pa.ListArray, whole: bytes, ends: np.ndarray) -> np.ndarray:
    """Which documents the tokens give back; the bytes of document i end at ``ends[i]`` of ``whole``."""
    table = pa.array(side.bytes, pa.large_binary())
    joined = table.take(ids.flatten())
    data = joined.buffers()[2].to_pybytes()[: int(side.sizes[ids.flatten().to_numpy()].sum())] if len(joined) else b""
    if data == whole:
        return np.ones(len(ids), bool)
    upto = np.concatenate([[0], np.cumsum(side.sizes[ids.flatten().to_numpy()])])[ids.offsets.to_numpy()]
    starts = np.concatenate([[0], ends[:-1]])
    return np.array([data[a:b] == whole[c:d] for a, b, c, d in zip(upto[:-1], upto[1:], starts, ends)], bool)


def _list(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) // 2 for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<u2").astype(np.int32)))


def _side_table(lists: pa.ListArray, sizes: np.ndarray) -> pa.Table:
    """``(doc, id, end, row)`` of all tokens; ``end`` is a running sum of bytes within the document."""
    doc, ids = pc.list_parent_indices(lists), lists.flatten()
    upto = pc.cumulative_sum(pa.array(sizes).take(ids))
    offsets = lists.offsets.to_numpy()
    before = np.concatenate([[0], upto.to_numpy()])[offsets[:-1]]  # bytes of all documents before each
    end = pc.subtract(upto, pa.array(before).take(doc))
    return pa.table({"doc": doc.cast(pa.int64()), "id": ids, "end": end, "row": pa.array(np.arange(len(ids)))})


def _groups(n: int, ends: np.ndarray) -> np.ndarray:
    """Group of each of n tokens: how many common ends lie before it."""
    flags = np.zeros(n + 1, np.int64)
    flags[ends + 1] = 1
    return np.cumsum(flags)[:n]


def _spelled(ids: pa.Array, group: np.ndarray, n: int) -> pa.Array:
    """Decimal ids of each group, joined by commas."""
    offsets = np.searchsorted(group, np.arange(n + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.cast(pa.string())), ",")


def align(a: pa.ListArray, b: pa.ListArray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> dict[str, pa.Array]:
    """Figures and linked pairs of documents, given the ids of both sides, which cover the same bytes."""
    n = len(a)
    ta, tb = _side_table(a, sizes_a), _side_table(b, sizes_b)
    common = ta.select(["doc", "end", "row"]).join(tb.select(["doc", "end", "row"]), ["doc", "end"], join_type="inner", right_suffix="_b",
                                                   use_threads=False)
    rows_a, rows_b = np.sort(common["row"].to_numpy()), np.sort(common["row_b"].to_numpy())
    ga, gb = _groups(len(ta), rows_a), _groups(len(tb), rows_b)
    n_groups, doc_a = len(rows_a), ta["doc"].to_numpy()
    per_doc = np.bincount(doc_a[rows_a], minlength=n)
    links = np.bincount(ga, minlength=n_groups) * np.bincount(gb, minlength=n_groups)
    doc_of = doc_a[rows_a]
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc_of, links)
    texts = pc.binary_join_element_wise(_spelled(ta["id"].combine_chunks(), ga, n_groups), _spelled(tb["id"].combine_chunks(), gb, n_groups), "|")
    by_doc = pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32))
    digest = [hashlib.sha256(x.as_buffer()).hexdigest() if k else "" for x, k in zip(
        pc.binary_join(pa.ListArray.from_arrays(by_doc, texts), ";"), per_doc.tolist())]
    side = lambda t, g: pa.table({"group": g, "id": t["id"]}).group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")])
    met = side(ta, ga).join(side(tb, gb), "group", join_type="inner", right_suffix="_b", use_threads=False)
    pair = pc.add(pc.multiply(met["id"].cast(pa.int64()), SIDE), met["id_b"].cast(pa.int64()))
    found = pa.table({"doc": pa.array(doc_of).take(met["group"].combine_chunks()), "pair": pair.cast(pa.int32()),
                      "times": pc.multiply(met["count_all"], met["count_all_b"])})
    found = found.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    offsets = pa.array(np.searchsorted(found["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32))
    lists = lambda c: pa.ListArray.from_arrays(offsets, found[c].combine_chunks().cast(pa.int32()))
    return {"n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()), "n_groups": pa.array(per_doc),
            "n_links": pa.array(n_links), "groups_sha256": pa.array(digest, pa.string()), "pairs": lists("pair"), "times": lists("times_sum")}


def _aligned(texts: list[bytes], sides: tuple[ByteSide, PieceSide]) -> dict[str, pa.Array]:
    ends = np.cumsum([len(t) + 1 if t else 0 for t in texts])
    whole = b"".join(b" " + t for t in texts if t)
    ids = [side.memo.encode([t for t in texts if t]) for side in sides]
    lists = []
    for own in ids:
        it = iter(own)
        lists.append(_list([next(it) if t else b"" for t in texts]))
    good = _covered(sides[0], lists[0], whole, ends) & _covered(sides[1], lists[1], whole, ends)
    if not good.all():
        flags, empty = good.tolist(), pa.scalar([], pa.list_(pa.int32()))
        lists = [pc.if_else(pa.array(flags), x, empty) for x in lists]
        lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy())]).astype(np.int32)), x.flatten())
                 for x in lists]
    return align(*lists, sides[0].sizes, sides[1].sizes)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: figures, digest, and its linked pairs (a * ``SIDE`` + b) with their numbers of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in packs(texts, PACK):
                found = _aligned(texts[a:b], sides)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *found.values()], names=["doc_id", *found])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, ROW)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n)``: the number of documents that hold each pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            pairs = pa.table({"pair": batch.column(0).flatten()})
            held.append(pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]))
            if sum(map(len, held)) > HELD:
                held = [_merged(held)]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=100_000)
        if held:
            yield from _merged(held).to_batches(max_chunksize=100_000)

    return rows.select("pairs").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _merged(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])


def judged(counts: DataFrame) -> DataFrame:
    """``(pair, n, best)``: whether a pair has the highest count of its first id."""
    first = F.shiftright("pair", 15)
    top = counts.groupBy(first.alias("a")).agg(F.max("n").alias("m"))
    return counts.withColumn("a", first).join(top, "a").select("pair", "n", (F.col("n") == F.col("m")).alias("best"))


def link_sums(rows: DataFrame, counts: DataFrame, shard: int = SHARD) -> DataFrame:
    """``(key, n_best, count_sum)`` of rows ``(key, pairs, times)``: links whose pair is its first id's best, and the
    sum of the counts over all links."""
    spark = rows.sparkSession
    shards = 1
    while True:  # hash shards are nearly equal; more of them until each is within the bound
        dealt = counts.withColumn("_shard", F.pmod(F.xxhash64("pair"), F.lit(shards)))
        most = dealt.groupBy("_shard").count().agg(F.max("count")).first()[0] or 0
        if most <= shard:
            break
        shards = max(shards + 1, -(-shards * most * 11 // (shard * 10)))

    def passed(number: int) -> DataFrame:
        part = dealt.where(F.col("_shard") == number).select("pair", "n", "best").orderBy("pair").toArrow()
        sent = spark.sparkContext.broadcast((part["pair"].to_numpy(), part["n"].to_numpy(), part["best"].to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, n, best = sent.value
            for batch in batches:
                lists = batch.column(1)
                doc, own, times = pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
                at = np.minimum(np.searchsorted(pair, own), max(0, len(pair) - 1))
                here = pair[at] == own if len(pair) else np.zeros(len(own), bool)
                times = times.astype(np.int64) * here
                sums = np.zeros((2, batch.num_rows), np.int64)
                if len(pair):
                    np.add.at(sums[0], doc, times * best[at])
                    np.add.at(sums[1], doc, times * n[at])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1])], names=["key", "n_best", "count_sum"])

        return rows.select("key", "pairs", "times").mapInArrow(run, "key long, n_best long, count_sum long")

    out = passed(0)
    for number in range(1, shards):
        out = out.unionByName(passed(number))
    return out if shards == 1 else out.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
              shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """Figures of every document, and the counts ``(pair, n, best)`` of the corpus."""
    rows = cut(aligned(docs, path_a, path_b, id_col, text_col).withColumn("key", F.monotonically_increasing_id()))
    counts = cut(judged(cut(pair_counts(rows))))
    sums = link_sums(rows, counts, shard)
    return rows.drop("pairs", "times").join(sums, "key").drop("key"), counts
