"""Best-fit packing of documents into sequences of a fixed number of tokens, by exact complements.

A plan needs only how many pieces there are of each length, at most ``capacity`` numbers whatever the size of the
corpus.  The sums of pairs and triples of the lengths that occur are indexed once.  Lengths are taken from the longest
down; what is missing to a full sequence is looked up as a single length, then among the sums of pairs, then of triples,
and each combination found is used as often as the counts allow.  What has no exact complement goes into the open sequence with the smallest gap that takes it.  A plan is a list of patterns
(lengths side by side, and how often); it is made from the counts alone, so the driver holds no piece.

Pieces are numbered within their length by two-level counts (chunk totals, then inside a chunk) and find their pattern,
sequence and offset by that number, each task on its own, so a length shared by a third of all pieces is many tasks.

Defined cases: null or empty text is the end token alone; repeated rows and repeated ids are packed as often as they
come; an empty table gives an empty plan; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut
from .textops import Ranges, byte_values, packs, text_bytes

CAPACITY, CHUNKS = 2048, 1024
#: Bytes of text encoded at a time, and different words whose ids a worker remembers.
PACK, REMEMBERED = 800_000, 700_000
#: White space other than space and line feed, as the tokenizer sees it; a text with any is encoded whole.
_OTHER_SPACE = [x.encode() for x in "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0        "
                "        　"]


class Encoder:
    """Byte-level BPE of many texts at once; equal to encoding each text whole.

    The tokenizer never joins characters across the border before a single space or line feed, so the ids of a text
    are those of its words, each with the separator before it.  Each different word of a pack is looked up among the
    words seen before, and the new ones are encoded in one call.  Texts with other or repeated white space are encoded
    whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)  # special tokens in a text are found as the file says
        size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._bytes = np.fromiter((len(self._tokenizer.id_to_token(i)) for i in range(size)), np.int64, size)
        self._forget()

    def _forget(self) -> None:
        self._hash, self._slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._first, self._ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        if len(self._hash) + len(hashes) > REMEMBERED:
            self._forget()
        ids = [np.zeros(0, np.uint32)]
        for i in range(0, len(words), 50_000):
            ids.append(self._encode(b"".join(words[i: i + 50_000]).decode()))
        ids = np.concatenate(ids)
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))) + 1
        slots = np.arange(len(hashes)) + len(self._hash)
        order = np.argsort(np.concatenate([self._hash, hashes]), kind="stable")
        self._hash = np.concatenate([self._hash, hashes])[order]
        self._slot = np.concatenate([self._slot, slots])[order]
        self._first = np.concatenate([self._first, ends + len(self._ids)])
        self._ids = np.concatenate([self._ids, ids])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self._hash, hashes), max(0, len(self._hash) - 1))
        return (self._slot[at], self._hash[at] == hashes) if len(self._hash) else (at, np.zeros(len(hashes), bool))

    def _even(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts in which single spaces and line feeds stand between words."""
        buf = b"\n" + b"\n".join(texts) + b"\n"
        view = np.frombuffer(buf, np.uint8)
        gaps = np.flatnonzero((view == 32) | (view == 10))
        start, end = gaps[:-1], gaps[1:]  # a word with the separator before it
        hashes = Ranges(byte_values(view), "byte").hash(start, end)
        different, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        _, known = self._find(different)
        if not known.all():
            if len(self._hash) + int((~known).sum()) > REMEMBERED:
                self._forget()
                known[:] = False
            new = one[~known]
            self._learn(different[~known], [buf[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
        slot, _ = self._find(different)
        slot = slot[which]
        size = self._first[slot + 1] - self._first[slot]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self._ids[np.repeat(self._first[slot] - upto[:-1], size) + np.arange(upto[-1])]
        texts_at = np.cumsum([0, *(len(t) + 1 for t in texts)])
        bound = upto[np.searchsorted(start, texts_at)]
        return [ids[a + 1: b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]  # without the first line feed

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text."""
        out: list = [None] * len(texts)
        for a, b in packs(texts, PACK):
            buf = b"\n" + b"\n".join(texts[a:b]) + b"\n"
            bounds = np.cumsum([1, *(len(t) + 1 for t in texts[a:b])])
            view = np.frombuffer(buf, np.uint8)
            space = (view == 32) | (view == 10)
            twice = np.flatnonzero(space[1:] & space[:-1])
            where = [twice, twice + 1]
            for other in _OTHER_SPACE:
                at = buf.find(other)
                while at >= 0:
                    where.append(np.array([at]))
                    at = buf.find(other, int(bounds[np.searchsorted(bounds, at, "right")]))  # on with the next text
            odd = set((np.searchsorted(bounds, np.concatenate(where), "right") - 1).tolist())
            even = [i for i in range(b - a) if i not in odd and texts[a + i]]
            for i in sorted(odd - {-1, b - a}):
                out[a + i] = self._encode(texts[a + i].decode())
            for i, found in zip(even, self._even([texts[a + i] for i in even]) if even else ()):
                out[a + i] = found
        return [np.zeros(0, np.uint32) if x is None else x for x in out]


@cache
def _encoder(path: str) -> Encoder:
    """One for each worker."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, ids)``: token ids, cut into pieces; only a first piece is shorter
    than the capacity when a document is cut.  ``ids`` are little-endian bytes, two an id if the vocabulary allows it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        for batch in batches:
            rows: list[tuple] = []
            texts = text_bytes(batch.column(1))
            for doc, found in zip(batch.column(0).to_pylist(), chain.from_iterable(
                    encoder.ids(texts[a:b]) for a, b in packs(texts, PACK))):
                ids, short = found.astype("<u4").tobytes() + end, found.astype(encoder.dtype).tobytes() + end[:encoder.dtype.itemsize]
                width = encoder.dtype.itemsize
                n = len(ids) // 4
                first = n % capacity or capacity
                for i, start in enumerate([0, *range(first, n, capacity)]):
                    stop = start + (first if not i else capacity)
                    part = ids[4 * start: 4 * stop]
                    rows.append((doc, i, start, len(part) // 4, crc32(part), short[width * start: width * stop]))
                if len(rows) >= 2000:
                    yield _batch(rows, names)
                    rows = []
            yield _batch(rows, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    doc, piece, start, length, crc, ids = zip(*rows) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
         pa.array(crc, pa.int64()), pa.array(ids, pa.binary())], names=names)


def _by_sum(parts: list[tuple[int, np.ndarray]], top: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first, length)``: the lengths filed under sum ``s`` are ``length[first[s]: first[s + 1]]``, ascending."""
    sums = np.concatenate([s for _, s in parts]) if parts else np.zeros(0, np.int64)
    length = np.repeat([a for a, _ in parts], [len(s) for _, s in parts]) if parts else np.zeros(0, np.int64)
    order = np.argsort(sums, kind="stable")
    return np.searchsorted(sums[order], np.arange(top + 2)), length[order].astype(np.int64)


class _Stock:
    """Available pieces by length, and an index of the sums of two and of three available lengths.

    Both indexes are built once, from the lengths that occur: a sum leads to the longer length of each pair with that
    sum, and to the longest length of each triple (the other two are then a pair with the rest as sum).  Stock only
    falls, so an entry that the counts no longer allow is skipped and none is ever missing.  They hold at most
    ``capacity ** 2 / 4`` pairs and ``capacity ** 2 / 2`` triples, whatever the size of the corpus.
    """

    def __init__(self, counts: np.ndarray):
        self.n, top = counts.astype(np.int64), len(counts) - 1
        have = np.flatnonzero(self.n)
        have = have[have > 0]
        pairs = [(a, a + have[: np.searchsorted(have, min(a, top - a), "right")]) for a in have.tolist()]
        self._pairs = _by_sum(pairs, top)
        shortest = np.full(top + 1, top + 1)  # of the longer lengths of the pairs with a sum
        some = np.flatnonzero(np.diff(self._pairs[0]))
        shortest[some] = self._pairs[1][self._pairs[0][some]]
        self._triples = _by_sum([(a, a + np.flatnonzero(shortest[: top - a + 1] <= a)) for a in have.tolist()], top)

    @staticmethod
    def _filed(index: tuple[np.ndarray, np.ndarray], total: int, largest: int) -> np.ndarray:
        first, length = index
        found = length[first[total]: first[total + 1]]
        return found[: np.searchsorted(found, largest, "right")]

    def pair(self, total: int, largest: int) -> tuple[int, int] | None:
        """Two available lengths with this sum, the larger as large as possible but not above ``largest``."""
        high = self._filed(self._pairs, total, largest)
        good = np.flatnonzero((self.n[high] > 0) & (self.n[total - high] > (high * 2 == total)))
        return (int(high[good[-1]]), total - int(high[good[-1]])) if len(good) else None

    def triple(self, total: int, largest: int) -> tuple[int, int, int] | None:
        """Three available lengths with this sum, the longest as long as possible but not above ``largest``."""
        longest = self._filed(self._triples, total, largest)
        for a in longest[self.n[longest] > 0][::-1].tolist():
            self.n[a] -= 1
            two = self.pair(total - a, a)
            self.n[a] += 1
            if two:
                return (a, *two)
        return None

    def complement(self, gap: int, largest: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``."""
        if gap <= largest and self.n[gap]:
            return (gap,)
        return self.pair(gap, largest) or self.triple(gap, largest)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns ``(lengths, times)`` that use up ``counts`` (pieces by length, 0 to ``capacity``)."""
    stock, done, left = _Stock(counts), [], {}
    for length in range(capacity, 0, -1):
        while stock.n[length]:
            if length == capacity:
                done.append(((length,), int(stock.n[length])))
                stock.n[length] = 0
                break
            stock.n[length] -= 1
            rest = stock.complement(capacity - length, length)
            stock.n[length] += 1
            if rest is None:
                left[length] = int(stock.n[length])
                stock.n[length] = 0
                break
            need = np.bincount([length, *rest], minlength=capacity + 1)
            used = np.flatnonzero(need)
            times = int((stock.n[used] // need[used]).min())
            stock.n[used] -= times * need[used]
            done.append(((length, *rest), times))
    return done + _best_fit(left, capacity)


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in order of falling length, for all pieces of a length and all open sequences alike at once."""
    open_by_gap: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]
    some = np.zeros(capacity + 1, bool)
    for length, n in left.items():
        while n:
            gaps = np.flatnonzero(some[length:])
            if not len(gaps):
                each = capacity // length
                for lengths, times in (((length,) * each, n // each), ((length,) * (n % each), 1)):
                    if times and lengths:
                        gap = capacity - length * len(lengths)
                        open_by_gap[gap][lengths] = open_by_gap[gap].get(lengths, 0) + times
                        some[gap] = True
                break
            gap = int(gaps[0]) + length
            lengths, have = open_by_gap[gap].popitem()
            times = min(n, have)
            if have > times:
                open_by_gap[gap][lengths] = have - times
            some[gap] = bool(open_by_gap[gap])
            now = open_by_gap[gap - length]
            now[(*lengths, length)] = now.get((*lengths, length), 0) + times
            some[gap - length] = True
            n -= times
    return [x for by in open_by_gap for x in by.items()]


class Places:
    """Sequence and offset of the r-th piece of a length under a plan."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY):
        runs: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for lengths, times in patterns:
            for i, length in enumerate(lengths):
                runs.setdefault(length, []).append((sequence, sum(lengths[:i]), times))
            sequence += times
        self._runs = {}
        for length, found in runs.items():
            first, offset, times = np.array(found, np.int64).T
            self._runs[length] = (np.cumsum(times) - times, first, offset)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for value in np.unique(length).tolist():
            rows = np.flatnonzero(length == value)
            head, first, at = self._runs[value]
            run = np.searchsorted(head, rank[rows], "right") - 1
            sequence[rows], offset[rows] = first[run] + rank[rows] - head[run], at[run]
        return sequence, offset


def assign(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` and a unique ``key``."""
    rows = table.withColumn("_chunk", F.pmod(F.xxhash64("key"), F.lit(CHUNKS)))
    sums = cut(rows.groupBy("length", "_chunk").agg(F.count("*").alias("_n")))
    upto = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select("length", "_chunk", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_head"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    places = Places(plan(counts, capacity), capacity)
    inside = Window.partitionBy("length", "_chunk").orderBy("key")
    ranked = rows.withColumn("_inner", F.row_number().over(inside) - 1).join(heads, ["length", "_chunk"])
    ranked = ranked.select(*table.columns, (F.col("_head") + F.col("_inner")).alias("_rank"))
    schema = ", ".join(f"`{n}` {t}" for n, t in table.dtypes) + ", sequence_id long, offset long"
    names = [*table.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            where = places.of(batch.column("length").to_numpy(zero_copy_only=False), rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, where)], names=names)

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """Token table and places: ``(key, doc_id, piece, start, length, ids_crc32, ids)`` as written to the shared folder,
    and the same rows without ids but with ``sequence_id`` and ``offset``.  The sequences are the join by ``key``."""
    tokens = cut(pieces(docs, tokenizer, capacity, end_id).withColumn("key", F.monotonically_increasing_id()))
    return tokens, assign(tokens.drop("ids"), capacity)


def _numbers(table: DataFrame) -> DataFrame:
    """``table`` with its column ``ids`` as numbers; a row has a column ``length``."""
    schema = ", ".join(f"`{n}` {'array<int>' if n == 'ids' else t}" for n, t in table.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lengths, ids = part.column("length").to_numpy(zero_copy_only=False), part.column("ids").to_pylist()
                flat = b"".join(ids)
                width = len(flat) // max(1, int(lengths.sum()))
                values = np.frombuffer(flat, f"<u{width or 2}").astype(np.int32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                yield part.set_column(part.schema.get_field_index("ids"), "ids", pa.ListArray.from_arrays(offsets, pa.array(values)))

    return table.mapInArrow(run, schema)


def with_ids(tokens: DataFrame, placed: DataFrame) -> DataFrame:
    """``placed`` with the ids of each piece; its rows by offset are the sequences, and no row is grouped or sorted."""
    return _numbers(placed.join(tokens.select("key", "ids"), "key"))


def sequences(tokens: DataFrame, placed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences; a sequence holds at most ``capacity`` ids."""
    parts = _numbers(tokens.select("key", "length", "ids").join(placed.select("key", "sequence_id", "offset"), "key"))
    by_offset = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(by_offset, lambda x: x["ids"])).alias("ids"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
