"""Token ids in binary files: independent zstandard frames, a trailing seek table and a checksum for each frame.

A file is a sequence of zstandard frames, each readable alone, and ends with the seek table of the public zstandard
seekable format (a skippable frame of compressed size, size and the low 32 bits of XXH64 of each frame, then a footer).
The last frame before the table is the file's index, an Arrow stream of ``(doc_id, n, frame, at)``: each document's
id, its number of tokens, and where its ids begin.  The frames before it hold ids as little-endian unsigned integers,
two bytes each if the vocabulary allows it.  A frame is closed by the document that fills it, so short documents share
one; a long document goes on over frames of its own.  A reader of some documents reads the tail of the file, the index
and the frames of those documents.

``write`` sorts the documents by id into ranges.  A task streams its range into files of at most ``FILE`` ids (or one
document) under names of its own and returns a row for each finished file.  These rows are the manifest, a Parquet table
beside the files that Spark commits as a whole: what a lost or repeated task has left is in no manifest and is never
read.  The number of ids before each file is a sum over the manifest, one row a file, in two levels.

Defined cases: null and empty texts are documents with the end id alone; null ids come first; repeated rows are written
as often as they come, and different texts of one id are ordered by a hash of the text; bytes that are not UTF-8 are
encoded as U+FFFD; a document may be longer than a frame and than a file's limit; an empty table has an empty manifest;
other columns are ignored.  A frame that does not match its checksum is an error.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .memo import WordMemo, split_by_bytes
from .textops import packs, text_bytes

#: Bytes of ids in a frame, ids in a file, and bytes of text encoded at a time.
FRAME, FILE, PACK = 1 << 18, 1 << 25, 1_000_000
LEVEL = 3
#: Matches words of characters that the tokenizer's normalizer leaves at their number of bytes.
SAME_BYTES = re.compile(rb"[\x00-\x7f]*(?:\xc3[\x80-\xbf][\x00-\x7f]*)*").fullmatch
#: Fixed values of the seekable format: skippable frame, footer, descriptor "with checksums".
SKIPPABLE, FOOTER, CHECKED = 0x184D2A5E, 0x8F92EAB1, 0x80
MANIFEST = "file string, part int, number int, docs long, ids long, frames long"


class FrameWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, sink, width: int, frame: int = FRAME):
        self._sink, self._width, self._frame = sink, width, frame
        self._pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._open: list[bytes] = []
        self._size = 0
        self._table: list[tuple[int, int, int]] = []
        self._index: tuple[list, list, list, list] = ([], [], [], [])
        self.docs = self.ids = 0

    def _flush(self, data: bytes) -> None:
        packed = self._pack.compress(data)
        self._sink.write(packed)
        self._table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self._size and self._size + len(ids) > 2 * self._frame:  # a long document begins a frame
            self._close_frame()
        for column, value in zip(self._index, (doc_id, len(ids) // self._width, len(self._table), self._size)):
            column.append(value)
        self._open.append(ids)
        self._size += len(ids)
        self.docs += 1
        self.ids += len(ids) // self._width
        if self._size >= self._frame:
            self._close_frame()

    def _close_frame(self) -> None:
        data = b"".join(self._open)
        for i in range(0, len(data), 2 * self._frame):
            self._flush(data[i: i + 2 * self._frame])
        self._open, self._size = [], 0

    def close(self) -> int:
        """Write the rest, the index and the seek table; returns the number of frames with ids."""
        if self._size:
            self._close_frame()
        frames = len(self._table)
        doc_id, n, frame, at = self._index
        index = pa.table({"doc_id": pa.array(doc_id, pa.int64()), "n": pa.array(n, pa.int64()), "frame": pa.array(frame, pa.int32()),
                          "at": pa.array(at, pa.int32())}).replace_schema_metadata({"width": str(self._width)})
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, index.schema) as out:
            out.write_table(index)
        self._flush(stream.getvalue().to_pybytes())
        table = b"".join(struct.pack("<III", *x) for x in self._table)
        self._sink.write(struct.pack("<II", SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self._table), CHECKED, FOOTER))
        self._sink.close()
        return frames


class FrameReader:
    """Random access to one file; ``frames_read`` counts the frames with ids that were decompressed."""

    def __init__(self, source):
        self._source, self._last, self.frames_read = source, (-1, b""), 0
        size = source.size()
        n, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != FOOTER:
            raise ValueError("no seek table at the end of the file")
        raw = np.frombuffer(source.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3)
        self._table = raw.astype(np.int64)
        self._start = np.concatenate([[0], np.cumsum(self._table[:, 0])])
        self.index = pa.ipc.open_stream(self._frame(n - 1)).read_all()
        self.width = int(self.index.schema.metadata[b"width"])

    def _frame(self, i: int) -> bytes:
        size, whole, check = self._table[i].tolist()
        data = zstandard.ZstdDecompressor().decompress(self._source.read_at(size, int(self._start[i])), max_output_size=whole)
        if len(data) != whole or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} does not match its checksum")
        return data

    def ids(self, position: int) -> np.ndarray:
        """Ids of the document at this place of the index."""
        n, i, at = (self.index[c][position].as_py() for c in ("n", "frame", "at"))
        return self.span(n, i, at)

    def span(self, n: int, i: int, at: int) -> np.ndarray:
        """``n`` ids that begin at byte ``at`` of frame ``i``."""
        need, parts = n * self.width, []
        while need:
            if self._last[0] != i:
                self._last = (i, self._frame(i))
                self.frames_read += 1
            parts.append(self._last[1][at: at + need])
            need -= len(parts[-1])
            i, at = i + 1, 0
        return np.frombuffer(b"".join(parts), f"<u{self.width}")

    def all(self) -> Iterator[np.ndarray]:
        """Ids of every document in order."""
        for n, i, at in zip(*(self.index[c].to_pylist() for c in ("n", "frame", "at"))):
            yield self.span(n, i, at)


class WordEncoder:
    """Ids of a tokenizer that drops white space; words between ASCII white space are encoded apart.

    The tokenizer works on words without white space, so the ids of a text are those of its words.  Special tokens are
    found inside words as in whole texts.  Words of ASCII and of U+00C0 to U+00FF are encoded side by side and told apart
    by their bytes: composing and lower-casing leave the number of bytes of these characters as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        suffix = "</w>"
        names = [self._tokenizer.id_to_token(i) or "" for i in range(size)]
        self._bytes = np.array([len(x.removesuffix(suffix)) for x in names], np.int64)
        self.memo = WordMemo(bytes.split, self._learn, self._whole)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.dtype) for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text: bytes) -> bytes:
        return self._ids([text.decode("utf-8", "replace")])[0].tobytes()

    def _learn(self, words: list[bytes]) -> list[bytes]:
        plain = [w for w in words if w.isascii() or SAME_BYTES(w)]
        found = {}
        if plain:
            found = dict(zip(plain, split_by_bytes(self._ids([b" ".join(plain).decode()])[0], self._bytes, list(map(len, plain)))))
        other = [w for w in words if w not in found]
        found |= zip(other, (x.tobytes() for x in self._ids([w.decode("utf-8", "replace") for w in other])))
        return [found[w] for w in words]


@cache
def _encoder(path: str) -> WordEncoder:
    """One for each worker."""
    return WordEncoder(path)


def _folder(path: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(path)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          frame: int = FRAME, file_ids: int = FILE) -> None:
    """Write the ids of all texts, each with ``end_id`` behind it, in ascending order of ids below ``path``.

    ``path`` is a new folder that all executors reach (local, shared or an object store).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _folder(path)
        fs.create_dir(root, recursive=True)
        encoder = _encoder(tokenizer)
        part, end = TaskContext.get().partitionId(), np.array([end_id], encoder.dtype).tobytes()
        done: list[tuple] = []
        name, out = "", None

        def finish() -> None:
            if out:
                frames = out.close()
                done.append((name, part, len(done), out.docs, out.ids, frames))

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for a, b in packs(texts, PACK):
                for doc, found in zip(ids[a:b], encoder.memo.encode(texts[a:b])):
                    if out and out.ids + len(found) // encoder.dtype.itemsize >= file_ids:
                        finish()
                        out = None
                    if not out:
                        name = f"ids-{part:06d}-{len(done):05d}-{uuid.uuid4().hex}.zst"
                        out = FrameWriter(fs.open_output_stream(f"{root}/{name}", compression=None), encoder.dtype.itemsize, frame)
                    out.add(doc, found + end)
        finish()
        columns = list(zip(*done)) or [()] * 6
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    # rows of one id are told apart, so that a key with very many rows is split over ranges
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("tag"),
                        F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange("doc_id", "tag", "row").sortWithinPartitions("doc_id", "tag")
    ordered.select("doc_id", "t").mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file, with the number of ids in all files ``before`` it."""
    found = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("_group", F.floor(F.col("part") / 256))
    sums = found.groupBy("_group").agg(F.sum("ids").alias("_n"))
    upto = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # one row for 256 tasks
    heads = sums.select("_group", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_head"))
    inside = Window.partitionBy("_group").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return (found.withColumn("_inner", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(heads, "_group")
            .select(*(x.split()[0] for x in MANIFEST.split(", ")), (F.col("_head") + F.col("_inner")).alias("before")))


def _spread(rows: DataFrame) -> DataFrame:
    """Files dealt evenly to tasks; there are few rows, so they are dealt one by one."""
    n = rows.count()
    return rows.repartition(max(1, min(n, 10_000)))


def _open(path: str, name: str) -> FrameReader:
    fs, root = _folder(path)
    return FrameReader(fs.open_input_file(f"{root}/{name}"))


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """All documents of the files: ``(doc_id, start, n_tokens, ids)``, or ``ids_crc32`` in place of ``ids``.

    ``start`` is the number of ids of all documents before it.
    """
    last = "ids_crc32 long" if digest else "ids array<int>"
    names = ["doc_id", "start", "n_tokens", last.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(*(batch.column(c).to_pylist() for c in ("file", "before"))):
                source = _open(path, name)
                n = source.index["n"].to_numpy()
                start, ids, rows = before + np.cumsum(n) - n, source.all(), source.index["doc_id"].combine_chunks()
                at = 0
                for size in _slices(n):
                    some = [x.astype("<u4") for _, x in zip(range(size), ids)]
                    what = pa.array([crc32(x.tobytes()) for x in some], pa.int64()) if digest else _lists(some)
                    yield pa.RecordBatch.from_arrays([rows.slice(at, size), pa.array(start[at: at + size]), pa.array(n[at: at + size]), what], names=names)
                    at += size

    return _spread(manifest(spark, path).select("file", "before")).mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")


def _slices(n: np.ndarray, ids: int = 1 << 20) -> Iterator[int]:
    """Numbers of consecutive documents with about so many ids together."""
    count = total = 0
    for x in n.tolist():
        if count and total + x > ids:
            yield count
            count = total = 0
        count, total = count + 1, total + x
    if count:
        yield count


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32)))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """Where each document is: ``(doc_id, file, n, frame, at)``; only tails and indexes of the files are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                for x in _open(path, name).index.combine_chunks().to_batches(max_chunksize=100_000):
                    yield x.append_column("file", pa.array([name] * x.num_rows)).replace_schema_metadata(None)

    return _spread(manifest(spark, path).select("file")).mapInArrow(run, "doc_id long, n long, frame int, at int, file string")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Documents with an id in ``wanted(doc_id)``: ``(doc_id, ids)``; only their frames are read, each once."""
    places = directory(spark, path).join(wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    near = places.repartition("file", F.floor(F.col("frame") / 64)).sortWithinPartitions("file", "frame", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "frame", "at", "file")))
            for doc, n, frame, at, file in rows:
                if file != name:
                    name, source = file, _open(path, file)
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), _lists([source.span(n, frame, at).astype("<u4")])], names=["doc_id", "ids"])

    return near.mapInArrow(run, "doc_id long, ids array<int>")
