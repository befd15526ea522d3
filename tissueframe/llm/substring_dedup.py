"""Removal of passages that occur earlier in the corpus, decided by suffix automata of reference shards.

A window of ``min_words`` consecutive words is redundant if the same words also start earlier: in a document with a
smaller id, or further up in the same document.  Every word under a redundant window is removed.

1. Each window has an anchor, its smallest (leftmost) k-word hash.  Equal windows have equal anchors at equal places,
   so windows can only match inside stretches (neighbouring windows with one anchor) of the same anchor.  Stretches
   whose anchor occurs once in the corpus end here.
2. Equal stretches of an anchor are one reference; all of them but the earliest are redundant.
3. The references of an anchor are dealt to one shard, which feeds them in order of the corpus to a suffix automaton.
   The matching statistic of a word, the longest match that ends there with anything read before, says whether the
   window that ends there is redundant.
4. An anchor with more than ``REFERENCES`` different stretches (a frequent phrase) is split by whole windows; the
   earliest of each is found by an aggregation, so no task holds the group.

The automata are not broadcast: what repeats in a corpus grows with it, so shards of bounded size get the stretches
that may match them instead.

Defined cases: null text is an empty text; shorter texts than a window lose nothing; a null id sorts first; rows that
repeat id and text are one place in the corpus and do not remove each other; rows that share an id but not the text
are ordered by a 64-bit hash of the text; bytes that are not UTF-8 are written as U+FFFD; a text longer than a pack is
a pack of its own; an empty table stays empty.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut
from .textops import Ranges, Words, free_names, packs, text_bytes

#: Different stretches of one anchor that one automaton takes; beyond it windows are compared one by one.
REFERENCES = 512
#: Most windows that share an anchor, so place and size of a stretch fit in the low bits of ``at``.
SPAN = 15
_NO_ID = -(1 << 63)


class SuffixAutomaton:
    """Online automaton of word sequences; ``feed`` gives each word's matching statistic against all read before."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, source: int, word, target: int) -> int:
        """A copy of ``target`` for the shorter strings that reach it from ``source``."""
        copy = self._state(self.length[source] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        return copy

    def feed(self, words: list) -> list[int]:
        """Append one sequence; for each position the longest suffix of what is read so far that was there before."""
        last, found = 0, []
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                if self.length[known] != self.length[last] + 1:
                    known = self._split(last, word, known)
                last = known
                found.append(self.length[last])
                continue
            state, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = state
                at = self.link[at]
            if at >= 0:
                known = self.next[at][word]
                if self.length[known] != self.length[at] + 1:
                    known = self._split(at, word, known)
                self.link[state] = known
            last = state
            found.append(self.length[self.link[state]])
        return found


def _anchor_size(min_words: int) -> int:
    return max(1, min_words - SPAN + 1)


def _stretches(texts: list[bytes], min_words: int):
    """For a pack: document, place of the anchor, anchor hash, stretch hash, first window, number of windows."""
    words, k = Words(texts), _anchor_size(min_words)
    width = min_words - k + 1
    if not len(words.count) or words.count.max() < min_words:
        return None
    ranges = Ranges(words.hashes(), "word")
    at = np.arange(len(words.doc) - k + 1)
    grams = ranges.hash(at, at + k)
    low, place, span = grams, at, 1
    while span < width:  # smallest gram of each window, leftmost of equal ones
        step = min(span, width - span)
        left = low[: len(low) - step] <= low[step:]
        place = np.where(left, place[: len(place) - step], place[step:])
        low = np.where(left, low[: len(low) - step], low[step:])
        span += step
    window = np.flatnonzero(words.doc[: len(place)] == words.doc[min_words - 1:][: len(place)])
    place, doc = place[window], words.doc[window]
    new = np.flatnonzero(np.diff(place, prepend=-1) | np.diff(doc, prepend=-1))
    start, n = window[new], np.diff(new, append=len(window))
    place, doc = place[new], doc[new]
    stretch = ranges.hash(start, start + n + min_words - 1) + (place - start).astype(np.uint64)
    first = words.first[doc]
    return doc, place - first, grams[place], stretch, start - first, n


def stretches(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc, tag, at, anchor, stretch)`` of every document; ``at`` sorts by place of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for a, b in packs(texts):
                if (found := _stretches(texts[a:b], min_words)) is None:
                    continue
                doc, place, anchor, stretch, start, n = found
                at = place << 12 | (place - start) << 6 | (n - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b][doc]), pa.array(tags[a:b][doc]), pa.array(at), pa.array(anchor.view(np.int64)),
                     pa.array(stretch.view(np.int64))], names=["doc", "tag", "at", "anchor", "stretch"])

    return docs.select(_doc(id_col), F.col(text_col).alias("t"), _tag(text_col)).mapInArrow(
        run, "doc long, tag long, at long, anchor long, stretch long")


def _doc(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc")


def _tag(text_col: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag")


def _windows(at) -> tuple:
    """First window and number of windows from ``at``; works on Columns and on ints."""
    if isinstance(at, Column):
        return F.shiftright(at, 12) - F.shiftright(at, 6).bitwiseAND(63), at.bitwiseAND(63) + 1
    return (at >> 12) - (at >> 6 & 63), (at & 63) + 1


def _spans(rows: DataFrame, start: Column, end: Column) -> DataFrame:
    return rows.select("doc", "tag", start.cast("long").alias("start"), end.cast("long").alias("end"))


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, tag, id, z)``: compressed texts, half the size in a shuffle."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), batch.column(2), pa.array(map(press.compress, texts), pa.binary())],
                names=["doc", "tag", "id", "z"])

    return docs.select(_doc(id_col), F.col(text_col).alias("t"), F.col(id_col).cast("long").alias("id"), _tag(text_col)).mapInArrow(
        run, "doc long, tag long, id long, z binary")


def _open(z: bytes | None) -> bytes:
    return zstandard.decompress(z) if z else b""


def _texts_of(docs: DataFrame, places: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """Add the words of each stretch ``(anchor, doc, tag, at)``; a document's list is no longer than its text."""
    lists = places.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("at", "anchor", "hot")).alias("places"))

    def run(batches):
        for batch in batches:
            rows = {"anchor": [], "doc": [], "tag": [], "at": [], "hot": [], "words": []}
            for doc, tag, z, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = _open(z).split()
                for x in {(x["at"], x["anchor"], x["hot"]) for x in places}:
                    start, n = _windows(x[0])
                    for key, value in zip(rows, (x[1], doc, tag, x[0], x[2], b" ".join(words[start: start + n + min_words - 1]))):
                        rows[key].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                {"anchor": pa.int64(), "doc": pa.int64(), "tag": pa.int64(), "at": pa.int64(), "hot": pa.bool_(), "words": pa.binary()}))

    return _packed(docs, id_col, text_col).drop("id").join(lists, ["doc", "tag"]).select("doc", "tag", "z", "places").mapInArrow(
        run, "anchor long, doc long, tag long, at long, hot boolean, words binary")


def _shards(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by anchor and place: one automaton for each anchor, built while it is read."""
    anchor, automaton, last = None, SuffixAutomaton(), None
    for batch in batches:
        rows = {"doc": [], "tag": [], "start": [], "end": []}
        for key, doc, tag, at, words in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, doc, tag, at) == last:
                continue  # a repeated row of the corpus
            last = key, doc, tag, at
            if key != anchor:
                anchor, automaton = key, SuffixAutomaton()
            start, n = _windows(at)
            open_at = None
            for i, match in enumerate([*automaton.feed(words.split())[min_words - 1:], 0]):
                if match >= min_words:
                    open_at = i if open_at is None else open_at
                elif open_at is not None:
                    for name, value in zip(rows, (doc, tag, start + open_at, start + i + min_words - 1)):
                        rows[name].append(value)
                    open_at = None
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema({k: pa.int64() for k in rows}))


def _other() -> Column:
    """A place other than the first one."""
    return (F.col("doc") != F.col("first.doc")) | (F.col("tag") != F.col("first.tag")) | (F.col("at") != F.col("first.at"))


def redundant_spans(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
                    references: int = REFERENCES) -> DataFrame:
    """``(doc, tag, start, end)``: word ranges under windows that occur earlier; ranges may overlap."""
    found = stretches(docs, min_words, id_col, text_col)
    again = cut(found.groupBy("anchor").count().where("count > 1").select("anchor"))  # apart, so that hot anchors can be split
    rows = cut(found.join(again, "anchor").select("doc", "tag", "at", "anchor", "stretch"))
    equal = cut(rows.groupBy("anchor", "stretch").agg(F.min(F.struct("doc", "tag", "at")).alias("first"), F.count("*").alias("n")))
    start, n = _windows(F.col("at"))
    copies = rows.join(equal.where("n > 1").select("anchor", "stretch", "first"), ["anchor", "stretch"]).where(
        _other())
    several = cut(equal.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1"))
    places = equal.join(several, "anchor").select("anchor", "first.doc", "first.tag", "first.at", (F.col("k") > references).alias("hot"))
    texts = cut(_texts_of(docs, places, min_words, id_col, text_col))
    dealt = texts.where("not hot").select("anchor", "doc", "tag", "at", "words").repartition("anchor").sortWithinPartitions(
        "anchor", "doc", "tag", "at")
    matched = dealt.mapInArrow(lambda batches: _shards(batches, min_words), "doc long, tag long, start long, end long")
    split = F.split(F.col("words").cast("string"), " ")
    windows = (texts.where("hot").withColumn("i", F.explode(F.sequence(F.lit(0), F.size(split) - min_words)))
               .select("doc", "tag", "at", "i", "anchor", F.sha2(F.array_join(F.slice(split, F.col("i") + 1, min_words), " "), 256).alias("w")))
    earliest = cut(windows.groupBy("anchor", "w").agg(F.min(F.struct("doc", "tag", "at")).alias("first")))  # apart, as above
    late = windows.join(earliest.hint("merge"), ["anchor", "w"]).where(_other())
    return (_spans(copies, start, start + n + (min_words - 1)).unionByName(matched)
            .unionByName(_spans(late, start + F.col("i"), start + F.col("i") + min_words)))


def _kept(words: list[bytes], spans: list[dict]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for x in spans:
        gone[x["start"]] += 1
        gone[x["end"]] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def dedup(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text",
          references: int = REFERENCES, digest: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` for each row of ``docs``; ``kept`` is the remaining words, or with
    ``digest`` the SHA-256 of them as ``kept_sha256``, so that the texts need not be returned."""
    spans = redundant_spans(docs, min_words, id_col, text_col, references)
    lists = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    last = "kept_sha256" if digest else "kept"

    def run(batches):
        for batch in batches:
            rows = {"doc_id": [], "n_words": [], "n_removed": [], last: []}
            for doc_id, z, gone in zip(*(c.to_pylist() for c in batch.columns)):
                words = _open(z).split()
                kept = _kept(words, gone) if gone else words
                text = b" ".join(kept)
                for name, value in zip(rows, (doc_id, len(words), len(words) - len(kept),
                                              hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), last: pa.string()}))

    return _packed(docs, id_col, text_col).join(lists, ["doc", "tag"], "left").select("id", "z", "spans").mapInArrow(
        run, f"doc_id long, n_words long, n_removed long, {last} string")


def clean(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with redundant words taken out of the texts, all columns kept.

    A text that loses nothing is unchanged, the words left of any other are joined by one space, and a row that loses
    all its words goes.
    """
    spans = redundant_spans(docs, min_words, id_col, text_col)
    doc, tag, gone_at = free_names(docs, "doc", "tag", "spans")
    lists = spans.groupBy(F.col("doc").alias(doc), F.col("tag").alias(tag)).agg(F.collect_set(F.struct("start", "end")).alias(gone_at))
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            texts, gone, keep = text_bytes(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist(), []
            out = batch.column(at).to_pylist()
            for i, (text, spans) in enumerate(zip(texts, gone)):
                if spans:
                    out[i] = b" ".join(_kept(text.split(), spans)).decode("utf-8", "replace")
                keep.append(not spans or bool(out[i]))
            columns = [*batch.columns[:at], pa.array(out, pa.string()), *batch.columns[at + 1: -1]]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    keyed = docs.withColumns({doc: F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)), tag: _tag(text_col)})
    return keyed.join(lists, [doc, tag], "left").select(*names, gone_at).mapInArrow(run, docs.schema)
