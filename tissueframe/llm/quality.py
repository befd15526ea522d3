"""Quality rules: counts of a text, and its divergence from language references.

A language's reference is the distribution of character classes and of its ``COMMON`` most frequent words (with the rest
as one bin) over all texts of the language.  A text is kept if it passes the counts and some language lies within both
Jensen-Shannon distances (base 2, 0 to 1); a distance is judged only above its minimum length, as short texts have
scattered histograms.

The largest word distance follows from the language's own reference.  A text without any of its common words has a
distance that depends on their share alone (about 0.19 at a third of all words) and must fail, so the limit is the share
``LOWEST`` of that distance.  In short texts of the language chance alone makes larger distances: there the limit is
``SPARE`` times what 99 of 100 samples of the reference of that length stay within, but at most the share ``HIGHEST``.
``MAX_WORD`` is the largest limit of all.

Counts of words are summed inside tasks first, so a language with a third of all words is one row for each word and
task; only the references, of bounded size for each language, come to the driver.

Defined cases: null text is an empty text; empty texts have counts 0 and fail; rows without a language are judged but are
no reference; without any reference nothing is judged by distance; repeated rows count as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut
from .textops import Ranges, Words, mix, packs, text_bytes

COMMON, MIN_WORDS, REPEATED = 100, 50, 50
#: Characters and words from which a distance is judged, and the largest distance that is kept.
CLASS_GUARD, WORD_GUARD, MAX_CLASS, MAX_WORD = 200, 100, 0.08, 0.25
#: Shares of the distance of a text without common words, and room above the samples of a length.
LOWEST, HIGHEST, SPARE = 0.8, 0.9, 1.15
#: Lengths and number of samples; a longer text has the limit of the last length.
_LENGTHS, _SAMPLES = np.array([100, 125, 160, 200, 250, 320, 400, 640, 1000]), 400
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_CLASSES = 8
#: Class of a byte: 0 lower case, 1 upper case, 2 digit, 3 white space, 4 punctuation, 5 symbol, 6 other letter, 7 none.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:192], _CLASS[192:] = 0, 1, 2, 7, 6
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4


def _repeats(words: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Words of each text under a window of ``size`` words that the text has twice or more."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(len(words.count), np.int64)
    at = np.arange(n)
    at = at[words.doc[:n] == words.doc[size - 1:]]
    key = mix(Ranges(hashes, "word").hash(at, at + size) + words.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    under = np.zeros(len(hashes) + 1, bool)
    for i in range(size):
        under[at[twice] + i] = True
    return np.bincount(words.doc[under[:-1]], minlength=len(words.count))


def _per_text(words: Words, flag: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(flag)])
    return np.diff(upto[words.offset])


def counts(texts: list[bytes], words: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a pack."""
    inside = (_CLASS[words.buf] != 3) & (_CLASS[words.buf] != 7)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return {"n_words": words.count, "word_chars": _per_text(words, inside), "n_symbols": _per_text(words, _SYMBOL[words.buf]),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64), "n_repeat_words": _repeats(words, hashes)}


def _classes(words: Words) -> np.ndarray:
    """Characters of each class in each text; the line feed after a text is not its own."""
    doc = np.repeat(np.arange(len(words.count)), np.diff(words.offset))
    table = np.bincount(doc * _CLASSES + _CLASS[words.buf], minlength=len(words.count) * _CLASSES).reshape(-1, _CLASSES)
    table[:, 3] -= 1
    return table[:, : _CLASSES - 1]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", common: int = COMMON) -> list[dict]:
    """For each language its class counts, common word hashes with counts, and number of words."""
    schema = pa.schema({"lang": pa.string(), "kind": pa.int8(), "key": pa.int64(), "n": pa.int64()})

    def emit(lang: str, kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), kind, np.int8)),
                                           pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), text_bytes(batch.column(1))
            for a, b in packs(texts):
                words = Words(texts[a:b])
                hashes, classes = words.hashes().view(np.int64), _classes(words)
                for lang in sorted(set(langs[a:b])):
                    own = langs[a:b] == lang
                    found, n = np.unique(hashes[own[words.doc]], return_counts=True)
                    yield emit(lang, 0, np.arange(_CLASSES - 1), classes[own].sum(axis=0))
                    yield emit(lang, 2, np.zeros(1), np.array([n.sum()]))
                    held.setdefault(lang, []).append((found, n))
                    size += len(found)
                if size > 1_500_000:
                    for lang, parts in held.items():
                        held[lang] = [_summed(*map(np.concatenate, zip(*parts)))]
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > 750_000:
                        yield from (emit(lang, 1, *x[0]) for lang, x in held.items())
                        held, size = {}, 0
        yield from (emit(lang, 1, *_summed(*map(np.concatenate, zip(*parts)))) for lang, parts in held.items())

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).mapInArrow(
        run, "lang string, kind byte, key long, n long")
    sums = cut(rows.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "key")
    words = sums.where("kind = 1").withColumn("r", F.row_number().over(top)).where(F.col("r") <= common).drop("r")
    out: dict[str, dict] = {}
    for r in sums.where("kind <> 1").unionByName(words).collect():  # at most `common` + 8 rows for each language
        ref = out.setdefault(r["lang"], {"classes": np.zeros(_CLASSES - 1), "words": {}, "n": 0})
        if r["kind"] == 0:
            ref["classes"][r["key"]] = r["n"]
        elif r["kind"] == 1:
            ref["words"][r["key"]] = r["n"]
        else:
            ref["n"] = r["n"]
    return [out[k] for k in sorted(out)]


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence, base 2, of each row of ``p`` from ``q``; rows of zeros are at distance 0."""
    total = p.sum(axis=1, keepdims=True)
    p, q = p / np.where(total > 0, total, 1), (q / max(q.sum(), 1))[None, :]
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.where(total[:, 0] > 0, np.clip((part(p) + part(q)) / 2, 0, 1), 0)


def word_limits(reference: np.ndarray) -> np.ndarray:
    """Largest word distance that is kept at each of ``_LENGTHS``; the last bin of ``reference`` is that of other words."""
    used = np.append(reference[:-1][reference[:-1] > 0], reference[-1])
    if not used.sum():
        return np.full(len(_LENGTHS), MAX_WORD)
    without = divergence(np.eye(len(used))[-1:], used)[0]
    rng = np.random.default_rng(len(used))
    chance = [np.quantile(divergence(rng.multinomial(n, used / used.sum(), _SAMPLES).astype(float), used), 0.99) for n in _LENGTHS]
    return np.minimum(MAX_WORD, np.clip(SPARE * np.array(chance), LOWEST * without, HIGHEST * without))


def judge(docs: DataFrame, refs: list[dict], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, the distances to the nearest language, and the verdict for each row of ``docs``."""
    vocabulary = np.array(sorted({w for r in refs for w in r["words"]}), np.int64)
    bins = []
    for r in refs:
        known = np.array([r["words"].get(w, 0) for w in vocabulary.tolist()], float)
        own = np.append(known, max(0.0, r["n"] - known.sum()))
        bins.append((r["classes"], own, word_limits(own)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance",
             "word_distance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in packs(texts):
                words = Words(texts[a:b])
                hashes = words.hashes()
                base = counts(texts[a:b], words, hashes)
                n = base["n_words"]
                failed = (n < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEATED * n)
                own = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(vocabulary, own), max(0, len(vocabulary) - 1))
                slot = np.where(vocabulary[at] == own, at, len(vocabulary)) if len(vocabulary) else np.zeros(len(own), int)
                width = len(vocabulary) + 1
                table = np.bincount(words.doc * width + slot, minlength=len(n) * width).reshape(len(n), width)
                classes = _classes(words)
                judged_class, judged_word = base["word_chars"] >= CLASS_GUARD, n >= WORD_GUARD
                best = np.full((3, len(n)), np.inf) if bins else np.zeros((3, len(n)))
                for ref_classes, ref_words, limits in bins:
                    c = np.where(judged_class, divergence(classes, ref_classes), 0)
                    w = np.where(judged_word, divergence(table, ref_words), 0)
                    worst = np.maximum(c / MAX_CLASS, w / np.interp(n, _LENGTHS, limits))
                    nearer = worst < best[0]
                    best = np.where(nearer, np.stack([worst, c, w]), best)
                kept = ~failed & (best[0] <= 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(base[k].astype(np.int64)) for k in names[1:6]),
                     pa.array(failed), pa.array(kept), pa.array(np.round(best[1], 6)), pa.array(np.round(best[2], 6))], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, class_distance double, word_distance double")


def quality(docs: DataFrame) -> DataFrame:
    """References from all of ``docs``, then the verdict on each row."""
    return judge(docs, references(docs))
