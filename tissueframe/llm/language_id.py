"""Language identification with hyperdimensional profiles.

Each letter has a random vector of ``DIMENSIONS`` entries, +1 or -1.  A trigram binds (multiplies) the vectors of its
letters, permuted (rotated) by their place; a text bundles (adds) its trigrams; a language's prototype is the bundle of
its training texts.  A text goes to the prototype with the largest cosine.

Learning sums trigram counts by language inside each task and ships one vector for each language and task; prototypes
are sums of integers, so the result does not depend on how rows are dealt.  Labels, ids and sources are not inputs of a
prediction.

Defined cases: null text, or text without a letter, gives ``und`` and score 0; rows without a language, and rows held
out, are not learned from; without any training row every text is ``und``; ties go to the first language by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .textops import PACK

DIMENSIONS, CODES, SEED = 512, 48, 7
UNKNOWN = "und"


@cache
def _codes() -> np.ndarray:
    """Letter code of each code point: 0 no letter, 1 to 26 a to z, others spread over the remaining codes."""
    out = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            out[point] = 27 + point % (CODES - 27)
    out[97:123] = np.arange(1, 27)
    return out


@cache
def _trigram_vectors() -> np.ndarray:
    """Bound vector of each trigram, as int8."""
    letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (CODES, DIMENSIONS))
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    pairs = (first[:, None, :] * second[None, :, :]).reshape(-1, DIMENSIONS)
    return (pairs[:, None, :] * letters[None, :, :]).reshape(-1, DIMENSIONS)


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document and trigram number of every trigram; other characters are one boundary between words."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lower) + "\n").encode("utf-32-le"), np.uint32)
    codes = _codes()[points]
    doc = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in lower)]) - 1
    keep = np.flatnonzero((codes[1:] != 0) | (codes[:-1] != 0)) + 1
    codes, doc = np.concatenate([[0], codes[keep]]).astype(np.int64), np.concatenate([[0], doc[keep]])
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    within = np.flatnonzero((b != 0) | ((a != 0) & (c != 0) & (doc[:-2] == doc[2:])))
    return doc[1:-1][within], (a * CODES * CODES + b * CODES + c)[within]


def _packs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    pack, size, start = [], 0, 0
    for i, text in enumerate(texts):
        pack.append(text or "")
        size += len(pack[-1])
        if size >= PACK:
            yield start, pack
            pack, size, start = [], 0, i + 1
    if pack:
        yield start, pack


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages by code point and their prototypes; one vector per language comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, pack in _packs(texts):
                own = langs[start: start + len(pack)]
                names = sorted(set(own))
                doc, gram = _trigrams(pack)
                lang = np.array([names.index(x) for x in own])[doc]
                sums = np.bincount(lang * CODES ** 3 + gram, minlength=len(names) * CODES ** 3).reshape(len(names), -1)
                for name, row in zip(names, sums):
                    counts[name] = counts.get(name, 0) + row
        vectors = []
        for row in counts.values():
            used = np.flatnonzero(row)
            total = np.zeros(DIMENSIONS, np.int64)
            for part in np.array_split(used, len(used) // 4096 + 1):
                total += row[part] @ _trigram_vectors()[part].astype(np.int64)
            vectors.append(total)
        yield pa.RecordBatch.from_pydict({"lang": list(counts), "v": vectors},
                                         schema=pa.schema({"lang": pa.string(), "v": pa.list_(pa.int64())}))

    parts = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t")).mapInArrow(
        run, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("s"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("v")).collect()
    rows = sorted((r["lang"], [x["s"] for x in r["v"]]) for r in rows)
    return [name for name, _ in rows], np.array([v for _, v in rows], float).reshape(-1, DIMENSIONS)


class Predictor:
    """Nearest prototype by cosine, for many texts."""

    def __init__(self, languages: list[str], prototypes: np.ndarray):
        norm = np.linalg.norm(prototypes, axis=1, keepdims=True)
        self._names, self._unit = languages, (prototypes / np.where(norm > 0, norm, 1)).astype(np.float32)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, pack in _packs(texts):
            doc, gram = _trigrams(pack)
            keys = np.sort(doc * CODES ** 3 + gram)
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            count, keys = np.diff(new, append=len(keys)).astype(np.float32), keys[new]
            gram, bound = keys % CODES ** 3, np.searchsorted(keys // CODES ** 3, np.arange(len(pack) + 1))
            for a, b in zip(bound[:-1], bound[1:]):
                if a == b or not self._names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                text = np.zeros(DIMENSIONS, np.float32)
                for i in range(a, b, 8192):
                    j = min(b, i + 8192)
                    text += count[i:j] @ _trigram_vectors()[gram[i:j]].astype(np.float32)
                cosine = np.round(self._unit @ text / max(float(np.linalg.norm(text)), 1e-9), 6)
                best = int(cosine.argmax())
                names.append(self._names[best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
        return names, scores


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)``; score is the cosine with the chosen prototype, not below 0."""
    predictor = Predictor(languages, prototypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predictor(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def known_only(docs: DataFrame, languages: list[str], prototypes: np.ndarray, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose language is found, with the language filled in where it is missing; no shuffle."""
    predictor, at, lang = Predictor(languages, prototypes), docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.array(predictor(batch.column(at).to_pylist())[0], pa.string())
            columns = list(batch.columns)
            columns[lang] = pc.coalesce(columns[lang].cast(pa.string()), names)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pc.not_equal(names, UNKNOWN))

    return docs.mapInArrow(run, docs.schema)


def is_held_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Fold of a document by the CRC-32 of its id as text (null id: empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict all: ``(doc_id, held_out, lang_pred, score)``."""
    languages, prototypes = learn(docs.where(~is_held_out()))
    return predict(docs, languages, prototypes).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
