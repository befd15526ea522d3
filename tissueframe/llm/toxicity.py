"""Toxicity classifier with counterfactual regularisation.

A logistic model on the words a text contains.  Beside the usual loss it pays for every change of score that swapping
identity terms makes: each training text that names a group is copied with the group's name replaced by another of the
same list, and the squared difference of the two scores, over all such copies, is added with weight ``FAIRNESS``.  So
words that merely name a group get nearly equal weights, and a neutral mention does not raise a score.

Training uses at most ``TRAINING_ROWS`` labelled rows, those with the smallest hash of their id; words count as
features from ``MIN_TEXTS`` texts on.  Features are 64-bit hashes of whole words (runs of letters, lower case), never
buckets shared with other words.  Every text is scored whole.

Defined cases: null text is an empty text and gets the score of the intercept; labels that are null, or belong to no
document, are left out; of repeated labels of a document the larger counts; without labels of both kinds the score is
the share of toxic rows (0.5 without any); repeated rows are scored as often as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .textops import Words, packs, text_bytes

TRAINING_ROWS, MIN_TEXTS, ROUNDS = 24_000, 4, 250
RIDGE, LASSO, FAIRNESS, THRESHOLD = 1e-5, 2e-4, 5.0, 0.7
#: Weight of a toxic row, as few rows are toxic.
TOXIC = 4.0
#: Names of groups by kind; the default of a parameter.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "atheist"), ("black", "white", "asian", "hispanic"),
    ("gay", "lesbian", "straight", "transgender"), ("immigrants", "refugees", "locals"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 64-bit hash of every word of a pack of lower-cased texts."""
    words = Words(texts, letters=True)
    return words.doc, words.hashes()


def _lower(texts: list[bytes]) -> list[bytes]:
    return [t.decode().lower().encode() for t in texts]


def swaps(identities=IDENTITIES) -> dict[int, int]:
    """Hash of each identity term to the hash of the next term of its list."""
    out = {}
    for terms in identities:
        _, hashes = word_hashes(_lower([" ".join(terms).encode()]))
        for a, b in zip(hashes.tolist(), np.roll(hashes, -1).tolist()):
            out[a] = b
    return out


def features(docs: DataFrame, label_col: str = "toxic", text_col: str = "text") -> DataFrame:
    """``(y, words)``: the different word hashes of each row, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = _lower(text_bytes(batch.column(1))), []
            for a, b in packs(texts):
                doc, hashes = word_hashes(texts[a:b])
                found += [np.unique(x).view(np.int64) for x in np.split(hashes, np.searchsorted(doc, np.arange(1, b - a)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["y", "words"])

    return docs.select(F.col(label_col).cast("int").alias("y"), F.col(text_col).alias("t")).mapInArrow(run, "y int, words array<long>")


class Model:
    """Weights of known words (sorted hashes) and an intercept."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, intercept: float):
        self.hashes, self.weights, self.intercept = hashes, weights, intercept

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Score of each UTF-8 text."""
        texts, out = _lower(texts), []
        for a, b in packs(texts):
            doc, hashes = word_hashes(texts[a:b])
            total = np.zeros(b - a)
            if len(self.hashes):
                at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == hashes)
                once = np.unique(doc[hit] * len(self.hashes) + at[hit])
                total = np.bincount(once // len(self.hashes), self.weights[once % len(self.hashes)], minlength=b - a)
            out.append(1 / (1 + np.exp(-np.clip(total + self.intercept, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def _swapped(words: np.ndarray, row: np.ndarray, col: np.ndarray, change: dict[int, int]):
    """Differences that swapping makes to the features: ``(copy, word, +1 or -1)``, one copy for each text with a term."""
    place = {h: i for i, h in enumerate(words.tolist())}
    terms = {place[a]: place.get(b) for a, b in change.items() if a in place}
    hit = np.flatnonzero(np.isin(col, list(terms)))
    have = set(zip(row[hit].tolist(), col[hit].tolist()))
    copies, r, c, s = {}, [], [], []
    for t, w in sorted(have):
        copy, other = copies.setdefault(t, len(copies)), terms[w]
        r.append(copy)
        c.append(w)
        s.append(-1.0)
        if other is not None:
            r.append(copy)
            c.append(other)
            s.append(1.0)
    return len(copies), np.array(r, np.int64), np.array(c, np.int64), np.array(s)


def fit(y: np.ndarray, row: np.ndarray, hashes: np.ndarray, change: dict[int, int] | None = None, fairness: float = FAIRNESS,
        min_texts: int = MIN_TEXTS) -> Model:
    """Accelerated proximal gradient on sparse rows; ``row`` and ``hashes`` are the words of each text."""
    words, col, n = np.unique(hashes, return_inverse=True, return_counts=True)
    change = swaps() if change is None else change
    keep = (n >= min_texts) | np.isin(words, np.array([*change, *change.values()], np.uint64))
    words, new = words[keep], np.cumsum(keep) - 1
    use = keep[col]
    row, col = row[use], new[col[use]]
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0) or not len(words):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(words[:0], np.zeros(0), float(np.log(share / (1 - share))))
    copies, cr, cc, cs = _swapped(words, row, col, change)
    m, texts = len(words), len(y)
    weight = np.where(y == 1, TOXIC, 1.0)
    order = np.bincount(col, weight[row], minlength=m) / texts
    step = 1 / (0.25 * order + RIDGE + 1e-3 + (2 * fairness * np.bincount(cc, cs * cs, minlength=m) / max(copies, 1)))
    step /= max(1.0, np.sqrt(np.bincount(row, minlength=texts).mean()) / 4)
    w, b = np.zeros(m), float(np.log(share / (1 - share)))
    past, t = w.copy(), 1.0
    for _ in range(ROUNDS):
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        look = w + (old - 1) / t * (w - past)
        z = np.bincount(row, look[col], minlength=texts) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.bincount(col, error[row], minlength=m) / texts + RIDGE * look
        if copies:
            delta = np.bincount(cr, look[cc] * cs, minlength=copies)
            grad += 2 * fairness * np.bincount(cc, delta[cr] * cs, minlength=m) / copies
        move = look - step * grad
        past, w = w, np.sign(move) * np.maximum(np.abs(move) - step * LASSO, 0)
        b -= float(error.mean()) / (0.25 * float(weight.mean()) + 0.25)
        if float((w - past) @ (look - w)) < 0:
            t = 1.0
    used = w != 0
    return Model(words[used], w[used], b)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, id_col: str = "doc_id", label_col: str = "toxic",
          text_col: str = "text", identities=IDENTITIES, fairness: float = FAIRNESS) -> Model:
    """Model from at most ``rows`` labelled rows, the same ones in every run; ``identities`` are lists of terms (single
    words) that are swapped for each other."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(label_col).cast("int").alias("__y"))
    some = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("t")).join(F.broadcast(some), "__id").select("__y", "t")
    # a bounded sample, so it may come to the driver
    table = features(sample, "__y", "t").toArrow()
    words = table["words"].combine_chunks()
    size = np.diff(words.offsets.to_numpy()) if table.num_rows else np.zeros(0, np.int64)
    return fit(table["y"].to_numpy().astype(float), np.repeat(np.arange(table.num_rows), size),
               words.flatten().to_numpy().view(np.uint64) if table.num_rows else np.zeros(0, np.uint64), swaps(identities), fairness)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.round(model.scores(text_bytes(batch.column(1))), 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, "doc_id long, score double, predicted int")


def is_held_out(id_col: str = "doc_id", fold: int = 1, folds: int = 3) -> Column:
    """Fold of a document by the CRC-32 of its id as text (null id: empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def classify(docs: DataFrame, labels: DataFrame, identities=IDENTITIES, fairness: float = FAIRNESS) -> DataFrame:
    """Learn from labels that are not held out, score all: ``(doc_id, held_out, score, predicted)``."""
    model = train(docs, labels.where(~is_held_out()), identities=identities, fairness=fairness)
    return score(docs, model).select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
