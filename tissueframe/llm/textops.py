"""Helpers for work on whole batches of texts as byte arrays inside Arrow tasks.

Texts are handled in packs of whole documents of about ``PACK`` bytes, so the memory of a task does not follow the
Arrow batch; a longer document is a pack of its own.  Hashes are 64-bit polynomials with a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PACK = 500_000
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}

#: Separators between words: space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Letters as bytes: a to z and every byte of a character beyond ASCII.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = True
IS_LETTER[128:] = True


def small_batches(spark, rows: int = 1000) -> None:
    """Ask Spark for small Arrow batches: documents are long, and batches are held by the JVM and the worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def packs(texts: list[bytes], size: int = PACK) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of about ``size`` bytes."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, i
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        base = _BASES[kind]
        m = 1 << max(18, (n - 1).bit_length())
        pair = tuple(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, b, np.uint64)]).cumprod(dtype=np.uint64)
                     for b in (base, pow(base, -1, 1 << 64)))
        if m > 1 << 21:
            return pair  # one very long text: not kept
        _POWERS[kind] = have = pair
    return have


def byte_values(view: np.ndarray) -> np.ndarray:
    """A fixed random number for each byte."""
    return _BYTE[view]


class Ranges:
    """Hashes of ranges of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, kind: str):
        up, self._down = _powers(kind, len(values) + 1)
        self._sum = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sum[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a pack: ``start``, ``end`` in ``buf``, their document ``doc`` and ``first`` word of each document."""

    def __init__(self, texts: list[bytes], letters: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)])
        inside = IS_LETTER[self.buf] if letters else ~IS_SPACE[self.buf]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        return Ranges(byte_values(self.buf), "byte").hash(self.start, self.end)


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if t is None else t for t in column.cast("binary").to_pylist()]


def free_names(df, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"__{name}"
        while name in taken:
            name += "_"
        out.append(name)
    return out
