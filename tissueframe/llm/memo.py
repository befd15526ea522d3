"""Token ids of texts whose words are encoded apart, each different word once.

A tokenizer that never joins characters across a border between words gives a text the ids of its words, one after
the other.  ``WordMemo`` keeps the ids of the words it has met, so a worker encodes each different word once and a text
costs one look-up a word.  What a border is, and which words stand only for whole texts, is up to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

#: Different words that a worker remembers before it starts anew.
REMEMBERED = 600_000


def split_by_bytes(ids: np.ndarray, id_bytes: np.ndarray, sizes: list[int]) -> list[bytes]:
    """``ids`` of words side by side as one byte string for each word, given the bytes of ids and of words."""
    ends = np.searchsorted(np.cumsum(id_bytes[ids]), np.cumsum(np.array(sizes, np.int64))) + 1
    raw, width = ids.tobytes(), ids.itemsize
    return [raw[a * width: b * width] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class WordMemo:
    """Ids of texts as little-endian bytes of ``dtype``.

    ``split`` cuts a text into words, ``learn`` gives the ids of new words, None for a word that cannot be encoded
    apart, and ``whole`` gives those of a text that holds such a word.
    """

    def __init__(self, split: Callable[[bytes], list[bytes]], learn: Callable[[list[bytes]], list[bytes | None]],
                 whole: Callable[[bytes], bytes], remembered: int = REMEMBERED):
        self._split, self._learn, self._whole, self._limit = split, learn, whole, remembered
        self._known: dict[bytes, bytes | None] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        words = [self._split(t) for t in texts]
        flat = list(chain.from_iterable(words))
        found = list(map(self._known.get, flat))
        missing = [i for i, x in enumerate(found) if x is None]  # new, or without ids of their own
        new = {flat[i] for i in missing}.difference(self._known)
        if len(self._known) + len(new) > self._limit:
            self._known = {}
            new = {flat[i] for i in missing}
        fresh = list(new)
        for i in range(0, len(fresh), 20_000):
            self._known.update(zip(fresh[i: i + 20_000], self._learn(fresh[i: i + 20_000])))
        for i in missing:
            found[i] = self._known[flat[i]]
        out, at = [], 0
        for text, own in zip(texts, words):
            try:
                out.append(b"".join(found[at: at + len(own)]))
            except TypeError:  # a word without ids of its own
                out.append(self._whole(text))
            at += len(own)
        return out
