"""Word shingles as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

WORD_CACHE = 100_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)


class Shingler:
    """Sorted distinct shingles of texts given as UTF-8 bytes.

    Words are the runs without white space (space and 9 to 13), A-Z lower-cased. A text with fewer
    words than ``width`` is one shingle, a text without words has none. Word numbers are kept in a
    table that starts anew when full, so memory does not grow with the vocabulary.
    """

    def __init__(self, width: int = 5) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        known = self.known
        try:
            numbers = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            numbers = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out = out * _STEP + numbers[i : i + n]
            out ^= out >> _SHIFT
        out *= _MIX
        out ^= out >> _SHIFT
        return np.unique(out)
