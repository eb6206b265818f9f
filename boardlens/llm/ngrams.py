"""Hashed character n-grams of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Code points hashed at once; texts of any length pass through in such pieces.
PIECE = 1 << 18
_STEP, _MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def buckets(text: str, orders: range, bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers below 2**bits of all n-grams with n in ``orders`` (from 1 up), piece by piece."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    down = np.uint32(32 - bits)
    for at in range(0, len(points), PIECE):
        c = points[at : at + PIECE + orders.stop - 2] * _MIX
        h = np.zeros(len(c), np.uint32)
        for n in range(1, orders.stop):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] + c[n - 1 :]) * _STEP
            h ^= h >> np.uint32(15)
            if n in orders:
                yield ((h[:PIECE] * _MIX) >> down).astype(np.int32)


class Counter:
    """Counts of the buckets of one text after another, over one array."""

    def __init__(self, orders: range, bits: int) -> None:
        self.orders, self.bits = orders, bits

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(buckets in order, their counts)."""
        total = np.zeros(1 << self.bits, np.int64)
        for part in buckets(text, self.orders, self.bits):
            total += np.bincount(part, minlength=len(total))
        at = np.flatnonzero(total)
        return at.astype(np.int32), total[at]


class Marker:
    """Which buckets a text has."""

    def __init__(self, orders: range, bits: int) -> None:
        self.orders, self.bits = orders, bits
        self.mark = np.zeros(1 << bits, bool)

    def __call__(self, text: str) -> np.ndarray:
        for part in buckets(text, self.orders, self.bits):
            self.mark[part] = True
        at = np.flatnonzero(self.mark)
        self.mark[at] = False
        return at.astype(np.int32)
