"""Rolling hashes of all stretches of a text whose length is a power of two, for seeds of literal patterns."""

from __future__ import annotations

import numpy as np

CLASSES = 6  # stretches of 1, 2, 4, 8, 16 and 32 characters
FILTER_BITS = 26  # places of the filter of wanted seeds: 8 MB whatever the number of patterns
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def codes(text: str) -> np.ndarray:
    """Code points, spread over 64 bits."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    return (c + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def rolled(text: str, classes: int = CLASSES):
    """(class, hashes of the stretches of ``2**class`` characters at every place).

    A stretch of twice the length is made of two neighbours, so each class costs one pass over the one before.
    """
    h, factor = codes(text), _BASE
    for k in range(classes):
        if k:
            half = 1 << (k - 1)
            if len(h) <= half:
                return
            h = h[:-half] * np.uint64(factor) + h[half:]
            factor = factor * factor & _MASK
        if len(h):
            yield k, final(h, k)


def final(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of different classes apart, all bits mixed."""
    x = h ^ np.uint64((k + 1) * 0x2545F4914F6CDD1D & _MASK)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def seed_class(length: int, classes: int = CLASSES) -> int:
    """The longest class that fits into a pattern."""
    return min(classes, length.bit_length()) - 1


def place(h: np.ndarray) -> np.ndarray:
    """Place of a hash in the filter."""
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def filter_of(words: list[tuple[int, bytes]]) -> np.ndarray:
    """The filter as one byte array, from (block, bitmap) rows of 32,768 places each."""
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for block, bits in words:
        out[block * 4096 : block * 4096 + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out


def wanted(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Indices of the hashes whose place is set."""
    at = place(h)
    return np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
