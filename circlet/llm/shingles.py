"""Word shingles as sorted 64-bit hashes, and circulant MinHash signatures of them."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import xxhash

WIDTH = 5
PLACES = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of the text, A-Z lower-cased, words apart at blanks (space, 9 to 13).

    Fewer than five words make one shingle, no words none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # for bytes: A-Z only, and just these blanks
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(h) - WIDTH + 1
    if n < 1:
        return mix(np.array([np.sum(h * _ODD[: len(h)], dtype=np.uint64) + np.uint64(len(h))], dtype=np.uint64))
    total = h[:n] * _ODD[0]
    for i in range(1, WIDTH):
        total += h[i : i + n] * _ODD[i]
    return np.unique(mix(total + np.uint64(WIDTH)))


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set."""
    a, b = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), dtype="<i8")
    return int(a), int(b)


@lru_cache(maxsize=2)
def circle(size: int, seed: int = 5) -> np.ndarray:
    """The second permutation, continued past its end by ``size`` places, as windows: row s holds pi(s), pi(s + 1), ..."""
    pi = np.random.default_rng(seed).permutation(PLACES).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: size - 1]]), size)


def circulant_signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash coordinates from two permutations.

    The first permutation scatters the shingles over the circle; the second, shifted by k places, gives coordinate k.
    All coordinates of a shingle so lie side by side, and the signature is a minimum over windows.
    """
    place = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(44)).astype(np.int64)
    windows = circle(size)
    out = np.full(size, PLACES, dtype=np.uint32)
    for low in range(0, len(place), 2048):
        np.minimum(out, windows[place[low : low + 2048]].min(axis=0), out=out)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; the band's number is part of it."""
    bands = signature.reshape(-1, rows).astype(np.uint64)
    keys = mix(np.arange(1, len(bands) + 1, dtype=np.uint64))
    for j in range(rows):
        keys = mix(keys ^ (bands[:, j] + np.uint64(j << 32)))
    return keys.view(np.int64)
