"""Hashed five-word shingles of one text, for the operators that run inside Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word between blanks, tabs and line ends (bytes.split() splits at just those)."""
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` neighbouring values."""
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * _STEP + h[k:len(h) - size + 1 + k])
    return out


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of 1 to ``size``-1 words is one shingle, an empty one has none."""
    h = word_hashes(text)
    return np.unique(window_hashes(h, min(size, len(h)))) if len(h) else h
