"""Word hashes, shingle sets and MinHash signatures of text batches (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: splitmix64 finalizer
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_set(data: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of a text:
    A-Z lower-cased, words split at ASCII white space; a shorter text is one
    shingle, a text without words none."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = len(words)
    take = min(width, n)
    total = np.zeros(n - take + 1, np.uint64)
    for j in range(take):
        total = total * BASE + h[j:n - take + 1 + j]
    return np.unique(mix(total + np.uint64(take)))


def signature(shingles: np.ndarray, multipliers: np.ndarray, added: np.ndarray) -> np.ndarray:
    """One minimum per coordinate (32 bits each) of a non-empty set."""
    best = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096]
        best = np.minimum(best, (part[:, None] * multipliers + added).min(0))
    return (best >> np.uint64(32)).astype(np.uint32)


def coordinates(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, k, np.uint64)
