"""Words and word hashes as the operators on shingles use them (inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word: ASCII letters lowered, split at space and 0x09 to 0x0D."""
    words = data.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_ODD[0])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_ODD[1])
    return h ^ (h >> np.uint64(32))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order; order within a run matters."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    h = np.full(count, n, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(_ODD[2]) + words[i : i + count])
    return h


def shingle_set(data: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; a shorter text is one shingle."""
    words = word_hashes(data or b"")
    if not len(words):
        return words
    return np.unique(ngram_hashes(words, min(n, len(words))))
