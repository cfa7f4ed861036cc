"""Sets of word shingles as sorted 52-bit values, a slice of documents at a time."""

from __future__ import annotations

import numpy as np

from quillon.llm._words import Words, mix

_U = np.uint64
BITS = _U(52)
_MASK = (_U(1) << BITS) - _U(1)


def multipliers(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``k`` words, and the index of its first word.

    Windows never cross documents; documents with fewer words have none.
    """
    h, n = words.hashes, len(words.hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = multipliers(k)
    total = h[: n - k + 1] * m[0]
    for j in range(1, k):
        total += h[j : n - k + 1 + j] * m[j]
    document = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = np.flatnonzero(document[: n - k + 1] == document[k - 1 :])
    return mix(total[inside]), inside


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``k`` words, and its document; a document of one to k - 1 words has its whole sequence instead."""
    counts = np.diff(words.first)
    hashes, at = window_hashes(words, k)
    owner = np.searchsorted(words.first, at, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        m = multipliers(k)
        whole = np.array([int((words.hashes[words.first[d] : words.first[d + 1]] * m[: counts[d]]).sum() + _U(counts[d])) for d in short], np.uint64)
        hashes, owner = np.concatenate([hashes, mix(whole)]), np.concatenate([owner, short])
    return hashes, owner


def shingle_sets(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(first, values): each document's distinct shingles, sorted, in values[first[d]:first[d + 1]].

    A document of one to k - 1 words has one shingle, its whole sequence; one
    without words has none. At most 4,096 documents at a time.
    """
    hashes, owner = windows(words, k)
    keys = (owner.astype(np.uint64) << BITS) | (hashes >> _U(12))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    first = np.searchsorted(keys, np.arange(len(words.first), dtype=np.uint64) << BITS)
    return first, keys & _MASK
