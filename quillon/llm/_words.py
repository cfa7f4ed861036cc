"""Vectorised tokenising of Arrow string columns.

Texts are never turned into Python strings: words are found and hashed on the
UTF-8 bytes that Arrow already holds, one slice of about 256 KB at a time:
each byte of a slice takes some hundred bytes of arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
SLICE_DOCS = 4000

#: ASCII white space: the bytes 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and the bytes of non-ASCII characters.
NOT_ALNUM = np.array([not (chr(b).isalnum() if b < 128 else True) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(LOWER.astype(np.uint64) + _U(0x51ED2701))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


class Words(NamedTuple):
    """Words of some documents: the words of document d are first[d] to first[d + 1]."""

    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    beginnings: list[np.ndarray]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    _, where, data = column.buffers()
    if n == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, size: int = SLICE_BYTES, docs: int = SLICE_DOCS) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes; a longer document stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), lo + docs, n)
        yield lo, hi
        lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, beginnings: tuple[int, ...] = ()) -> Words:
    """Words of the documents with these offsets, hashed with A-Z lower-cased.

    ``beginnings`` asks for hashes of each word's first so many bytes too.
    """
    base, docs = int(offsets[0]), len(offsets) - 1
    text, ends_at = data[base : int(offsets[-1])], offsets - base
    n = len(text)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(docs + 1, np.int64), np.zeros(0, np.uint64), none, none, [np.zeros(0, np.uint64)] * len(beginnings))
    inside = ~separators[text]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = ends_at[(ends_at > 0) & (ends_at < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUE[text] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    heads = [mix((total[np.minimum(starts + n, ends)] - total[starts]) * down[starts] + _U(n)) for n in beginnings]
    return Words(np.searchsorted(starts, ends_at), hashes, starts + base, ends + base, heads)


def inner_windows(data: np.ndarray, offsets: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its word) of each run of ``size`` bytes inside a word that does not begin it, A-Z lower-cased."""
    base = int(offsets[0])
    text = data[base : int(offsets[-1])]
    more = np.maximum(words.ends - words.starts - size, 0)
    at = np.repeat(np.arange(len(more)), more)
    if not len(at):
        return np.zeros(0, np.uint64), at
    begin = (words.starts - base)[at] + 1 + np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more)
    up, down = powers(len(text) + 1)
    total = np.empty(len(text) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE_VALUE[text] * up[: len(text)], out=total[1:])
    return mix((total[begin + size] - total[begin]) * down[begin] + _U(0x100 + size)), at


def word_hash(word: bytes) -> int:
    """The hash that find_words gives this word."""
    data = np.frombuffer(word, np.uint8)
    return int(find_words(data, np.array([0, len(data)]), np.zeros(256, bool)).hashes[0])


def by_document(values: np.ndarray, first: np.ndarray, ufunc: np.ufunc, empty) -> np.ndarray:
    """``ufunc`` reduced over each document's values; ``empty`` where it has none."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = ufunc.reduceat(values, first[:-1][full])
    return out
