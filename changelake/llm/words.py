"""Words of whole texts and their 64-bit hashes, for many rows at a time.

A word is a run of bytes other than the six ASCII white-space characters. Its hash
is a polynomial over the bytes, taken from prefix sums modulo 2^64 and mixed, so no
Python code runs per word. Two different words or n-grams share a hash with odds of
about one in 2^64 for each pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of text hashed at a time.
CHUNK = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: ASCII white space, and all ASCII characters but letters.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NO_LETTER = np.array([byte < 0x80 and not chr(byte).isalpha() for byte in range(256)])
#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    name = str(base)
    if name not in _powers or len(_powers[name]) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[name][:size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(data) + 1)[start])


@dataclass
class Words:
    """Words in text order: the row each is in, its bytes' span, and its hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    #: Number of each row's first word, and one number past the last row's words.
    first: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None = None, separators: np.ndarray = SPACE) -> Words:
    """Words of the rows `data[offsets[i]:offsets[i + 1]]`, their bytes mapped by `fold` before hashing."""
    inside = ~separators[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begin[edges] = inside[edges]
    before = edges[edges > 0] - 1
    finish[before] = inside[before]
    start, end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    value = span_hashes(data if fold is None else fold[data], start, end)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(row, start, end, value, np.searchsorted(row, np.arange(len(offsets))))


def ngrams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` consecutive words, by the number of its first word; rows are not told apart."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += hashes[place : place + count] * np.uint64(pow(_BASE, 2 * place + 1, 1 << 64))
    return mix(total)
