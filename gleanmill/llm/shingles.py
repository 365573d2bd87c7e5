"""Sets of hashed word shingles of whole texts, vectorised over a slice of rows.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a
polynomial of its bytes modulo 2**64, taken for all words at once from running
sums; a shingle's hash mixes those of its words. A text with fewer than five
words is one shingle of all its words, tagged by their number; a text without
words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; made anew, for idle workers would keep them."""
    return np.cumprod(np.full(n, _BASE, np.uint64)), np.cumprod(np.full(n, _INVERSE, np.uint64))


def spans_hashed(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each of the neighbouring spans of a byte buffer."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) * down[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end) of a flat UTF-8 buffer."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[raw]
    word = ~_GAP[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    start[inner] = word[inner]
    end = word.copy()
    end[:-1] &= ~word[1:]
    end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashed = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashed, np.searchsorted(starts, offsets)


def sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, at = word_hashes(raw, offsets)
    factor = [np.uint64(pow(_INVERSE, j + 2, 1 << 64) | 1) for j in range(WORDS)]
    rolled = np.zeros(0, np.uint64)
    if len(words) >= WORDS:
        count = len(words) - WORDS + 1
        rolled = words[:count] * factor[0]
        for j in range(1, WORDS):
            rolled = rolled + words[j : j + count] * factor[j]
        rolled = mix(rolled)
    for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = last - first
        if n >= WORDS:
            yield np.unique(rolled[first : last - WORDS + 1])
        elif n:
            part = words[first:last]
            yield mix(np.array([sum(int(w) * int(f) for w, f in zip(part, factor, strict=False)) + n & (1 << 64) - 1], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
