"""Words of texts as arrays: boundaries and 64-bit fingerprints, without a Python loop.

A word is a longest run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return, i.e. ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit bijection that spreads every input bit over the word."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _randoms(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BYTE = _randoms(256, 11)
_PLACE = _randoms(1 << 12, 23) | _U(1)


def split_words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) bytes of the words of ``raw[at[0]:at[-1]]``, relative to at[0],
    and for each document the number of its first word (one more at the end)."""
    b = raw[at[0]:at[-1]]
    word = ~SPACE[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[at - at[0]] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at - at[0])


def word_hashes(raw: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of words: a sum of random multiples of their bytes, mixed with their length."""
    b = raw[at[0]:at[-1]]
    if not len(starts):
        return np.zeros(0, _U)
    first = np.zeros(len(b), np.int64)
    first[starts[0]:] = np.repeat(starts, np.diff(np.append(starts, len(b))))
    place = np.arange(len(b), dtype=np.int64) - first
    term = _BYTE[b] * (_PLACE[place & 0xFFF] + ((place >> 12).astype(_U) * _U(0xD6E8FEB86659FD92)))
    term[SPACE[b]] = 0
    total = np.add.reduceat(term, starts)
    return mix(total + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[:1] = 1
    return np.multiply.accumulate(p)


class Ranges:
    """Fingerprints of runs of words in constant time each, from prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        self.prefix = np.zeros(n, _U)
        np.add.accumulate(words * _powers(_BASE, n)[:-1], out=self.prefix[1:])
        self.back = _powers(_INVERSE, n)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.prefix[hi] - self.prefix[lo]) * self.back[lo]
                   + (hi - lo).astype(_U) * _U(0xA0761D6478BD642F))
