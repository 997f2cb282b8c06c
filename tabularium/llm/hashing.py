"""Vectorised 64-bit hashes of byte windows, words and word shingles.

All arithmetic is modulo 2^64 in numpy, so the values are the same in every process.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser of a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def window_hashes(data: np.ndarray, doublings: int) -> np.ndarray:
    """A hash of every window of 2^doublings bytes, by joining the hashes of its halves."""
    h = mix(data.astype(np.uint64) + np.uint64(1))
    for level in range(doublings):
        half = 1 << level
        if len(h) <= half:
            return h[:0]
        h = h[:-half] * (_BASE + np.uint64(2 * level)) + h[half:]
        h ^= h >> np.uint64(29)
    return mix(h)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACES[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 256), _BASE)]))
    return _powers


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of every word; with lower, A-Z counts as a-z."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    values[_SPACES[data]] = 0
    offset = np.zeros(len(data), np.int64)
    offset[starts[0]:] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    values *= _power_table(int(offset.max()) + 1)[offset]
    return mix(np.add.reduceat(values, starts) + (ends - starts).astype(np.uint64))


def shingle_hashes(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words count whole, no word gives none."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    each = word_hashes(data)
    if not len(each):
        return each
    n = min(words, len(each))
    out = np.full(len(each) - n + 1, np.uint64(n))
    for i in range(n):
        out = mix(out * _BASE + each[i:len(each) - n + 1 + i])
    return np.unique(out)
