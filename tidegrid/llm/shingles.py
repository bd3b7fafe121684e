"""Hashes of words and shingles for many texts at once, with numpy.

Words are runs of anything but blank and the control characters 9 to 13; A-Z count as a-z.
A hash of 64 bits stands for a word or shingle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
BASE = U(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(BASE), -1, 1 << 64))
    return (np.cumprod(np.concatenate([[U(1)], np.full(n, BASE)]), dtype=np.uint64),
            np.cumprod(np.concatenate([[U(1)], np.full(n, inverse)]), dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` (or more) of the base and of its inverse."""
    return _powers(max(1 << 20, 1 << (n - 1).bit_length()))


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """``P`` such that ``(P[b] - P[a]) * inverse**a`` is the hash of ``values[a:b]`` wherever it stands."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][:len(values)], out=out[1:])
    return out


def word_hashes(data: bytes, cased: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` begin, and their hashes; ``cased`` keeps capitals apart."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    begin, end = edges[::2], edges[1::2]
    p = prefix_hashes(_BYTE[raw if cased else _LOWER[raw]])
    h = (p[end] - p[begin]) * powers(len(raw))[1][begin]
    return begin, mix(h + (end - begin).astype(np.uint64) * GOLDEN)


def texts_word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in one array, and how many belong to each."""
    data = [t.encode() for t in texts]
    begin, h = word_hashes(b"\n".join(data))
    ends = np.cumsum([len(d) + 1 for d in data])
    return h, np.diff(np.searchsorted(begin, ends), prepend=0)


_ORDER = mix(np.arange(1, 65, dtype=np.uint64) * BASE) | U(1)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` neighbouring words, in one array of all texts' words."""
    n = max(0, len(h) - size + 1)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += h[j:j + n] * _ORDER[j]
    return mix(total)


def shingle_sets(texts: Sequence[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted within it, in one array, and how many each has.

    A text with fewer than ``size`` words has one shingle of all its words; one without words has none.
    """
    h, words = texts_word_hashes(texts)
    # words * order, summed over the shingle; a short text's sum ends with its last word
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    total = np.zeros(len(h), np.uint64)
    first = np.cumsum(words) - words
    left = np.repeat(first + words, words) - np.arange(len(h))  # words from here to the text's end
    for j in range(size):
        total += np.where(left > j, padded[j:j + len(h)] * _ORDER[j], U(0))
    keep = (left >= size) | ((np.repeat(words, words) < size) & (np.arange(len(h)) == np.repeat(first, words)))
    shingle = mix(total + np.minimum(left, size).astype(np.uint64) * GOLDEN)[keep]
    counts = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    sets, at = [], 0
    for n in counts:
        sets.append(np.unique(shingle[at:at + n]))
        at += n
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.fromiter(map(len, sets), np.int64, len(sets))
