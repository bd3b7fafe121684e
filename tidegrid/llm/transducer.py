"""One pass of a table-driven transducer over the bytes of many texts.

A table gives each byte its class, a second one the state that a class leads to, and a third what is put out for
a state and a class: the beginning of a word, a code point, a capital, a symbol. All texts of a
group run through the tables at once. Words go into a hash table by the hash of their span; words that meet in a
place are compared byte by byte, so two words never count as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

SPACE, OTHER, CAPITAL, SYMBOL, CONTINUES = range(5)
OUT, IN = range(2)
#: What the transducer puts out, as bits.
BEGINS, POINT, UPPER, SIGN = 1, 2, 4, 8

CLASS = np.full(256, OTHER, np.uint8)
CLASS[[0x20, *range(0x09, 0x0E)]] = SPACE
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(b"#$%&*|")] = SYMBOL
CLASS[0x80:0xC0] = CONTINUES
#: The state behind a byte of each class.
NEXT = np.array([OUT, IN, IN, IN, IN], np.uint8)
#: Put out for each state before a byte and class of the byte.
PUT = np.array([[POINT, POINT | BEGINS, POINT | UPPER | BEGINS, POINT | SIGN | BEGINS, BEGINS],
                [POINT, POINT, POINT | UPPER, POINT | SIGN, 0]], np.uint8)

GROUP = 1 << 18
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BASE, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
INVERSE = pow(BASE, -1, 1 << 64)
FIELDS = ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")

_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2 to the 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever its bytes stand."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    mixed = (sums[end] - sums[begin]) * inverse[begin]
    return (mixed ^ (mixed >> np.uint64(29))) * MIX


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of ``length`` bytes at ``a`` and at ``b`` are equal, each pair byte by byte."""
    first = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(first, length)
    differ = data[np.repeat(a, length) + inside] != data[np.repeat(b, length) + inside]
    return np.add.reduceat(differ, first) == 0 if len(length) else np.zeros(0, bool)


def first_of_kind(data: np.ndarray, begin: np.ndarray, end: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Insert all words into one open-addressing table, those of a row as its own.

    Gives back for each word whether it holds a place, and the rows in which two different words had one
    hash, whose words must be counted another way.
    """
    n = len(begin)
    keys = (span_hashes(data, begin, end) ^ (row.astype(np.uint64) * np.uint64(BASE))) * MIX
    bits = max(4, (2 * n).bit_length())
    table = np.full(1 << bits, -1, np.int32)
    place = (keys >> np.uint64(64 - bits)).astype(np.int64)
    holder = np.empty(n, np.int32)
    left = np.arange(n, dtype=np.int32)
    while len(left):
        at = place[left]
        free = table[at] < 0
        table[at[free]] = left[free]  # where several want one place, one of them gets it
        there = table[at]
        found = keys[there] == keys[left]
        holder[left[found]] = there[found]
        left = left[~found]
        place[left] = (place[left] + 1) & ((1 << bits) - 1)
    own = holder == np.arange(n)
    word = np.flatnonzero(~own)
    other, length = holder[word], (end - begin)[word]
    alike = (row[word] == row[other]) & (length == (end - begin)[other])
    wrong = row[word[~alike]]
    word, other, length = word[alike], other[alike], length[alike]
    unequal = ~same_bytes(data, begin[word], begin[other], length)
    return own, np.unique(np.concatenate([wrong, row[word[unequal]]]))


def run_group(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the texts in ``data`` that begin at ``at``: an array of ``FIELDS``; and where each word begins and
    ends and whether it is the first of its kind in its text."""
    n = len(at) - 1
    classes = CLASS[data]
    state = np.empty(len(data), np.uint8)
    state[1:] = NEXT[classes[:-1]]
    state[at[:-1][at[:-1] < len(data)]] = OUT
    out = PUT[state, classes]
    begin = np.flatnonzero(out & BEGINS)
    row = np.searchsorted(at, begin, "right") - 1
    # a word ends at the next space, or where the next text begins
    space = np.flatnonzero(classes == SPACE)
    next_space = np.append(space, len(data))[np.searchsorted(space, begin)]
    end = np.minimum(next_space, at[row + 1])
    own, doubtful = first_of_kind(data, begin, end, row)
    counts = np.zeros((n, len(FIELDS)), np.int64)
    counts[:, 0] = np.bincount(row, minlength=n)
    counts[:, 1] = np.bincount(row[own], minlength=n)
    for field, mark in ((2, POINT), (3, UPPER), (4, SIGN)):
        sums = np.concatenate([[0], np.cumsum((out & mark) != 0)])
        counts[:, field] = sums[at[1:]] - sums[at[:-1]]
    for r in doubtful.tolist():
        counts[r, 1] = len(set(WORD.findall(data[at[r]:at[r + 1]].tobytes())))
        own[row == r] = True
    return counts, begin, end, own


def groups(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes together; a longer one is alone."""
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, last
        first = last


def parts_of(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in parts of about ``limit`` bytes, cut behind white space; a longer word stays whole."""
    first = 0
    for block in range(0, len(data), limit):
        spaces = np.flatnonzero(CLASS[data[block:block + limit]] == SPACE)
        if len(spaces) and block + spaces[-1] + 1 < len(data):
            yield data[first:block + spaces[-1] + 1]
            first = block + int(spaces[-1]) + 1
    yield data[first:]


def text_counts(data: np.ndarray, at: np.ndarray, limit: int = GROUP) -> np.ndarray:
    """``FIELDS`` of every text; ``limit`` bytes are in work at a time."""
    counts = np.zeros((len(at) - 1, len(FIELDS)), np.int64)
    for a, b in groups(at, limit):
        own = data[at[a]:at[b]]
        if len(own) <= 2 * limit:
            counts[a:b] = run_group(own, at[a:b + 1] - at[a])[0]
            continue
        kinds: set[bytes] = set()
        for part in parts_of(own, limit):
            found, begin, end, new = run_group(part, np.array([0, len(part)]))
            counts[a] += found[0]
            text = part.tobytes()
            kinds.update(text[x:y] for x, y in zip(begin[new].tolist(), end[new].tolist()))
        counts[a, 1] = len(kinds)
    return counts
