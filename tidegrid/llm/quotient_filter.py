"""Counting quotient filters over sorted fingerprints.

A fingerprint of ``bits`` bits is cut into a quotient, which names a slot, and a remainder, which is
stored there or in the next free slot behind. The remainders of one quotient form a run in
rising order; one bit a slot says that some run belongs to it, another that a run ends in it, so every
fingerprint can be read back in order. A count above one stands in the slots behind its remainder, as
digits of ``count - 1`` that are no larger than the remainder: a larger value is the next
remainder. So nothing is lost, and filters of any sizes merge by merging what they hold in order.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

HEAD = struct.Struct("<BBQQ")
LOAD = 0.9
U = np.uint64


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


class QuotientFilter:
    """Fingerprints and their counts in ``2 ** quotient_bits`` slots and those that run over the end."""

    def __init__(self, bits: int, quotient_bits: int, owned: np.ndarray, ends: np.ndarray, slots: np.ndarray):
        self.bits, self.quotient_bits, self.owned, self.ends, self.slots = bits, quotient_bits, owned, ends, slots

    @classmethod
    def of(cls, prints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """A filter of distinct ``prints`` below ``2 ** bits`` in rising order; ``bits`` is 63 at most."""
        q = min(bits, max(1, int(len(prints) / LOAD).bit_length()))
        low = U(bits - q)
        prints = prints.astype(U)
        quotient, stored = (prints >> low).astype(np.int64), (prints & ((U(1) << low) - U(1))) + U(1)
        rest, digits, size = counts.astype(U) - U(1), [], np.ones(len(prints), np.int64)
        while len(live := np.flatnonzero(rest)):
            base = stored[live] + U(1)
            digits.append((live, rest[live] % base))
            rest[live] //= base
            size[live] += 1
        first = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), U)
        flat[first] = stored
        for place, (live, digit) in enumerate(digits, 1):
            flat[first[live] + place] = digit
        runs = np.flatnonzero(np.diff(quotient, prepend=-1))
        length = np.add.reduceat(size, runs) if len(runs) else np.zeros(0, np.int64)
        before = np.cumsum(length) - length
        start = before + np.maximum.accumulate(quotient[runs] - before)
        n = max(1 << q, int(start[-1] + length[-1]) if len(runs) else 0)
        owned, ends, slots = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, U)
        owned[quotient[runs]] = True
        ends[start + length - 1] = True
        slots[np.arange(len(flat)) + np.repeat(start - before, length)] = flat
        return cls(bits, q, owned, ends, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints in rising order and their counts."""
        quotient, end = np.flatnonzero(self.owned), np.flatnonzero(self.ends)
        start = np.maximum(quotient, np.concatenate([[0], end[:-1] + 1]))[:len(quotient)]
        length = end - start + 1
        run = np.repeat(np.arange(len(quotient)), length)
        values = self.slots[np.arange(len(run)) + np.repeat(start - (np.cumsum(length) - length), length)]
        # a value above all before it in its run is a remainder, any other a digit of the last one's count
        low = U(self.bits - self.quotient_bits)
        order = (run.astype(U) << (low + U(1))) + values
        highest = np.maximum.accumulate(order)
        new = np.ones(len(order), bool)
        new[1:] = order[1:] > highest[:-1]
        first = np.flatnonzero(new)
        stored = values[first]
        prints = (quotient[run[first]].astype(U) << low) | (stored - U(1))
        counts, power = np.ones(len(first), U), np.ones(len(first), U)
        digits = np.diff(first, append=len(values)) - 1
        for place in range(int(digits.max(initial=0))):
            live = np.flatnonzero(digits > place)
            counts[live] += values[first[live] + 1 + place] * power[live]
            power[live] *= stored[live] + U(1)
        return prints, counts.astype(np.int64)

    @property
    def width(self) -> int:
        """Bytes a slot: a remainder plus one, as zero is kept for digits."""
        return (self.bits - self.quotient_bits + 8) // 8

    def to_bytes(self) -> bytes:
        slots = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :self.width]
        return HEAD.pack(self.bits, self.quotient_bits, len(self.slots), 0) + packed(self.owned) + packed(self.ends) + slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        bits, q, n, _ = HEAD.unpack_from(data)
        raw, marks = np.frombuffer(data, np.uint8, offset=HEAD.size), (n + 7) // 8
        owned, ends = (np.unpackbits(raw[i * marks:(i + 1) * marks], count=n).astype(bool) for i in (0, 1))
        made = cls(bits, q, owned, ends, np.zeros(n, "<u8"))
        made.slots.view(np.uint8).reshape(-1, 8)[:, :made.width] = raw[2 * marks:].reshape(n, made.width)
        return made


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in rising order with the sums of their counts."""
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
    return prints[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of several filters in one order, counts added up."""
    return summed(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))
