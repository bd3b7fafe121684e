"""Packing token sequences by minimum bin slack.

Every task packs the rows it reads, a bounded buffer at a time, so nothing is shuffled
and a lost task is simply run again. A document is cut into full windows and a rest.
For the rests of a buffer, the longest opens a window, and a subset-sum over a bitset
(bit ``s`` is set when some multiset of the other lengths sums to ``s``) finds the fill
closest to what is left; walking back through the steps gives the count of each length.
The same window is repeated as often as the counts allow.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegrid.llm.batches import small_batches
from tidegrid.llm.word_encoder import in_groups, shared_encoder, slices

#: doc, start in the document, ids, tokens of the document
Piece = tuple[Any, int, np.ndarray, int]


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``room`` as can be, never above.

    Longer lengths are offered first; the search ends at the first exact sum.
    """
    reach, full = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... copies and the rest make every count up to the limit
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & full
            left -= part
            part *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    target = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, part, before in reversed(steps):
        if not before >> target & 1:
            taken[length] += part
            target -= length * part
    return dict(taken)


class Packer:
    """Pieces of one task, packed into windows of ``capacity`` tokens."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rests: dict[int, list[Piece]] = defaultdict(list)
        self.tokens = 0

    def add(self, doc: Any, ids: np.ndarray, start: int, total: int) -> Iterator[list[Piece]]:
        """Give out full windows of a document at once and keep its rest."""
        cap, end = self.capacity, len(ids) - len(ids) % self.capacity
        for at in range(0, end, cap):
            yield [(doc, start + at, ids[at:at + cap], total)]
        if end < len(ids):
            # a copy, as a view would hold the whole text's ids
            self.rests[len(ids) - end].append((doc, start + end, ids[end:].copy(), total))
            self.tokens += len(ids) - end

    def _take(self, fill: dict[int, int]) -> list[Piece]:
        out = []
        for length, n in fill.items():
            own = self.rests[length]
            out += own[-n:]
            del own[-n:]
            if not own:
                del self.rests[length]
        self.tokens -= sum(length * n for length, n in fill.items())
        return out

    def _fill(self) -> dict[int, int]:
        """The window opened by the longest rest."""
        first = max(self.rests)
        counts = {length: len(own) for length, own in self.rests.items()}
        counts[first] -= 1
        fill = closest_fill(counts, self.capacity - first)
        fill[first] = fill.get(first, 0) + 1
        return fill

    def exact(self, misses: int = 64) -> Iterator[list[Piece]]:
        """Windows without slack; what finds no exact fill waits for more rows. Ends after so many ``misses``."""
        aside: dict[int, list[Piece]] = {}
        while self.tokens >= 16 * self.capacity and len(aside) < misses:
            fill = self._fill()
            if sum(length * n for length, n in fill.items()) == self.capacity:
                for _ in range(min(len(self.rests[length]) // n for length, n in fill.items())):
                    yield self._take(fill)
            else:
                first = max(self.rests)
                aside[first] = self.rests.pop(first)
                self.tokens -= first * len(aside[first])
        for length, own in aside.items():
            self.rests[length] += own
            self.tokens += length * len(own)

    def cut(self, upto: int = 0) -> Iterator[list[Piece]]:
        """Closest windows until at most ``upto`` tokens, or less than a window, are left; slack is closed by cutting one more piece."""
        cap = self.capacity
        while self.tokens >= max(cap, upto + 1):
            window = self._take(self._fill())
            slack = cap - sum(len(p[2]) for p in window)
            while slack:
                doc, start, ids, total = self._take({max(self.rests): 1})[0]
                window.append((doc, start, ids[:slack], total))
                if len(ids) > slack:
                    self.rests[len(ids) - slack].append((doc, start + slack, ids[slack:], total))
                    self.tokens += len(ids) - slack
                slack -= len(window[-1][2])
            yield window

    def rest(self) -> Iterator[list[Piece]]:
        """The last windows; the end becomes powers of two."""
        yield from self.cut()
        left = self._take({length: len(own) for length, own in sorted(self.rests.items(), reverse=True)})
        size = sum(len(p[2]) for p in left)
        while size:
            room = 1 << (size.bit_length() - 1)
            size -= room
            window = []
            while room:
                doc, start, ids, total = left.pop(0)
                window.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    left.insert(0, (doc, start + room, ids[room:], total))
                room -= len(window[-1][2])
            yield window


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text", buffer_tokens: int = 2_000_000) -> DataFrame:
    """Pieces of all texts, placed into windows of ``capacity`` tokens.

    ``tokenizer`` is a file of the tokenizers library whose vocabulary drops white space.
    Each row's text is encoded without special tokens and ended by ``end_id``. One row a
    piece comes back: the id, ``start`` and ``length`` in the document, ``ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    Only the last sequences of a task are shorter than ``capacity``, and those hold a power of two, so
    that no sequence needs padding. A null or empty text is the end token alone. Rows with the
    same or no id are documents of their own. Other columns are ignored. An empty table gives no rows.
    A task holds ``buffer_tokens`` ids, one document's text and its ids at a time: where exact fills leave more than half of
    them, the closest ones go out and slack is closed by cutting. Sequence
    ids start with the partition's number; they repeat on a rerun when its rows come in the same order.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, "
              "sequence_id long, offset long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        encoder, packer, n = shared_encoder(tokenizer), Packer(capacity), 0
        types = None

        def documents() -> Iterator[tuple[Any, np.ndarray]]:
            nonlocal types
            for batch in batches:
                types = batch.schema.field(0).type
                docs_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for a, b in in_groups(texts):
                    if b - a > 1 or len(texts[a] or "") < 1_000_000:
                        ids = encoder.ids([t or "" for t in texts[a:b]])
                    else:
                        ids = [np.concatenate([encoder.ids([s])[0] for s in slices(texts[a], 1_000_000)])]
                    yield from zip(docs_of[a:b], ids)

        def windows() -> Iterator[list[Piece]]:
            for doc, ids in documents():
                whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                yield from packer.add(doc, whole, 0, len(whole))
                if packer.tokens >= buffer_tokens:
                    yield from packer.exact()
                    yield from packer.cut(buffer_tokens // 2)
            yield from packer.exact()
            yield from packer.rest()

        rows: list[list[Any]] = [[] for _ in range(7)]
        size = 0
        for window in windows():
            offset = 0
            for doc, start, ids, total in window:
                for column, value in zip(rows, (doc, start, len(ids), ids.tobytes(), total, base + n, offset)):
                    column.append(value)
                offset += len(ids)
            n, size = n + 1, size + offset
            if size >= 500_000:
                yield _batch(rows, id_col, types)
                rows, size = [[] for _ in range(7)], 0
        if rows[0]:
            yield _batch(rows, id_col, types)

    return small_batches(docs).select(id_col, text_col).mapInArrow(run, schema)


def _batch(rows: list[list[Any]], id_col: str, id_type: pa.DataType) -> pa.RecordBatch:
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)], names)
