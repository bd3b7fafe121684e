"""Benchmark items in documents, by the pigeonhole principle and Myers' bit-parallel distance.

With at most ``k`` edits, at least ``s`` of ``k + s`` disjoint pieces of an item stay intact and lie at nearly the
right distances from each other. An automaton finds the exact hits of all pieces in one pass over a text.
Places with ``s`` hits of one item on neighbouring diagonals are verified: one machine word
operation for all rows of the edit matrix a character gives the smallest distance there.

Short items are searched for as they are, between blanks; so are, in the texts as given but for white
space, items of nothing but signs.

Items come in blocks of bounded size, which tasks get as their query set.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from itertools import repeat
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.batches import small_batches


def normalised(texts: pa.Array) -> pa.Array:
    """Small letters and digits, with one blank for all that stands between."""
    low = pc.utf8_lower(texts.cast(pa.large_string()))
    return pc.utf8_trim(pc.replace_substring_regex(low, r"[^\pL\pN\pM]+", " "), " ")


def spaced(text: str) -> str:
    """The text as given, with one blank for all white space, and around it."""
    return f" {' '.join(text.split())} "


def pieces(item: str, count: int) -> list[tuple[int, str]]:
    """``item`` cut into ``count`` pieces of nearly the same length, with their places."""
    ends = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def distance_in(item: str, text: str) -> tuple[int, int]:
    """The smallest edit distance of ``item`` to any part of ``text``, and where the first such part ends."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        places[c] |= 1 << i
    up, down, score = full, 0, m  # rows where the column rises or falls by one
    best, end = m, 0
    for j, c in enumerate(text):
        eq = places.get(c, 0)
        level = eq | down
        flat = (((eq & up) + up) ^ up) | eq
        right_up = down | (full & ~(flat | up))
        right_down = up & flat
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        up = right_down | (full & ~(level | right_up))
        down = right_up & level
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """A block of items, ready to be searched for."""

    def __init__(self, items: Sequence[tuple[Any, str, bool]], error_rate: float, spare: int, min_chars: int):
        self.items = [(i, t, int(len(t) * error_rate)) for i, t, _ in items]
        self.spare = spare
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        short: dict[str, list[int]] = defaultdict(list)
        signs: dict[str, list[int]] = defaultdict(list)
        for n, (_, t, k) in enumerate(self.items):
            if items[n][2]:
                signs[f" {t} "].append(n)
            elif len(t) < min_chars:
                short[f" {t} "].append(n)
            else:
                for at, piece in pieces(t, k + spare):
                    owners[piece].append((n, at + len(piece)))
        self.automaton, self.short, self.signs = self._automaton(owners), self._automaton(short), self._automaton(signs)

    @staticmethod
    def _automaton(owners: dict[str, list]) -> Any:
        """An automaton of the words, or none without words."""
        import ahocorasick

        if not owners:
            return None
        automaton = ahocorasick.Automaton()
        for word, own in owners.items():
            automaton.add_word(word, own)
        automaton.make_automaton()
        return automaton

    def places(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Item number and the range of the text that may hold it."""
        hits: dict[int, list[int]] = defaultdict(list)
        for end, own in self.automaton.iter(text) if self.automaton else ():
            for n, at in own:
                hits[n].append(end + 1 - at)
        for n, starts in hits.items():
            if len(starts) < self.spare:
                continue
            starts.sort()
            _, item, k = self.items[n]
            begin = stop = -1
            for a, b in zip(starts, starts[self.spare - 1:]):
                if b - a > k:
                    continue
                lo, hi = max(0, a - k), b + len(item) + k
                if lo > stop:
                    if stop >= 0:
                        yield n, begin, stop
                    begin = lo
                stop = hi
            if stop >= 0:
                yield n, begin, stop

    def find(self, text: str, raw: str = "") -> dict[int, tuple[int, int]]:
        """The items in ``text``, or for signs in ``raw``, by number: distance and where the match ends."""
        found: dict[int, tuple[int, int]] = {}
        for n, begin, end in self.places(text):
            _, item, k = self.items[n]
            best, at = distance_in(item, text[begin:end])
            if best <= k and (n not in found or best < found[n][0]):
                found[n] = best, begin + at
        for automaton, padded in ((self.short, f" {text} "), (self.signs, spaced(raw) if self.signs else "")):
            for end, own in automaton.iter(padded) if automaton else ():
                for n in own:
                    found.setdefault(n, (0, end - 1))
        return found

    def find_all(self, texts: pa.Array) -> Iterator[dict[int, tuple[int, int]]]:
        """The items in each of the texts as given; null ones are empty."""
        raws = texts.to_pylist() if self.signs else repeat("")
        for text, raw in zip(normalised(texts).to_pylist(), raws):
            yield self.find(text or "", raw or "")


@lru_cache(maxsize=2)
def _matcher(key: str, load: Any) -> Matcher:
    return Matcher(*load())


class _Block:
    """A broadcast block of items; equal by key, so a worker builds its automaton once."""

    def __init__(self, broadcast: Any, error_rate: float, spare: int, min_chars: int):
        self.key, self.broadcast, self.how = uuid.uuid4().hex, broadcast, (error_rate, spare, min_chars)

    def __hash__(self) -> int:
        return hash(self.key)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Block) and self.key == other.key

    def __call__(self) -> tuple[Any, float, int, int]:
        return self.broadcast.value, *self.how


def _search(block: _Block, id_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block.key, block)
        for batch in batches:
            rows: list[list[Any]] = [[], [], [], []]
            for i, held in enumerate(matcher.find_all(batch.column(1))):
                for n, (best, end) in held.items():
                    for column, value in zip(rows, (i, matcher.items[n][0], best, end)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], id_type),
                 pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64())], ["doc", "item", "distance", "end"])
    return run


def _drop(block: _Block, column: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(block.key, block)
        for batch in batches:
            yield batch.filter(pa.array([not held for held in matcher.find_all(batch.column(column))], pa.bool_()))
    return run


def _blocks(items: DataFrame, error_rate: float, spare: int, min_chars: int, block_chars: int) -> list[_Block]:
    """The items in broadcast blocks; the driver holds one block at a time."""
    context = items.sparkSession.sparkContext
    blocks, block, size = [], [], 0
    for key, text in items.where(items[1].isNotNull()).toLocalIterator():
        item = normalised(pa.array([text]))[0].as_py()
        signs = not item
        item = item or " ".join(text.split())
        if not item:
            continue
        block.append((key, item, signs))
        size += len(item)
        if size >= block_chars:
            blocks.append(_Block(context.broadcast(block), error_rate, spare, min_chars))
            block, size = [], 0
    if block:
        blocks.append(_Block(context.broadcast(block), error_rate, spare, min_chars))
    return blocks


def contaminations(docs: DataFrame, benchmark: DataFrame, *, error_rate: float = 0.1, spare: int = 3,
                   min_chars: int = 32, block_chars: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item it holds: both ids, ``distance`` and ``match_end``.

    An item is held when some part of the text is within ``error_rate`` of the item's length in edits; both are
    taken in small letters, with one blank for anything but letters and digits, and ``match_end`` counts
    in that form. Items of fewer than ``min_chars`` characters in that form are held where they stand as they
    are, as whole words. Items without a letter or digit are held where they stand in the text as given,
    between white space, any white space being one blank; there ``match_end`` counts in that form. Items of
    white space only are held by nothing. Null texts are empty. Repeated documents or items each give their rows; ids may be null.
    Other columns are ignored. Empty tables give no rows. Items are searched in blocks of
    ``block_chars`` characters, each one pass over the documents.
    """
    doc_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
    texts = small_batches(docs).select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"doc {doc_type}, item {item_type}, distance int, end long"
    blocks = _blocks(benchmark.select(item_col, item_text), error_rate, spare, min_chars, block_chars)
    found = [texts.mapInArrow(_search(b, arrow_type), schema) for b in blocks]
    rows = reduce(DataFrame.unionByName, found) if found else texts.limit(0).mapInArrow(lambda b: iter(()), schema)
    return rows.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "distance", F.col("end").alias("match_end"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, error_rate: float = 0.1, spare: int = 3,
                         min_chars: int = 32, block_chars: int = 4_000_000, text_col: str = "text",
                         item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no benchmark item (see :func:`contaminations`)."""
    names = small_batches(docs).columns
    for b in _blocks(benchmark.select(item_col, item_text), error_rate, spare, min_chars, block_chars):
        docs = docs.mapInArrow(_drop(b, names.index(text_col)), docs.schema)
    return docs
