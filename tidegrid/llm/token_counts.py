"""Token counts by overlap resynchronisation.

A huge text is encoded in overlapping chunks with offsets. Two neighbours are spliced at a
boundary both of them prove. One kind is a white-space character in the overlap that lies inside no
token of either, followed by a whole word that both cut into the same ids at the same
places. The other needs no blank: a place inside a run of letters, digits or signs where both chunks begin
the same token and the left one ends another. A sequence of byte-pair tokens is the encoding of its run
exactly if each two neighbours are their own encoding; those at the splice are neighbours in the left chunk, all others
in one of the two. When an overlap holds no boundary it is doubled, and if even the whole left
chunk holds none, the two become one chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import Any
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegrid.llm.batches import small_batches
from tidegrid.llm.word_encoder import in_groups, shared_encoder

#: White space that the vocabulary drops: no token holds it or reaches over it.
STABLE = re.compile("[ \n]")


class Chunk:
    """Ids of ``text[start:end]`` with the places of their tokens in the whole text."""

    def __init__(self, tokenizer: Any, text: str, start: int, end: int):
        e = tokenizer.encode(text[start:end], add_special_tokens=False)
        self.start, self.end, self.ids = start, end, np.array(e.ids, np.int64)
        at = np.array(e.offsets, np.int64).reshape(-1, 2) + start
        self.begins, self.ends = at[:, 0], at[:, 1]

    def between(self, a: int, b: int) -> slice:
        """Tokens that begin in ``[a, b)``."""
        return slice(*np.searchsorted(self.begins, [a, b]))

    def free(self, p: int) -> bool:
        """No token lies over the character at ``p``."""
        i = int(np.searchsorted(self.begins, p, "right"))
        return i == 0 or int(self.ends[:i][-4:].max()) <= p


def common_boundary(text: str, left: Chunk, right: Chunk) -> int | None:
    """The first proven boundary in the overlap of two neighbours."""
    places = [right.start + m.start() for m in STABLE.finditer(text[right.start:left.end])]
    for p, q in zip(places, places[1:]):
        if q == p + 1 or not (left.free(p) and right.free(p) and left.free(q) and right.free(q)):
            continue
        a, b = left.between(p, q), right.between(p, q)
        if (np.array_equal(left.ids[a], right.ids[b]) and np.array_equal(left.begins[a], right.begins[b])
                and np.array_equal(left.ends[a], right.ends[b])):
            return p
    return common_token(text, left, right)


def run_kind(c: str) -> str:
    """What kind of run a character stands in, as the splitter cuts them; empty for white space."""
    kind = category(c)[0]
    return "" if c.isspace() else kind if kind in "LN" else "S"


def common_token(text: str, left: Chunk, right: Chunk) -> int | None:
    """The first place inside a run where both chunks begin the same token and a token of the left one ends."""
    a, b = left.between(right.start + 1, left.end), right.between(right.start + 1, left.end)
    places, i, j = np.intersect1d(left.begins[a], right.begins[b], return_indices=True)
    i, j = i + a.start, j + b.start
    same = (left.ids[i] == right.ids[j]) & (left.ends[i] == right.ends[j]) & (i > 0)
    same &= (left.ends[i - 1] == places) & (left.begins[i - 1] < places) & (right.begins[j - 1] < places)
    for p in places[same].tolist():
        if run_kind(text[p]) and run_kind(text[p - 1]) == run_kind(text[p]):
            return p
    return None


def resynchronised(tokenizer: Any, text: str, chunk: int, overlap: int) -> Iterator[np.ndarray]:
    """Ids of ``text``, spliced from chunks of ``chunk`` characters; ``overlap`` must be smaller."""
    n, begin = len(text), 0
    left = Chunk(tokenizer, text, 0, min(n, chunk))
    while left.end < n:
        width, p = overlap, None
        while True:
            start = max(begin, left.end - width)
            right = Chunk(tokenizer, text, start, min(n, left.end + chunk))
            p = common_boundary(text, left, right)
            if p is not None or start <= begin:
                break
            width *= 2
        if p is None:  # it starts where the left chunk's tokens are still to be given out
            left = Chunk(tokenizer, text, begin, right.end)
            continue
        yield left.ids[left.between(begin, p)]
        begin, left = p, right
    yield left.ids[left.between(begin, n)]


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = 2048, chunk: int = 16_384, overlap: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every text.

    Texts up to ``chunk`` characters are encoded whole, word by word; longer ones by overlap
    resynchronisation, holding one chunk and its neighbour. ``tokenizer`` is a file of the
    tokenizers library whose vocabulary drops white space; no special tokens are added and
    special strings in a text count as the library has them. A null or empty text has no bytes
    and no tokens; an empty table gives no rows. Rows are kept one by one, also with equal or no ids; other columns are ignored.
    """
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be positive and shorter than a chunk")
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_bytes", "n_tokens", "over_limit"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts = np.zeros(len(texts), np.int64)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk]
            own = [texts[i] for i in short]
            for a, b in in_groups(own):
                counts[short[a:b]] = encoder.counts(own[a:b])
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = sum(map(len, resynchronised(encoder.tokenizer, t, chunk, overlap)))
            size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(counts), pa.array(counts > limit)], names)

    return small_batches(docs).select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
