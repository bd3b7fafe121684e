"""Token ids of whole texts, one dictionary look-up per word.

The given vocabulary drops white space before it splits, so no token reaches over a
blank or a line feed and what stands on one side never changes the other side. A text
may therefore be cut there, and a word's ids may be kept and used again. Everything
inside a word, special strings included, is left to the tokenizer library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(text: str, limit: int) -> Iterator[str]:
    """``text`` in parts of about ``limit`` characters, cut behind blanks or line feeds only."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit))
        if cut < 0:  # a word longer than the limit stays whole
            ends = [p for p in (text.find(" ", at + limit), text.find("\n", at + limit)) if p >= 0]
            if not ends:
                break
            cut = min(ends)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


#: Words that the splitter takes as one part whatever stands around them. An apostrophe would join it to others.
LETTERS, MARKS = "a-zß-öø-ÿ", ".,!?;:*$%&#"
PART = re.compile(f"[{LETTERS}]+|[{MARKS}]+")
#: Marks at the end of a word are a part of their own.
LAST_MARKS = f"([{LETTERS}])([{MARKS}]+)( |$)"
#: Texts with these keep their capitals: special strings are exact, and accents may join small letters only.
CASED = r"<\||\p{M}"


class WordEncoder:
    """Encodes texts word by word. The table of known words is bounded; when it is full, the older half goes.

    It outlives a task, as the next one of the worker process meets the same words.
    """

    def __init__(self, path: str, max_words: int = 600_000, max_chars: int = 20_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.max_words, self.max_chars = max_words, max_chars
        self.index: dict[str, int] = {}  # word: its place in the two arrays of ranges
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.chars = 0

    def forget(self, words: int | None = None) -> None:
        """Drop the ``words`` oldest words of the table (all if not given); the others move up."""
        words = len(self.length) if words is None else words
        kept = list(self.index)[words:]  # in the order of their places
        self.index = dict(zip(kept, range(len(kept))))
        self.chars = sum(map(len, kept))
        first = int(self.start[words]) if kept else len(self.flat)
        self.start, self.length, self.flat = self.start[words:] - first, self.length[words:].copy(), self.flat[first:].copy()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Put new words into the table."""
        parts = [w for w in new if PART.fullmatch(w)]
        # these stay whole, so many go in one text, and each ends in one closing token
        ids = self._encode([" ".join(parts[at:at + 500]) for at in range(0, len(parts), 500)])
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
        ends = np.flatnonzero(self.closes[flat]) + 1
        if len(ends) != len(parts):
            raise ValueError("this vocabulary does not mark the ends of words")
        known = set(parts)
        odd = [w for w in new if w not in known]
        ids = self._encode(odd)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        length = np.concatenate([np.diff(ends, prepend=0), size])
        self.index.update(zip(chain(parts, odd), range(len(self.index), len(self.index) + len(new))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate(
            [self.flat, flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])
        self.chars += sum(map(len, new))

    def _numbers(self, words: Sequence[str]) -> np.ndarray:
        """Places of words in the table, -1 where unknown."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def _words(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words in the table, and how many words each text has."""
        text = pa.array(texts, pa.large_string())
        text = pc.if_else(pc.match_substring_regex(text, CASED), text, pc.ascii_lower(text))
        text = pc.replace_substring(text, "\n", " ")
        split = pc.split_pattern(pc.replace_substring_regex(text, LAST_MARKS, r"\1 \2\3"), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.index) + len(words) > self.max_words or self.chars > self.max_chars:
            self.forget(len(self.index) // 2)
            if len(self.index) + len(words) > self.max_words or self.chars > self.max_chars:
                self.forget()
        at = self._numbers(words)
        if len(unknown := np.flatnonzero(at < 0)):
            new = [words[i] for i in unknown]
            self._learn(new)
            at[unknown] = self._numbers(new)
        return at[coded.indices.to_numpy()], np.diff(split.offsets.to_numpy())

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """Tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        at, words = self._words(texts)
        return np.add.reduceat(self.length[at], np.cumsum(words) - words)

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not texts:
            return []
        at, words = self._words(texts)
        length = self.length[at]
        ends = np.cumsum(length)
        flat = self.flat[np.repeat(self.start[at] - (ends - length), length) + np.arange(ends[-1])]
        return np.split(flat, ends[np.cumsum(words) - 1][:-1])


def in_groups(texts: Sequence[str | None], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` characters together; a longer text is alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> WordEncoder:
    """One encoder a worker process, so that the vocabulary is read once."""
    return WordEncoder(path)
