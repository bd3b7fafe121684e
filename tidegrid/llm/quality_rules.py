"""Quality rules: counts over the whole text, and the share of lines that read as content.

A conditional random field labels a text's lines as content or boilerplate, each in the light of its
neighbours (Viterbi decoding). It is learned from labelled documents: lines of good ones count as content,
those of bad ones as boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.crf import Crf, fit_crf, viterbi
from tidegrid.llm.quality_model import held_out
from tidegrid.llm.sampling import hashed_sample
from tidegrid.llm.shingles import GOLDEN, mix, window_hashes, word_hashes
from tidegrid.llm.word_encoder import in_groups

SPACE = " \t\n\x0b\x0c\r"
_KIND = np.zeros(256, np.int64)  # others
for _class, _bytes in enumerate([SPACE.encode(), b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b"!?", b".,;:",
                                 bytes(range(0x80, 0xC0))], 1):
    _KIND[list(_bytes)] = _class
BLANK, SYMBOL, CAPITAL, DIGIT, SHOUT, STOP, INSIDE = range(1, 8)
KINDS = 8
#: Upper ends of the bins of each line feature: words, and shares of symbols, capitals, digits, shouts, stops; letters a word.
BINS = [(0, 2, 5, 10, 20, 50), (0, .02, .1), (0, .05, .15, .5), (0, .02, .1, .3), (0, .02, .05), (0, .02, .05, .1), (2, 4, 5, 6, 8, 12)]
VALUES = 8
#: Training cuts long texts into runs of so many lines.
RUN = 64


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned features of all lines with a word, how many such lines each text has, and the words of each line."""
    lines, lengths, seen_before = [], [], []
    for t in texts:
        own = [x for x in t.split("\n") if x.strip(SPACE)]
        seen: set[str] = set()
        for x in own:
            seen_before.append(x in seen)
            seen.add(x)
        lines += own
        lengths.append(len(own))
    data = [x.encode() for x in lines]
    raw = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    size = np.fromiter((len(d) + 1 for d in data), np.int64, len(data))
    kind = np.bincount(np.repeat(np.arange(len(data)), size) * KINDS + _KIND[raw],
                       minlength=len(data) * KINDS).reshape(-1, KINDS).astype(float)
    begin, word = word_hashes(raw.tobytes(), cased=True)
    words = np.diff(np.searchsorted(begin, np.cumsum(size)), prepend=0)
    filled = np.maximum(1, kind.sum(axis=1) - kind[:, BLANK] - kind[:, INSIDE])
    numbers = [words, *(kind[:, k] / filled for k in (SYMBOL, CAPITAL, DIGIT, SHOUT, STOP)), filled / np.maximum(1, words)]
    out = np.zeros((len(data), len(BINS) + 2), np.int64)
    for f, (ends, value) in enumerate(zip(BINS, numbers)):
        out[:, f] = np.searchsorted(ends, value, "left")
    out[:, -2] = seen_before
    same = word[1:] == word[:-1]  # a word said twice running
    line = np.repeat(np.arange(len(data)), words)
    again = np.bincount(line[1:][same & (line[1:] == line[:-1])], minlength=len(data)) if len(line) else np.zeros(len(data))
    out[:, -1] = np.searchsorted((0, .1, .5), again / np.maximum(1, words), "left")
    return out, np.array(lengths, np.int64), words


def base_counts(texts: Sequence[str]) -> dict[str, np.ndarray]:
    """Counts of each text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``."""
    data = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    size = np.fromiter((len(d) + 1 for d in data), np.int64, len(data))
    kind = np.bincount(np.repeat(np.arange(len(data)), size) * KINDS + _KIND[raw],
                       minlength=len(data) * KINDS).reshape(-1, KINDS)
    begin, word = word_hashes(raw.tobytes(), cased=True)
    last = np.searchsorted(begin, np.cumsum(size))
    words = np.diff(last, prepend=0)
    twice = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        seen: set[str] = set()
        for x in t.split("\n"):
            if x.strip(SPACE):
                twice[i] += x in seen
                seen.add(x)
    owner = np.repeat(np.arange(len(texts)), words)
    window = window_hashes(word, 8)
    at = np.arange(len(window))
    inside = at + 8 <= last[owner[:len(window)]]
    at = at[inside]
    _, number, count = np.unique(mix(window[inside] + owner[at].astype(np.uint64) * GOLDEN),
                                 return_inverse=True, return_counts=True)
    at = at[count[number] > 1]
    cover = np.zeros(len(word) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 8, -1)
    repeated = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=len(texts))
    return {"n_words": words, "word_chars": kind.sum(axis=1) - kind[:, BLANK] - kind[:, INSIDE],
            "n_symbols": kind[:, SYMBOL], "n_dup_lines": twice, "n_repeat_words": repeated}


def fit_line_labels(docs: DataFrame, labels: DataFrame, *, max_docs: int = 4000, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality") -> Crf | None:
    """Learn from the lines of at most ``max_docs`` labelled documents, chosen by a hash of their ids.

    Only binned features reach the driver. None when there are not both good and bad ones.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    chosen = hashed_sample(usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")),
                           ["id", "label"], max_docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, lengths, _ = line_features([t or "" for t in batch.column(2).to_pylist()])
            parts = np.split(lines.astype(np.uint8), np.cumsum(lengths)[:-1]) if len(lengths) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p.tobytes() for p in parts], pa.binary())], ["id", "label", "lines"])

    id_type = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select(
        "id", "label", "text").mapInArrow(run, f"id {id_type}, label int, lines binary").toPandas()
    found = found.sort_values(["id", "label", "lines"])
    if found["label"].nunique() < 2:
        return None
    runs, marks = [], []
    for label, lines in zip(found["label"], found["lines"]):
        own = np.frombuffer(lines, np.uint8).reshape(-1, len(BINS) + 2)
        for at in range(0, len(own), RUN):
            runs.append(own[at:at + RUN])
            marks.append(label)
    lengths = np.array([len(r) for r in runs], np.int64)
    return fit_crf(np.concatenate(runs).astype(np.int64), lengths, np.repeat(np.array(marks), lengths), VALUES)


def judge_quality(docs: DataFrame, labels: DataFrame, *, min_words: int = 20, max_repeat_percent: int = 30,
                  min_content: float = 0.5, max_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """Base counts, ``base_failed``, ``content_share`` and ``kept`` of every document.

    Words are runs of anything but blank and the control characters 9 to 13. A text fails the base rules with fewer
    than ``min_words`` words or more than ``max_repeat_percent`` percent of them in repeated 8-word windows. Others
    are kept when at least ``min_content`` of their words stand in lines labelled as content. A null text is empty and
    fails. Without labels of both kinds all lines are content. Rows are kept one by one, with equal or no
    ids too; other columns are ignored. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_line_labels(
        docs, labels, max_docs=max_docs, id_col=id_col, text_col=text_col, label_col=label_col))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = [id_col, *counts, "content_share"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in in_groups(texts, 1_000_000):
                base = base_counts(texts[a:b])
                lines, lengths, words = line_features(texts[a:b])
                content = np.ones(len(lines)) if model.value is None else viterbi(model.value, lines, lengths)
                owner = np.repeat(np.arange(b - a), lengths)
                share = np.bincount(owner, words * content, b - a) / np.maximum(1, np.bincount(owner, words, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(base[c].astype(np.int64)) for c in counts), pa.array(share)], names)

    id_type = docs.schema[id_col].dataType.simpleString()
    judged = small_batches(docs).select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in counts) + ", content_share double")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > max_repeat_percent * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= min_content))
