"""Quality scores from a generalised additive model over features of the text alone."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidegrid.llm.batches import small_batches
from tidegrid.llm.gam import Gam, fit_gam
from tidegrid.llm.sampling import hashed_sample
from tidegrid.llm.shingles import shingle_sets, word_hashes
from tidegrid.llm.word_encoder import in_groups

FEATURES = ["chars", "words", "word_length", "capitals", "digits", "symbols", "shouts", "stops", "foreign", "lines",
            "line_words", "repeated_lines", "distinct_words", "repeated_shingles", "longest_word"]
#: Byte classes: others, capitals, small letters, digits, symbols, shouts, stops, line feeds, foreign, inside a character.
_KIND = np.zeros(256, np.int64)
for _class, _bytes in enumerate([b"", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b"#*$%&|<>{}[]\\^~=_@+",
                                 b"!?", b".,;:", b"\n", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0))]):
    _KIND[list(_bytes)] = _class
KINDS = 10


def features(texts: Sequence[str]) -> np.ndarray:
    """One row of :data:`FEATURES` for each text, taken from all of it."""
    data = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    size = np.array([len(d) + 1 for d in data])
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(data)), size)
    kind = np.bincount(owner * KINDS + _KIND[raw], minlength=len(data) * KINDS).reshape(-1, KINDS).astype(float)
    kind[:, 7] -= 1  # the line feed put behind each text
    chars = kind.sum(axis=1) - kind[:, 9]
    begin, word = word_hashes(raw.tobytes())
    words = np.diff(np.searchsorted(begin, ends), prepend=0)
    last = np.cumsum(words)
    sets, shingles = shingle_sets(texts)
    out = np.zeros((len(data), len(FEATURES)))
    some = np.maximum(chars, 1)
    out[:, 0], out[:, 1] = np.log1p(chars), np.log1p(words)
    out[:, 2] = chars / np.maximum(words, 1)
    for column, k in ((3, 1), (4, 3), (5, 4), (6, 5), (7, 6), (8, 8)):
        out[:, column] = kind[:, k] / some
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip()]
        out[i, 9] = np.log1p(len(lines))
        out[i, 10] = words[i] / max(1, len(lines))
        out[i, 11] = 1 - len(set(lines)) / max(1, len(lines))
        out[i, 12] = len(np.unique(word[last[i] - words[i]:last[i]])) / max(1, words[i])
        out[i, 14] = np.log1p(max(map(len, t.split()), default=0))
    out[:, 13] = 1 - shingles / np.maximum(1, np.where(words >= 5, words - 4, np.minimum(words, 1)))
    return out


def _rows(texts: list[str | None]) -> np.ndarray:
    parts = [features([t or "" for t in texts[a:b]]) for a, b in in_groups(texts, 1_000_000)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def held_out(id_col: str) -> Any:
    """Rows that are never learned from: the CRC-32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality") -> Gam:
    """Learn from at most ``max_rows`` labelled documents that are not held out.

    Which ones is decided by a hash of the id, so the sample is as good as random and comes out the
    same each time. Only their features reach the driver. Null labels and ids are skipped.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    chosen = hashed_sample(usable.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")),
                           ["id", "label"], max_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1).to_pylist())
            columns = [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in x.T)]
            yield pa.RecordBatch.from_arrays(columns, ["label", *FEATURES])

    found = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select(
        "label", "text").mapInArrow(run, "label double, " + ", ".join(f"{f} double" for f in FEATURES))
    table = found.toPandas().sort_values(["label", *FEATURES]).to_numpy(float)
    return fit_gam(table[:, 1:], table[:, 0])


def with_quality(docs: DataFrame, model: Gam, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality for each text as one more column, ``score_col``."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(_rows(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, score_col])

    return small_batches(docs).mapInArrow(run, T.StructType([*docs.schema, T.StructField(score_col, T.DoubleType())]))


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, max_rows: int = 20_000,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``held_out``, ``score`` (0 to 1) and ``predicted`` (score at least ``threshold``) of every document.

    Only the text is looked at. A null text is scored as an empty one. Without labels, or
    with one label only, all have the base rate. Rows are kept one by one, with equal or no ids
    too; other columns are ignored. An empty table gives no rows.
    """
    model = fit_quality(docs, labels, max_rows=max_rows, id_col=id_col, text_col=text_col, label_col=label_col)
    scored = with_quality(docs.select(id_col, text_col), model, text_col=text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
