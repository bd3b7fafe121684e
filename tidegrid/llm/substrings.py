"""Exact substring deduplication by bucket-pointer refinement over sampled positions.

A start is repeated when the ``length`` bytes from there also begin somewhere else. Buckets of
equal starts are refined step by step, and what is alone in its bucket drops out at once:

1. Initial buckets are q-grams. Of all q-grams in a start's window, only the one with the
   smallest hash counts (the leftmost of equals). Equal windows choose it at the same
   place, so one position, an anchor, stands for a whole run of starts.
2. Anchors alone in their q-gram's bucket are done. The others are refined by the bytes that their
   run of windows spans: a run equal to another is repeated as a whole.
3. Only where an anchor's run equals no other are its starts refined, by the identifiers of later
   offsets: a bucket of ``2 d`` bytes is the pair of the buckets of ``d`` bytes at the start
   and ``d`` further on, up to the full length. First a few neighbouring starts go together: if what their
   windows share is found nowhere else, none is repeated; if all that share it also agree in what
   the windows span, all are. What remains, where a match begins or ends, is refined start by start.

Identifiers are hashes of 64 bits; a bucket is named by two to three of them, so no global
order of the suffixes is needed to number them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.shingles import GOLDEN, U, mix, powers, prefix_hashes
from tidegrid.llm.word_encoder import in_groups
from tidegrid.sources.stage import stage, unstage

_CODE = mix(np.arange(257, 513, dtype=np.uint64) * GOLDEN)
FAR = U(0xFFFFFFFFFFFFFFFF)
HALF = U(32)


def grams(raw: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes of ``raw``, and the hash of the ``q`` bytes from every position on."""
    p = prefix_hashes(_CODE[raw])
    n = len(raw) - q + 1
    if n <= 0:
        return p, np.zeros(0, np.uint64)
    return p, mix((p[q:] - p[:n]) * powers(len(raw))[1][:n])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values the place of its smallest, leftmost of equals."""
    # high half of the hash, then the place: what is compared depends on a window's bytes alone
    n = len(values) - width + 1
    pad = -len(values) % width
    keyed = (values >> HALF << HALF) | np.arange(len(values), dtype=np.uint64)
    blocks = np.concatenate([keyed, np.full(pad, FAR)]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(after[:n], before[width - 1:width - 1 + n])
    return (low & U(0xFFFFFFFF)).astype(np.int64)


def doubled(ids: np.ndarray, span: int, length: int) -> np.ndarray:
    """Bucket identifiers of ``length`` bytes from those of ``span``: each step reuses the last one's at a later offset."""
    while span < length:
        step = min(span, length - span)
        n = max(0, len(ids) - step)
        ids = mix(ids[:n] * GOLDEN + ids[step:step + n])
        span += step
    return ids


def _anchors(length: int, q: int):
    """Step 1: for each text its anchors, with the run of starts that each stands for."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in in_groups(texts, 1_000_000):
                data = [t.encode() for t in texts[a:b]]
                raw = np.frombuffer(b"".join(data), np.uint8)
                size = np.fromiter(map(len, data), np.int64, len(data))
                ends = np.cumsum(size)
                p, g = grams(raw, q)
                at = sliding_argmin(g, length - q + 1)
                owner = np.repeat(np.arange(len(data)), size)[:len(at)]
                start = np.flatnonzero(np.arange(len(at)) + length <= ends[owner])  # windows inside one text
                anchor, owner = at[start], owner[start]
                first = np.flatnonzero(np.diff(anchor, prepend=-1))
                count = np.diff(first, append=len(anchor))
                lo, anchor, owner = start[first], anchor[first], owner[first]
                hi = lo + count - 1 + length
                run_id = mix((p[hi] - p[lo]) * powers(len(raw))[1][lo] + (((anchor - lo) << 20) + count).astype(np.uint64) * GOLDEN)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner + a)), batch.column(1).take(pa.array(owner + a)),
                     pa.array(g[anchor].view(np.int64)), pa.array(run_id.view(np.int64)),
                     pa.array((lo - (ends - size)[owner]).astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array((anchor - lo).astype(np.int32)), batch.column(3).take(pa.array(owner + a))],
                    ["k", "b", "gram", "run", "start", "n", "off", "weight"])
    return run


#: Starts that are refined together first.
PART = 16
#: Parts that the members of a bucket are dealt into.
SALTS = 256
PARTS = "gram long, core long, hull long, weight int, k long, b int, start int, n int, off int"
WINDOWS = "gram long, bucket long, weight int, k long, b int, p int"
ANCHOR = "k long, b int, gram long, run long, start int, n int, off int, weight int"


def _runs_of_texts(batches: Iterable[pa.RecordBatch], q: int) -> Iterator[tuple]:
    """Key, bucket identifiers of all ``q``-byte starts, and the wanted runs of each text."""
    for batch in batches:
        k, b, texts, *runs = (c.to_pylist() for c in batch.columns)
        for i, text in enumerate(texts):
            raw = np.frombuffer(text.encode(), np.uint8)
            yield k[i], b[i], grams(raw, q)[1], [np.array(r[i]) for r in runs]


def _emit(rows: Iterable[list], names: list[str], types: list[type]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from columns, each an array or a value for all."""
    out: list[list[np.ndarray]] = [[] for _ in names]
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names)

    for columns in rows:
        n = len(columns[0])
        for column, value, kind in zip(out, columns, types):
            column.append(np.asarray(value).astype(kind) if isinstance(value, np.ndarray) else np.full(n, value, kind))
        size += n
        if size > 100_000:
            yield batch()
            out, size = [[] for _ in names], 0
    if size:
        yield batch()


def _parts(length: int, q: int):
    """Step 3, first half: runs in parts of :data:`PART` starts at fixed places before the anchor.

    ``core`` names what all windows of a part have in common, ``hull`` what they span together. Where the
    text ends inside the hull, that gets a name of its own.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            for k, b, ids, (start, n, off, gram, weight) in _runs_of_texts(batches, q):
                core, hull = doubled(ids, q, length - PART + 1), doubled(ids, q, length + PART - 1)
                first, last = (off - n + 1) // PART, off // PART
                count = last - first + 1
                i = np.repeat(np.arange(len(n)), count)
                part = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
                end = (start + off)[i] - PART * part  # the last start of the part
                begin = end - PART + 1
                p, stop = np.maximum(start[i], begin), np.minimum((start + n - 1)[i], end)
                whole = (begin >= 0) & (begin < len(hull))
                own = mix(end.astype(np.uint64) * GOLDEN ^ U(k & 0xFFFFFFFFFFFFFFFF))
                span = np.where(whole, hull[np.where(whole, begin, 0)], own) if len(hull) else own
                yield [gram[i], mix(core[end] + part.astype(np.uint64) * GOLDEN).view(np.int64), span.view(np.int64),
                       weight[i], k, b, p, stop - p + 1, (start + off)[i] - p]
        yield from _emit(rows(), ["gram", "core", "hull", "weight", "k", "b", "start", "n", "off"],
                         [np.int64] * 3 + [np.int32, np.int64] + [np.int32] * 4)
    return run


def _windows(length: int, q: int):
    """Step 3, second half: the single starts of the given runs, each with its bucket of ``length`` bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            for k, b, ids, (start, n, off, gram, weight) in _runs_of_texts(batches, q):
                window = doubled(ids, q, length)
                i = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                p, place = start[i] + step, (off[i] - step).astype(np.uint64)
                yield [gram[i], mix(window[p] + place * GOLDEN).view(np.int64), weight[i], k, b, p]
        yield from _emit(rows(), ["gram", "bucket", "weight", "k", "b", "p"],
                         [np.int64, np.int64, np.int32, np.int64, np.int32, np.int32])
    return run


def covered(starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Disjoint byte ranges, as rows of begin and end, that the windows from runs of starts cover."""
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order].astype(np.int64), (starts + counts - 1 + length)[order].astype(np.int64)
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([begin[first], reach[np.concatenate([first[1:] - 1, [len(end) - 1]])]], axis=1)


def whole_characters(raw: bytes, gone: np.ndarray) -> str:
    """The text without those characters all of whose bytes are gone."""
    lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, lead)
    keep = np.repeat(~whole, np.diff(lead, append=len(raw)))
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode()


def _cut(length: int):
    @F.pandas_udf("kept binary, text string, begins array<int>, ends array<int>")
    def cut(text: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s, n in zip(text, starts, counts):
            if t is None:
                rows.append((None, None, None, None))
                continue
            raw = t.encode()
            spans = covered(np.asarray(s), np.asarray(n), length)
            gone = np.zeros(len(raw) + 1, np.int8)
            gone[spans[:, 0]] += 1
            gone[spans[:, 1]] -= 1
            gone = np.cumsum(gone[:-1]).astype(bool)
            rows.append((np.frombuffer(raw, np.uint8)[~gone].tobytes(), whole_characters(raw, gone),
                         spans[:, 0].tolist(), spans[:, 1].tolist()))
        return pd.DataFrame(rows, columns=["kept", "text", "begins", "ends"])
    return cut


def repeated_runs(texts: DataFrame, length: int, q: int) -> DataFrame:
    """``k``, ``b``, ``starts`` and ``counts``: for each text with repeats the runs of its repeated starts.

    ``texts`` has a text's key in ``k`` and ``b`` and the text in ``text``; equal texts share a key, and ``tag``
    tells them apart as far as it can. Each text is looked at once, with a weight of 2 if there are copies of it:
    such a text is repeated as a whole, and only proves the repeats of others.
    """
    copies = stage(texts.groupBy("k", "b").agg(
        F.min("tag").alias("tag"), F.least(F.count("*"), F.lit(2)).cast("int").alias("weight")), "copies")
    # one row of each text; by its tag, so that the copies of one text spread over many tasks
    once = texts.join(copies, ["k", "b", "tag"]).dropDuplicates(["k", "b", "tag"])
    anchors = stage(once.select("k", "b", "text", "weight").mapInArrow(_anchors(length, q), ANCHOR), "anchors")
    buckets = anchors.groupBy("gram").agg(F.sum("weight").alias("c"), F.min("run").alias("lo"), F.max("run").alias("hi"))
    buckets = stage(buckets.where("c > 1").select("gram", (F.col("lo") == F.col("hi")).alias("same")), "buckets")
    open_runs = stage(anchors.join(buckets, "gram"), "open")
    unstage(anchors)
    # neighbours in one of many small parts of a run's bucket already prove that it is repeated; only those
    # without one there ask the counts of all
    part = Window.partitionBy("gram", "run", F.pmod(F.xxhash64("k", "start"), F.lit(SALTS)))
    mixed = stage(open_runs.where("NOT same").withColumn("near", F.sum("weight").over(part)), "mixed")
    runs = stage(mixed.groupBy("gram", "run").agg(
        F.sum("weight").alias("c"), F.min(F.struct("k", "b", "start", "n", "off")).alias("one")), "runs")
    repeated = runs.where("c > 1").select("gram", "run")
    columns = ["k", "b", "start", "n"]
    whole = copies.where("weight > 1").select("k", "b", F.lit(0).alias("start"), (F.col("b") - length + 1).alias("n")).unionByName(
        open_runs.where("same AND weight = 1").select(columns)).unionByName(
        mixed.where("near > 1 AND weight = 1").select(columns)).unionByName(
        mixed.where("near = 1").join(repeated, ["gram", "run"]).select(columns))
    lists = [F.collect_list(c).alias(c) for c in ("start", "n", "off", "gram", "weight")]
    wanted = stage(runs.select("one.*", "gram", F.least("c", F.lit(2)).cast("int").alias("weight"))
                   .groupBy("k", "b").agg(*lists), "wanted")
    one = wanted.join(copies.drop("weight"), ["k", "b"])
    some = texts.select("k", "b", "tag", "text").join(stage(one, "wanted"), ["k", "b", "tag"])
    some = stage(some.dropDuplicates(["k", "b", "tag"]).drop("tag"), "texts")
    parts = stage(some.select("k", "b", "text", "start", "n", "off", "gram", "weight").mapInArrow(_parts(length, q), PARTS), "parts")
    cores = stage(parts.groupBy("gram", "core").agg(
        F.sum("weight").alias("c"), F.min("weight").alias("w"), F.min("hull").alias("lo"), F.max("hull").alias("hi"))
        .where("c > 1 AND w = 1").select("gram", "core", (F.col("lo") == F.col("hi")).alias("same")), "cores")
    open_parts = stage(parts.join(cores, ["gram", "core"]).drop("core", "hull"), "open_parts")
    left = open_parts.where("NOT same").groupBy("k", "b").agg(*lists)
    windows = stage(some.select("k", "b", "text").join(left, ["k", "b"]).select(
        "k", "b", "text", "start", "n", "off", "gram", "weight").mapInArrow(_windows(length, q), WINDOWS), "windows")
    many = stage(windows.groupBy("gram", "bucket").agg(F.sum("weight").alias("c"), F.min("weight").alias("w"))
                 .where("c > 1 AND w = 1").select("gram", "bucket"), "many")
    single = windows.where("weight = 1").join(many, ["gram", "bucket"]).select(
        "k", "b", F.col("p").alias("start"), F.lit(1).alias("n"))
    found = whole.unionByName(open_parts.where("same AND weight = 1").select("k", "b", "start", "n")).unionByName(single)
    return stage(found.groupBy("k", "b").agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts")), "repeats")


def remove_repeats(docs: DataFrame, *, length: int = 200, q: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Documents without the bytes that a ``length``-byte string covers which also starts anywhere else.

    Strings are taken from the UTF-8 bytes of the texts as given, within one document, and count as
    repeated in the same document too, overlapping or not. Returns the id, ``n_bytes``, ``begins`` and
    ``ends`` of the removed ranges (maximal, in order), ``kept`` (the remaining bytes) and ``text``, which
    also keeps the characters that only lost a part of their bytes.

    A null text is empty. Texts shorter than ``length`` stay whole. Rows are judged by their texts, so equal or
    missing ids do no harm. Other columns are ignored. An empty table gives no rows.
    """
    return _cut_rows(docs.select(id_col, text_col), length, q, text_col).select(
        F.col("row")[id_col].alias(id_col), F.col("b").cast("long").alias("n_bytes"), "begins", "ends", "kept", "text")


def without_repeats(docs: DataFrame, *, length: int = 200, q: int = 50, text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, repeats taken out of the text (see :func:`remove_repeats`) as whole characters.

    A text of which nothing is left stays as an empty one.
    """
    row = F.col("row")
    return _cut_rows(docs, length, q, text_col).select(
        *[(F.col("text") if c == text_col else row[c]).alias(c) for c in docs.columns])


def _cut_rows(docs: DataFrame, length: int, q: int, text_col: str) -> DataFrame:
    """All rows as structs, with the key of their text and what is left of it."""
    if not 0 < q < length:
        raise ValueError("q must be shorter than the strings looked for")
    text = F.coalesce(F.col(text_col), F.lit(""))
    tags = [f.name for f in docs.schema if f.name != text_col and "map<" not in f.dataType.simpleString()]
    keyed = small_batches(docs).select(F.xxhash64(*tags).alias("tag") if tags else F.lit(0).alias("tag"), F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.lit(0).alias("\0")).alias("row"),
                        text.alias("text"), F.xxhash64(text).alias("k"), F.octet_length(text).alias("b"))
    repeats = repeated_runs(keyed.where(F.col("b") >= length), length, q)
    keyed = keyed.drop("tag")
    joined = keyed.join(repeats, ["k", "b"], "left")
    hit = F.when(F.col("starts").isNotNull(), F.col("text"))
    cut = joined.withColumn("cut", _cut(length)(hit, "starts", "counts"))
    none = F.array().cast("array<int>")
    return cut.select("row", "b", F.coalesce("cut.begins", none).alias("begins"), F.coalesce("cut.ends", none).alias("ends"),
                      F.coalesce("cut.kept", F.encode("text", "UTF-8")).alias("kept"),
                      F.coalesce("cut.text", "text").alias("text"))
