"""Exact duplicates by counting quotient filters.

Every text, A-Z lowered, has a fingerprint: the first bits of its SHA-256. Each task puts the fingerprints
of the rows it reads into counting quotient filters, one for each segment of the fingerprints; the filters
of a segment meet in one task and merge in order. Only texts whose fingerprint has a count above one
are sent anywhere: they are grouped by all their bytes, combined map-side, and a row finds its
group by fingerprint and digest. The counts say beforehand which groups are large, and joins
spread the rows of those.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.quotient_filter import QuotientFilter, merged, summed
from tidegrid.llm.text_bytes import byte_rows
from tidegrid.sources.stage import stage

BITS = 63
Batches = Iterable[pa.RecordBatch]


def _digests(texts: pa.Array) -> list[bytes]:
    data, at = byte_rows(texts)
    whole = memoryview(data)
    return [hashlib.sha256(whole[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _prints(digests: Sequence[bytes], bits: int) -> np.ndarray:
    return (np.frombuffer(b"".join(digests), ">u8")[::4] >> np.uint64(64 - bits)).astype(np.int64)


def text_prints(docs: DataFrame, id_col: str, text_col: str, bits: int = BITS, texts: bool = False) -> DataFrame:
    """``__id``, ``__print`` and, of each text with A-Z lowered, the ``__sha256`` or the text itself (``__text``)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.ascii_lower(batch.column(1).fill_null(""))
            digests = _digests(lowered)
            last = lowered if texts else pa.array(digests, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_prints(digests, bits)), last], ["__id", "__print", last_name])

    last_name, last_type = ("__text", "string") if texts else ("__sha256", "binary")
    return small_batches(docs).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(
        run, f"__id {id_type}, __print long, {last_name} {last_type}")


def segment_bits_of(docs: DataFrame) -> int:
    """Bits that give four segments a shuffle partition, so that each task merges an even share."""
    return (4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


def counting_filters(prints: DataFrame, segment_bits: int, bits: int = BITS, buffer: int = 4_000_000) -> DataFrame:
    """Filters ``(segment, filter)`` of the column ``__print``, from each task's rows, ``buffer`` fingerprints at a time.

    A segment holds the fingerprints with the same first ``segment_bits``; filters hold the other bits.
    Filters of several tables may be put together before they are merged. No rows give no filters.
    """
    low = bits - segment_bits

    def filters(found: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        segment = found >> low
        cuts = np.flatnonzero(np.diff(segment, prepend=-1)).tolist()
        made = [QuotientFilter.of(found[a:b] & ((1 << low) - 1), counts[a:b], low).to_bytes()
                for a, b in zip(cuts, [*cuts[1:], len(found)])]
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[cuts], pa.int32()), pa.array(made, pa.binary())], ["segment", "filter"])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= buffer:
                yield filters(*np.unique(np.concatenate(held), return_counts=True))
                held = []
        if held:
            yield filters(*np.unique(np.concatenate(held), return_counts=True))

    return prints.select("__print").mapInArrow(run, "segment int, filter binary")


def _by_segment(batches: Batches) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each segment's fingerprints and counts, from filters in the order of their segments."""
    now, held, size = None, [], 0
    for batch in batches:
        for segment, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if segment != now and held:
                yield now, *merged(held)
                held, size = [], 0
            now = segment
            held.append(QuotientFilter.from_bytes(data).items())
            size += len(held[-1][0])
            if size > 2 * max(len(held[0][0]), 100_000):  # a merge each time the rest has caught up with what is merged
                held = [merged(held)]
                size = len(held[0][0])
    if held:
        yield now, *merged(held)


def merge_filters(filters: DataFrame, segment_bits: int, bits: int = BITS) -> DataFrame:
    """One filter a segment, ``(segment, filter)``, with the sums of all counts."""
    low = bits - segment_bits

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for segment, prints, counts in _by_segment(batches):
            data = QuotientFilter.of(prints, counts, low).to_bytes()
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([data], pa.binary())], ["segment", "filter"])

    return filters.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment int, filter binary")


def repeated_prints(filters: DataFrame, segment_bits: int, bits: int = BITS) -> DataFrame:
    """``__print`` and ``__n`` of all fingerprints with a count above one, from merged filters."""
    low = bits - segment_bits

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prints, counts = QuotientFilter.from_bytes(data).items()
                again = counts > 1
                found = prints[again].astype(np.int64) | (segment << low)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[again])], ["__print", "__n"])

    return filters.mapInArrow(run, "__print long, __n long")


def counted_join(rows: DataFrame, counted: DataFrame, keys: Sequence[str], how: str, broadcast_rows: int, hot_rows: int) -> DataFrame:
    """Join to a staged table with one row per ``keys`` that holds how many ``rows`` each has, ``__n``.

    Up to ``broadcast_rows`` rows are broadcast. A longer table is shuffled, and keys of more than ``hot_rows``
    rows are cut into parts by a hash of ``__id``; there are at most (all rows / ``hot_rows``) such keys.
    """
    keys = list(keys)
    if counted.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(counted), keys, how)
    hot = counted.where(F.col("__n") > hot_rows).select(*keys, F.ceil(F.col("__n") / hot_rows).alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    spread = rows.join(F.broadcast(hot), keys, "left").withColumn("__part", F.pmod(F.xxhash64("__id"), parts)).drop("__parts")
    copies = F.greatest(F.ceil(F.col("__n") / hot_rows), F.lit(1))
    each = counted.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    return spread.join(each, [*keys, "__part"], how).drop("__part")


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
                     broadcast_rows: int = 200_000, hot_rows: int = 1_000_000) -> DataFrame:
    """For every row the id that stays of its group of equal texts.

    Texts are equal when all their bytes are after A-Z are lowered; other letters count as they are. The largest
    id of a group stays. One row per row comes back: the id, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` (lower-case hex, of the lowered text).

    Null counts as the empty text, and empty texts equal each other. Rows that share id and text all have the same
    answer. A row without an id is kept only where no row of its group has one; ``keep_id`` is null
    there. Texts are hashed and compared whole, at any length. An empty table gives no rows, and other
    columns are ignored. ``bits`` is the length of fingerprints, up to 63; shorter ones route more texts and change no result.
    """
    prints = stage(text_prints(docs, id_col, text_col, bits), "prints")
    segment_bits = min(segment_bits_of(docs), bits - 1)
    filters = merge_filters(counting_filters(prints, segment_bits, bits), segment_bits, bits)
    repeated = stage(repeated_prints(filters, segment_bits, bits), "repeated")
    texts = text_prints(docs, id_col, text_col, bits, texts=True)
    routed = counted_join(texts, repeated, ["__print"], "left_semi", broadcast_rows, hot_rows)
    groups = routed.groupBy("__print", "__text").agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    groups = stage(groups.where("__n > 1").select(
        "__print", F.unhex(F.sha2("__text", 256)).alias("__sha256"), "__keep", "__n"), "groups")
    found = counted_join(prints, groups, ["__print", "__sha256"], "left", broadcast_rows, hot_rows)
    keep = F.when(F.col("__n").isNull(), F.col("__id")).otherwise(F.col("__keep"))
    return found.select(
        F.col("__id").alias(id_col), keep.alias("keep_id"), F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("__sha256")).alias("text_sha256"))
