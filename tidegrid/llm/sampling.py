"""Bounded samples to learn from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.sources.stage import stage

RANGE = 1 << 40


def hashed_sample(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """At most ``limit`` of the rows, those with the smallest hashes of their ``keys``, staged.

    It is as good as random and comes out the same each time. Hashes that are far too large for the
    sample, going by the number of rows, are left out where the rows are read, so little
    is sorted at any size.
    """
    rank = F.pmod(F.xxhash64(*keys), F.lit(RANGE))
    total = rows.count()
    if total > 4 * limit:
        rows = rows.where(rank < RANGE * 4 * limit // total)
    return stage(rows.orderBy(rank, *keys).limit(limit), "sample")
