"""Joining a panel to fitted tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.operators.shares import bounded_shares
from tidegrid.sources.stage import stage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 1 << 20
HOT_ROWS = 4_000_000
SALTS = 64


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    salt: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join of a large panel to a fitted table with one row per ``keys``.

    The table is broadcast when Spark knows it to be small (stage it first, then its files
    say so and no job runs), or else when it is counted and has at most ``broadcast_rows`` rows. A larger one is joined by
    shuffle, with hot keys spread over ``salts`` tasks; ``salt`` names the column
    that decides which (its hash; all columns if not given). ``counted`` is a stored table in which each key has as many
    rows as in ``df``, such as the one that ``df`` is derived from: hot keys are then counted there, and ``df`` is not written.
    """
    if broadcast_rows and known_bytes(lookup) <= BROADCAST_BYTES or lookup.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return df.join(F.broadcast(lookup), list(keys), "left")
    return _salted_join(df, lookup, list(keys), salt, hot_rows, salts, counted)


def known_bytes(df: DataFrame) -> int:
    """The size that Spark plans with, from files or literals; very large where it cannot know."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _salted_join(
    df: DataFrame, lookup: DataFrame, keys: list[str], salt: str | None, hot_rows: int, salts: int,
    counted: DataFrame | None,
) -> DataFrame:
    """Shuffle join in which a key with more than ``hot_rows`` rows is split.

    Only the lookup rows of hot keys are repeated, once per salt. The panel is written first, as
    the count and the join both read it, unless keys are ``counted`` elsewhere. There are at most ``rows / hot_rows`` hot keys;
    their list is joined by its measured size.
    """
    df = bounded_shares(df)
    if counted is None:
        df = counted = stage(df, "lookup_rows")
    hot = (
        counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > hot_rows).select(*keys, F.lit(True).alias("__hot"))
    )
    hot = stage(hot, "hot_keys")
    part = F.pmod(F.hash(*([salt] if salt else df.columns)), F.lit(salts))
    left = df.join(hot, keys, "left").withColumn(
        "__salt", F.when(F.col("__hot"), part).otherwise(F.lit(0))
    )
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.join(hot, keys, "left").withColumn("__salt", F.explode(copies)).drop("__hot")
    joined = left.join(right, [*keys, "__salt"], "left")
    return joined.select(*df.columns, *[c for c in lookup.columns if c not in keys])
