"""Sliding windows with next-step targets, and the splits and baselines over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.scaling import feature_array
from tidegrid.operators.blocks import BLOCK_ROWS, over_blocks
from tidegrid.operators.lookup import lookup_join
from tidegrid.operators.rolling import feature_columns, reach


def _narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, each once: halos hold whole rows."""
    return df.select(*dict.fromkeys(columns))


def sliding_windows(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    t: str,
    manifest: Sequence[str],
    window: int,
    target_norm: str,
    target_raw: str,
    keep: Sequence[str] = (),
    features: Mapping[str, tuple[str, str, int]] | None = None,
    fill: float | None = None,
    size: int = BLOCK_ROWS,
    dense: bool = False,
) -> DataFrame:
    """One row per target: ``x`` holds the ``window`` rows before it, oldest first.

    Windows never cross ``keys`` (add the split there to keep splits apart), and a
    series gives as many windows as it has rows beyond the first ``window``.
    ``features`` are row-frame features computed in the same pass: the halo then
    covers both frames, so tensors and their lag features cost one exchange.
    ``fill`` replaces missing feature cells inside the windows. ``dense``: see ``over_blocks``.
    """
    features = features or {}
    sources = [c for c, _, _ in features.values()]
    df = _narrow(df, [*keys, *keep, pos, t, target_norm, target_raw, *sources, *[c for c in manifest if c not in features]])

    def build(d, w):
        d = d.select("*", *feature_columns(features, w)) if features else d
        d = d.withColumn("__row", feature_array(manifest, fill))
        x = F.collect_list("__row").over(w.rowsBetween(-window, -1))
        return d.withColumn("x", x)

    tensors = over_blocks(df, keys, pos, window + reach(features), build, size, dense)
    return tensors.where(F.size("x") == window).select(
        *keys, *keep, F.col(pos).alias("target_pos"), F.col(t).alias("target_dt"), "x",
        F.col(target_norm).cast("float").alias("y_norm"),
        F.col(target_raw).cast("float").alias("y_raw"),
    )


def last_step_pairs(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    t: str,
    manifest: Sequence[str],
    window: int,
    target_norm: str,
    target_raw: str,
    keep: Sequence[str] = (),
    fill: float | None = None,
    size: int = BLOCK_ROWS,
    dense: bool = False,
) -> DataFrame:
    """The windows' targets with only their last step ``x_last``: what persistence and
    linear models read, without building ``window`` times the data."""
    df = _narrow(df, [*keys, *keep, pos, t, target_norm, target_raw, *manifest])

    def build(d, w):
        d = d.withColumn("__row", feature_array(manifest, fill))
        return d.withColumns({
            "x_last": F.lag("__row", 1).over(w),
            "__full": F.lag(pos, window).over(w).isNotNull(),
        })

    return over_blocks(df, keys, pos, window, build, size, dense).where("__full").select(
        *keys, *keep, F.col(pos).alias("target_pos"), F.col(t).alias("target_dt"), "x_last",
        F.col(target_norm).cast("float").alias("y_norm"),
        F.col(target_raw).cast("float").alias("y_raw"),
    )


def series_lengths(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__length"))


def split_by_fraction(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    lengths: DataFrame,
    val_fraction: float = 0.15,
    name: str = "split",
) -> DataFrame:
    """The last part of each series is ``val``, by position of the (target) row.

    ``lengths`` holds the rows per series, from :func:`series_lengths` of the panel.
    """
    start = F.floor(F.col("__length") * F.lit(1.0 - val_fraction))
    joined = lookup_join(df, lengths, keys, salt=pos)
    return joined.select(
        *df.columns, F.when(F.col(pos) >= start, "val").otherwise("train").alias(name)
    )


def persistence(
    df: DataFrame, keys: Sequence[str], pos: str, y: str, name: str = "pred", size: int = BLOCK_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Predict each row by the row before it; a series' first row has no prediction."""
    return over_blocks(
        df, keys, pos, 1, lambda d, w: d.withColumn(name, F.lag(y, 1).over(w)), size, dense
    )
