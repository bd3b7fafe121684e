"""Scalar steps around normalisation and prediction values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def zscore(x: Column, mean: Column, std: Column) -> Column:
    """NULL where the spread is zero or unknown."""
    return F.try_divide(x - mean, std)


def inverse_scale(p: Column, mean: Column, std: Column) -> Column:
    return p * std + mean


def clip_lower(x: Column, bound: float = 0.0) -> Column:
    """``x`` bounded below; NULL stays NULL."""
    return F.when(x < bound, F.lit(float(bound))).otherwise(x)


def fill_residual(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """What no earlier step could fill becomes ``value`` (a NaN counts as missing)."""
    return df.fillna(value, subset=list(cols))


def null_if_nan(x: Column) -> Column:
    """NULL is the only missing marker in a panel: Spark aggregates propagate NaN."""
    return F.nanvl(x, F.lit(None).cast("double"))


def feature_array(manifest: Sequence[str], fill: float | None = None) -> Column:
    """The features of one step, in manifest order, as float32; ``fill`` replaces missing ones."""
    cells = [F.col(f"`{c}`").cast("float") for c in manifest]
    if fill is not None:
        cells = [F.coalesce(c, F.lit(fill).cast("float")) for c in cells]
    return F.array(*cells)


def feature_frame(df: DataFrame, manifest: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[F.col(f"`{c}`").cast("float").alias(c) for c in manifest])
