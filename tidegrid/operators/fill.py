"""Filling missing cells from fitted tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidegrid.operators.lookup import lookup_join


def _filled(df: DataFrame, joined: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return joined.select(*[
        F.coalesce(F.col(c), F.col(prefix + c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def _prefixed(lookup: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    return lookup.select(*keys, *[F.col(c).alias(prefix + c) for c in cols])


def seasonal_fill(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], cols: Sequence[str], salt: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Missing cells take the looked-up mean of their key; unknown keys stay missing. ``counted``: see ``lookup_join``."""
    joined = lookup_join(df, _prefixed(lookup, keys, cols, "__ssn_"), keys, salt, counted=counted)
    return _filled(df, joined, cols, "__ssn_")


def mode_fill(
    df: DataFrame, modes: DataFrame, keys: Sequence[str], col: str, salt: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Missing categories take the mode of their series; an unknown series stays missing. ``counted``: see ``lookup_join``."""
    joined = lookup_join(df, _prefixed(modes, keys, [col], "__mode_"), keys, salt, counted=counted)
    return _filled(df, joined, [col], "__mode_")


def fill_scalar(df: DataFrame, params: Mapping[str, Any], cols: Sequence[str]) -> DataFrame:
    """Missing cells take one global value per column (``params`` from ``one_row``)."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(params[c]).cast("double")) for c in cols
    })


def mean_fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str], means: DataFrame,
              salt: str | None = None) -> DataFrame:
    """Missing cells take the mean of their series, then the mean over all cells
    *after* that fill. ``means`` comes from :func:`fit_series_means`."""
    after = means.agg(*[
        F.try_divide(
            F.sum(F.col(c) * F.when(F.col(c).isNotNull(), F.col("__rows"))),
            F.sum(F.when(F.col(c).isNotNull(), F.col("__rows"))),
        ).alias(c)
        for c in cols
    ]).first()
    by_series = seasonal_fill(df, means, keys, cols, salt)
    return fill_scalar(by_series, after.asDict(), cols)


def fit_series_means(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean per series and the row count that gives it its weight in the overall mean.

    After the series fill, all rows of a series with any value are filled, and their
    average is the series mean: the overall mean follows without a second pass.
    """
    return df.groupBy(*keys).agg(
        *[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("__rows")
    )
