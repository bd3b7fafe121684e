"""Fitted tables: one aggregation each, small results.

Which rows a fit sees is the caller's choice: pass ``df.where("split = 'train'")``
for train-only statistics, or the whole panel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidegrid.operators.quantiles import exact_quantiles


def fit_seasonal(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean per key, e.g. ``(series, month, hour)``; missing cells are skipped."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def fit_mode(df: DataFrame, keys: Sequence[str], col: str, default: str = "N") -> DataFrame:
    """Most frequent value per key, the smallest on ties, ``default`` if all are missing.

    Counting per value first keeps a hot key to one row per distinct value.
    """
    counts = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    rank = F.when(F.col(col).isNotNull(), F.struct((-F.col("__n")).alias("n"), F.col(col).alias("v")))
    return counts.groupBy(*keys).agg(F.coalesce(F.min(rank)["v"], F.lit(default)).alias(col))


def fit_seasons(df: DataFrame, keys: Sequence[str], cols: Sequence[str], series: str, mode: str | None = None) -> DataFrame:
    """What all train fits of a panel need, in one scan: moments of the measures per season key, counts of ``mode`` values per series.

    Grouping sets give rows of two kinds, told apart by ``__kind``: per ``keys`` the ``__rows`` and for each
    column its mean, its values ``<c>_n`` and their squared deviations ``<c>_m2``; per series and value of ``mode`` the ``__rows``.
    """
    sets = [list(keys)] + ([[series, mode]] if mode else [])
    columns = list(dict.fromkeys([*keys, *([mode] if mode else [])]))
    moments = [f for c in cols for f in (F.avg(c).alias(c), F.count(c).alias(f"{c}_n"), (F.var_pop(c) * F.count(c)).alias(f"{c}_m2"))]
    return df.groupingSets(sets, *columns).agg(
        (F.grouping(mode) if mode else F.lit(1)).alias("__kind"), F.count(F.lit(1)).alias("__rows"), *moments)


def seasonal_of(seasons: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The table of :func:`fit_seasonal` out of :func:`fit_seasons`."""
    return seasons.where("__kind = 1").select(*keys, *cols)


def modes_of(seasons: DataFrame, series: str, mode: str, default: str = "N") -> DataFrame:
    """The table of :func:`fit_mode` out of :func:`fit_seasons`."""
    rank = F.when(F.col(mode).isNotNull(), F.struct((-F.col("__rows")).alias("n"), F.col(mode).alias("v")))
    return seasons.where("__kind = 0").groupBy(series).agg(F.coalesce(F.min(rank)["v"], F.lit(default)).alias(mode))


def scaler_after_fills(seasons: DataFrame, cols: Sequence[str], fills: Mapping[str, Any]) -> DataFrame:
    """The row of :func:`fit_scaler` for rows whose missing cells took their season's mean, or ``fills`` where it has none.

    A cell filled with its season's mean moves neither the mean nor the squared deviations of the season, so both
    follow from the seasons alone, taken around ``fills`` so that nothing large cancels out.
    """
    rows = F.col("__rows")
    total, aggs = F.sum(rows), []
    for c in cols:
        around = F.lit(fills[c]).cast("double")
        off = F.coalesce(F.col(c) - around, F.lit(0.0))
        shift = F.sum(rows * off) / total
        squares = F.sum(F.coalesce(f"{c}_m2", F.lit(0.0)) + rows * off * off) - shift * shift * total
        aggs += [(around + shift).alias(f"{c}_mean"),
                 F.when(total > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (total - 1))).alias(f"{c}_std")]
    return seasons.where("__kind = 1").agg(*aggs)


def fit_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact medians, one row."""
    q = exact_quantiles(df, cols, [0.5])
    return q.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in cols])


def _moments(cols: Sequence[str], mean: str, std: str, eps: float):
    for c in cols:
        yield F.avg(c).alias(c + mean)
        yield (F.stddev_samp(c) + F.lit(eps) if eps else F.stddev_samp(c)).alias(c + std)


def fit_scaler(df: DataFrame, cols: Sequence[str], eps: float = 0.0) -> DataFrame:
    """Mean and sample deviation (plus ``eps``) per column: one row ``<c>_mean, <c>_std``."""
    return df.agg(*_moments(cols, "_mean", "_std", eps))


def fit_scaler_all(df: DataFrame, cols: Sequence[str], eps: float = 1e-8) -> DataFrame:
    return fit_scaler(df, cols, eps)


def fit_scaler_by_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str], eps: float = 1e-8) -> DataFrame:
    """Per key: ``<c>_mu, <c>_sigma``."""
    return df.groupBy(*keys).agg(*_moments(cols, "_mu", "_sigma", eps))


def scaler_long(fitted: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                mean: str = "_mean", std: str = "_std") -> DataFrame:
    """The same parameters as rows ``(keys, column, mean, std)``."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c + mean).alias("mean"), F.col(c + std).alias("std"))
        for c in cols
    ])
    return fitted.select(*keys, F.inline(entries))
