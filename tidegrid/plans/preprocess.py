"""Cleaning a panel: fitted on a training split (fit/apply), or on all rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.calendar import (
    calendar_features, day_of_week_features, split_at, with_calendar_parts,
)
from tidegrid.functions.encoding import wind_features
from tidegrid.operators.fill import (
    fill_scalar, fit_series_means, mean_fill, mode_fill, seasonal_fill,
)
from tidegrid.operators.fit import (
    fit_median, fit_mode, fit_scaler_all, fit_scaler_by_key, fit_seasons, modes_of, scaler_after_fills, seasonal_of,
)
from tidegrid.operators.interpolate import interpolate
from tidegrid.operators.rolling import rolling_features
from tidegrid.operators.scale import apply_scaler, apply_scaler_by_key
from tidegrid.plans.spec import PanelSpec
from tidegrid.sources.stage import one_row, stage

TIER = "_tier"  # 0 observed, 1 interpolated, 2 seasonal mean, 3 median; NULL still missing


@dataclass
class Fitted:
    """Everything learned from the training split: two small tables, two rows of numbers."""

    seasonal: DataFrame
    modes: DataFrame | None
    medians: dict[str, Any]
    scaler: dict[str, Any]


def _interpolated(df: DataFrame, spec: PanelSpec, keys: list[str]) -> DataFrame:
    filled = interpolate(
        df, keys, spec.pos, spec.measures, spec.limit, flag_suffix="__i", longest=spec.longest
    )
    tiers = [
        F.when(F.col(f"{c}__i"), 1).when(F.col(c).isNotNull(), 0).alias(c + TIER)
        for c in spec.measures
    ]
    return filled.select(*df.columns, *tiers)


def _tiered(df: DataFrame, spec: PanelSpec, tier: int) -> DataFrame:
    return df.withColumns({
        c + TIER: F.coalesce(F.col(c + TIER), F.when(F.col(c).isNotNull(), tier))
        for c in spec.measures
    })


def preprocess_fit(panel: DataFrame, spec: PanelSpec) -> tuple[DataFrame, Fitted]:
    """Split, fill in three tiers, encode and normalise; all fits see ``train`` only.

    The order matters: seasonal means include interpolated cells, medians come
    after the seasonal fill, and mean and deviation after all fills. One scan of the interpolated
    panel gives seasonal moments and wind counts; mean and deviation after the fills follow from those, so only
    medians look at filled cells. Two tables are written: the interpolated panel, in which lookups also count their keys,
    and the filled cells of ``train``.
    """
    keys = ["split", spec.series]
    df = with_calendar_parts(split_at(panel, spec.cutoff, spec.t), spec.t)
    df = stage(_interpolated(df, spec, keys), "interpolated", ["split"])
    train, season = df.where(F.col("split") == "train"), [spec.series, *spec.season]
    seasons = stage(fit_seasons(train, season, spec.measures, spec.series, spec.wind), "seasons")
    seasonal = seasonal_of(seasons, season, spec.measures)
    modes = stage(modes_of(seasons, spec.series, spec.wind), "modes") if spec.wind else None
    cells = seasonal_fill(train, seasonal, season, spec.measures, salt=spec.pos, counted=train).select(*spec.measures)
    medians = one_row(fit_median(stage(cells, "filled_cells"), spec.measures))
    scaler = one_row(scaler_after_fills(seasons, spec.measures, medians))
    fitted = Fitted(seasonal, modes, medians, scaler)
    return _applied(df, fitted, spec, counted=df), fitted


def _applied(interpolated: DataFrame, fitted: Fitted, spec: PanelSpec, counted: DataFrame | None = None) -> DataFrame:
    """From interpolated rows to clean ones with stored parameters; ``counted`` are the same rows where they are stored."""
    df = seasonal_fill(interpolated, fitted.seasonal, [spec.series, *spec.season], spec.measures, salt=spec.pos, counted=counted)
    df = _tiered(df, spec, 2)
    df = _tiered(fill_scalar(df, fitted.medians, spec.measures), spec, 3)
    if spec.wind:
        df = mode_fill(df, fitted.modes, [spec.series], spec.wind, salt=spec.pos, counted=counted)
        df = df.withColumns(wind_features(spec.wind))
    return apply_scaler(df, fitted.scaler, spec.measures)


def preprocess_apply(panel: DataFrame, fitted: Fitted, spec: PanelSpec) -> DataFrame:
    """The same steps with stored parameters on rows of one split; nothing is fitted."""
    df = with_calendar_parts(panel, spec.t)
    return _applied(_interpolated(df, spec, [spec.series]), fitted, spec)


@dataclass
class FittedOnAll:
    """Parameters of the all-rows variants: one row of numbers, or one row per series."""

    scaler: dict[str, Any] | None
    scaler_by_series: DataFrame | None


def prepare_all_rows(
    panel: DataFrame, spec: PanelSpec, per_series: bool
) -> tuple[DataFrame, FittedOnAll]:
    """Fill without a cap, derive raw-unit rolling features, then normalise; fits see all rows.

    ``per_series`` picks the normalisation: each series by its own mean and
    deviation, or all by the global ones. Unknown wind directions count as north.
    """
    keys = [spec.series]
    df = interpolate(panel, keys, spec.pos, spec.measures, limit=None, longest=spec.longest)
    filled = stage(df, "interpolated")
    means = stage(fit_series_means(filled, keys, spec.measures), "means")
    df = mean_fill(filled, keys, spec.measures, means, salt=spec.pos)
    if spec.wind:
        modes = stage(fit_mode(filled, keys, spec.wind), "modes")
        df = mode_fill(df, modes, keys, spec.wind, salt=spec.pos)
        df = df.withColumns(wind_features(spec.wind, default=0.0))
    df = df.withColumns({**calendar_features(spec.t), **day_of_week_features(spec.t)})
    df = stage(rolling_features(df, keys, spec.pos, spec.rolling, dense=spec.dense), "features")
    cols = [*spec.measures, *spec.rolling]
    if per_series:
        fits = stage(fit_scaler_by_key(df, keys, cols), "scaler")
        return apply_scaler_by_key(df, fits, keys, cols, salt=spec.pos), FittedOnAll(None, fits)
    params = one_row(fit_scaler_all(df, cols))
    return apply_scaler(df, params, cols), FittedOnAll(params, None)
