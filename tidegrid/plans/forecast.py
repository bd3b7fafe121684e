"""Forecasting jobs built from the operators: baseline scores, scoring requests, fitted blends."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.calendar import with_calendar_parts
from tidegrid.functions.errors import rmse
from tidegrid.operators.fill import fill_scalar, seasonal_fill
from tidegrid.operators.fit import fit_median, fit_seasonal
from tidegrid.operators.interpolate import interpolate
from tidegrid.operators.ridge import RidgeModel, ridge_fit
from tidegrid.operators.score import finish_predictions, match_predictions
from tidegrid.operators.windows import last_step_pairs, persistence
from tidegrid.plans.dataset import Manifest, request_scores, with_encodings
from tidegrid.plans.preprocess import Fitted, preprocess_apply
from tidegrid.plans.spec import PanelSpec
from tidegrid.sources.stage import one_row, stage


def flagship_scores(
    panel: DataFrame, keys: Sequence[str], pos: str, t: str, y: str, limit: int = 6
) -> DataFrame:
    """Per series: cells, how many were observed and interpolated, moments after all
    fills, and the error of predicting each cell by the one before it."""
    seen = with_calendar_parts(panel.select(*keys, pos, t, y, F.col(y).alias("__seen")), t)
    df = interpolate(seen, keys, pos, [y], limit).withColumn("__interpolated", F.col(y))
    df = stage(df, "interpolated")
    season = [*keys, "month", "hour"]
    seasonal = stage(fit_seasonal(df, season, [y]), "seasonal")
    df = stage(seasonal_fill(df, seasonal, season, [y], salt=pos), "season_filled")
    df = fill_scalar(df, one_row(fit_median(df, [y])), [y])
    scored = persistence(df, keys, pos, y, "__pred")
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cells"), F.count("__seen").alias("observed"),
        F.count("__interpolated").alias("after_interpolation"),
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), rmse(y, "__pred").alias("rmse"),
    )


def _answered(ids: DataFrame, preds: DataFrame, fitted: Fitted, spec: PanelSpec) -> DataFrame:
    """Un-normalised predictions, bounded at 0; without one, the training mean."""
    mean, std = fitted.scaler[f"{spec.target}_mean"], fitted.scaler[f"{spec.target}_std"]
    done = finish_predictions(preds, mean, std)
    return match_predictions(ids, done, [spec.series, "target_dt"], fallback=mean)


def score_requests(
    ids: DataFrame, rows: DataFrame, fitted: Fitted, spec: PanelSpec, manifest: Manifest,
    model: RidgeModel,
) -> DataFrame:
    """Answer ``(id, series, target_dt)`` requests from raw rows with stored parameters.

    A linear model reads the last step only, so no tensors are built. A request
    without a full window before it gets the training mean.
    """
    clean = with_encodings(preprocess_apply(rows, fitted, spec), spec, manifest)
    pairs = last_step_pairs(
        clean, [spec.series], spec.pos, spec.t, manifest.features, manifest.window,
        spec.target_norm, spec.target, fill=0.0, dense=spec.dense,
    )
    return _answered(ids, pairs.withColumn("pred", model.predict("x_last")), fitted, spec)


def score_requests_with(
    ids: DataFrame, rows: DataFrame, fitted: Fitted, spec: PanelSpec, manifest: Manifest,
    predict: Callable[[np.ndarray], Sequence[float]],
) -> DataFrame:
    """The same with a user's function over batches of whole windows, which are read as views of the rows."""
    preds = request_scores(preprocess_apply(rows, fitted, spec), spec, manifest, predict)
    return _answered(ids, preds, fitted, spec)


def fit_blend_weights(df: DataFrame, preds: Sequence[str], y: str, alpha: float = 0.0) -> DataFrame:
    """Linear weights for several prediction columns, fitted on validation rows: one row."""
    rows = df.select(F.array(*[F.col(p).cast("double") for p in preds]).alias("x"), F.col(y).alias("y"))
    model = ridge_fit(rows, "x", "y", alpha)
    named = dict(zip([*preds, "intercept"], [*model.weights, model.intercept]))
    return df.sparkSession.createDataFrame([named], ", ".join(f"`{n}` double" for n in named))
