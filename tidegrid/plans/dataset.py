"""Window data sets of the pipeline variants, with their feature manifests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame

from tidegrid.functions.calendar import calendar_features, day_of_week_features, is_weekend
from tidegrid.functions.encoding import one_hot, one_hot_names
from tidegrid.operators.strided import score_blocks_with
from tidegrid.operators.windows import (
    last_step_pairs, series_lengths, sliding_windows, split_by_fraction,
)
from tidegrid.plans.spec import PanelSpec, long_window_features
from tidegrid.sources.stage import stage

CALENDAR = ["hour_sin", "hour_cos", "month_sin", "month_cos"]
WEEKDAY = ["dow_sin", "dow_cos"]


@dataclass(frozen=True)
class Manifest:
    """Feature order, series vocabulary and window length, stored next to the windows."""

    features: list[str]
    vocab: list[str]
    window: int

    def to_dict(self) -> dict:
        return asdict(self)


def manifest_short(spec: PanelSpec, vocab: Sequence[str]) -> Manifest:
    """24 steps: measures, wind, hour and month, series indicators."""
    names = [*spec.norms, *spec.wind_features, *CALENDAR, *one_hot_names(vocab)]
    return Manifest(names, sorted(vocab), spec.window)


def manifest_long(spec: PanelSpec, vocab: Sequence[str], window: int = 48) -> Manifest:
    """48 steps: as above plus weekday, weekend flag and the target's lag features."""
    names = [*spec.norms, *spec.wind_features, *CALENDAR, *WEEKDAY, "is_weekend"]
    names += [*long_window_features(spec.target_norm, spec.target), *one_hot_names(vocab)]
    return Manifest(names, sorted(vocab), window)


def manifest_all_rows(spec: PanelSpec, vocab: Sequence[str]) -> Manifest:
    """24 steps of the all-rows variants: weekday and raw-unit rolling features included."""
    names = [*spec.norms, *spec.wind_features, *CALENDAR, *WEEKDAY]
    names += [*[f"{c}_norm" for c in spec.rolling], *one_hot_names(vocab)]
    return Manifest(names, sorted(vocab), spec.window)


def with_encodings(clean: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Add the calendar and series features that the manifest names."""
    wanted = {
        **calendar_features(spec.t), **day_of_week_features(spec.t),
        "is_weekend": is_weekend(spec.t), **one_hot(spec.series, manifest.vocab),
    }
    return clean.withColumns({n: e for n, e in wanted.items() if n in manifest.features})


def short_windows(clean: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Tensors of the 24-step variant from a clean panel with a ``split`` column."""
    return sliding_windows(
        with_encodings(clean, spec, manifest), ["split", spec.series], spec.pos, spec.t,
        manifest.features, manifest.window, spec.target_norm, spec.target, dense=spec.dense,
    )


def long_windows(clean: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Tensors of the 48-step variant; lag features and windows share one exchange.

    Features restart with each split, so validation starts cold. A feature that is
    still missing becomes 0.
    """
    features = long_window_features(spec.target_norm, spec.target)
    return sliding_windows(
        with_encodings(clean, spec, manifest), ["split", spec.series], spec.pos, spec.t,
        manifest.features, manifest.window, spec.target_norm, spec.target, features=features, fill=0.0,
        dense=spec.dense,
    )


def short_pairs(clean: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Targets with their last input step, for the baselines."""
    return last_step_pairs(
        with_encodings(clean, spec, manifest), ["split", spec.series], spec.pos, spec.t,
        manifest.features, manifest.window, spec.target_norm, spec.target, dense=spec.dense,
    )


def _request_features(spec: PanelSpec, manifest: Manifest) -> dict[str, tuple[str, str, int]]:
    lagged = long_window_features(spec.target_norm, spec.target)
    return {n: f for n, f in lagged.items() if n in manifest.features}


def request_windows(clean: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Tensors of either train-fitted variant for scoring: rows of one split, and 0 for
    what no step could fill (an unknown wind direction, for one)."""
    return sliding_windows(
        with_encodings(clean, spec, manifest), [spec.series], spec.pos, spec.t,
        manifest.features, manifest.window, spec.target_norm, spec.target,
        features=_request_features(spec, manifest), fill=0.0, dense=spec.dense,
    )


def request_scores(
    clean: DataFrame, spec: PanelSpec, manifest: Manifest, predict: Callable[[np.ndarray], Sequence[float]]
) -> DataFrame:
    """``(series, target_dt, pred)`` by a function over the same windows, without writing out the tensors."""
    return score_blocks_with(
        with_encodings(clean, spec, manifest), [spec.series], spec.pos, spec.t, manifest.features, manifest.window,
        predict, features=_request_features(spec, manifest), fill=0.0, dense=spec.dense,
    ).drop("target_pos")


def all_rows_windows(prepared: DataFrame, spec: PanelSpec, manifest: Manifest) -> DataFrame:
    """Tensors of the all-rows variants: split by target position, which the rows carry
    into the windows; validation inputs may reach back into train."""
    lengths = stage(series_lengths(prepared, [spec.series]), "lengths")
    marked = split_by_fraction(prepared, [spec.series], spec.pos, lengths, spec.val_fraction)
    return sliding_windows(
        with_encodings(marked, spec, manifest), [spec.series], spec.pos, spec.t, manifest.features,
        manifest.window, spec.target_norm, spec.target, keep=["split"], dense=spec.dense,
    )
