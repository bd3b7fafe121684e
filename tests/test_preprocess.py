"""Fit/apply separation of the cleaning step, and the all-rows variants."""

from __future__ import annotations

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import fill, lookup
from tidegrid.operators.summaries import null_counts, scaler_check
from tidegrid.plans.dataset import (
    all_rows_windows, long_windows, manifest_all_rows, manifest_long, manifest_short, short_pairs,
    short_windows,
)
from tidegrid.plans.preprocess import TIER, prepare_all_rows, preprocess_apply, preprocess_fit
from tidegrid.plans.spec import AIR_QUALITY, PanelSpec, raw_rolling_features
from tidegrid.sources.params import load_fitted, save_fitted

SPEC = PanelSpec(
    measures=("m1", "m2"), target="m1", wind="wd", cutoff="2024-01-05 00:00:00",
    rolling=raw_rolling_features("m1", ("m2",)),
)
HOURS = 150


def make(spark, change=None):
    rng = random.Random(11)
    rows = []
    for s in ("a", "b", "c"):
        for i in range(HOURS):
            m1 = None if 30 < i < 60 or rng.random() < 0.3 else rng.uniform(0, 100)
            m2 = None if rng.random() < 0.5 else rng.gauss(5, 2)
            wd = rng.choice(["N", "E", "SW", "odd", None])
            if change and i >= change[0]:
                m1 = change[1]
            rows.append((s, i, m1, m2, wd))
    df = spark.createDataFrame(rows, "series string, pos long, m1 double, m2 double, wd string")
    return df.selectExpr("*", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' HOUR * pos AS t")


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted(map(str, df.select(*sorted(cols)).collect()))


@pytest.fixture(scope="module")
def fitted(spark):
    clean, fits = preprocess_fit(make(spark), SPEC)
    return clean.cache(), fits


def test_nothing_is_missing_and_train_is_standard(fitted):
    clean, _ = fitted
    assert {r["missing"] for r in null_counts(clean, ["m1", "m2"]).collect()} == {0}
    check = {r["split"]: r for r in scaler_check(clean, SPEC.norms).collect()}
    for c in SPEC.norms:
        assert check["train"][f"{c}_mean"] == pytest.approx(0, abs=1e-9)
        assert check["train"][f"{c}_std"] == pytest.approx(1, abs=1e-9)
    assert abs(check["val"]["m2_norm_std"] - 1) > 1e-6


def test_changing_validation_changes_nothing_fitted(spark, fitted):
    clean, fits = fitted
    other, other_fits = preprocess_fit(make(spark, change=(96, 1e6)), SPEC)
    assert other_fits.medians == fits.medians and other_fits.scaler == fits.scaler
    assert rows_of(other_fits.seasonal) == rows_of(fits.seasonal)
    assert rows_of(other_fits.modes) == rows_of(fits.modes)
    assert rows_of(other.where("split = 'train'")) == rows_of(clean.where("split = 'train'"))


def test_changing_train_changes_what_is_fitted(spark, fitted):
    _, other = preprocess_fit(make(spark, change=(90, 1e6)), SPEC)
    assert other.scaler["m1_mean"] != fitted[1].scaler["m1_mean"]


def test_apply_equals_fit(spark, fitted, tmp_path):
    clean, fits = fitted
    save_fitted(spark, fits, str(tmp_path / "fitted"))
    stored = load_fitted(spark, str(tmp_path / "fitted"))
    panel = make(spark)
    cut = F.lit(SPEC.cutoff).cast("timestamp_ntz")
    for split, part in (("train", panel.where(F.col("t") < cut)), ("val", panel.where(F.col("t") >= cut))):
        applied = preprocess_apply(part, stored, SPEC)
        want = clean.where(F.col("split") == split).select(*applied.columns)
        assert rows_of(applied) == rows_of(want)


def test_large_lookups_count_hot_keys_in_the_stored_panel(spark, fitted, monkeypatch):
    """The panel is stored before the lookups, so none of them writes it again."""
    written, stage = [], lookup.stage
    monkeypatch.setattr(lookup, "stage", lambda df, name: written.append(name) or stage(df, name))
    monkeypatch.setattr(fill, "lookup_join", partial(lookup.lookup_join, broadcast_rows=0, hot_rows=3, salts=4))
    clean, fits = preprocess_fit(make(spark), SPEC)
    assert rows_of(clean) == rows_of(fitted[0]) and fits.medians == fitted[1].medians
    assert written == ["hot_keys"] * 3
    applied = preprocess_apply(make(spark), fits, SPEC)  # rows that are stored nowhere are written
    assert applied.count() == 3 * HOURS and written[3:] == ["lookup_rows", "hot_keys"] * 2


def test_tiers_name_where_cells_came_from(spark, fitted):
    clean, _ = fitted
    counts = {r[0]: r[1] for r in clean.groupBy("m1" + TIER).count().collect()}
    observed = make(spark).where("m1 IS NOT NULL").count()
    assert counts[0] == observed and sum(counts.values()) == 3 * HOURS
    assert set(counts) <= {0, 1, 2, 3} and 1 in counts and (2 in counts or 3 in counts)


def test_unknown_wind_stays_missing_when_fitted_on_train(fitted):
    clean, _ = fitted
    assert clean.where("wd = 'odd' AND wd_sin IS NOT NULL").count() == 0
    assert clean.where("wd IS NULL").count() == 0


@pytest.mark.parametrize("per_series", [False, True])
def test_all_rows_variant_sees_all_rows(spark, per_series):
    prepared, params = prepare_all_rows(make(spark), SPEC, per_series)
    assert prepared.where("m1 IS NULL OR wd_sin IS NULL OR m1_norm IS NULL").count() == 0
    north = prepared.where("wd = 'odd'").select("wd_sin", "wd_cos").distinct().collect()
    assert [tuple(r) for r in north] == [(0.0, 1.0)]
    changed, other = prepare_all_rows(make(spark, change=(140, 1e6)), SPEC, per_series)
    if per_series:
        assert rows_of(params.scaler_by_series) != rows_of(other.scaler_by_series)
    else:
        assert params.scaler["m1_mean"] != other.scaler["m1_mean"]
    wins = all_rows_windows(prepared, SPEC, manifest_all_rows(SPEC, "abc"))
    counts = {r[0]: r[1] for r in wins.groupBy("split").count().collect()}
    assert counts == {"train": 3 * (int(HOURS * 0.85) - 24), "val": 3 * (HOURS - int(HOURS * 0.85))}


def test_windows_of_the_train_fitted_variants(fitted):
    clean, _ = fitted
    short = short_windows(clean, SPEC, manifest_short(SPEC, "abc"))
    counts = {(r[0], r[1]): r[2] for r in short.groupBy("split", "series").count().collect()}
    assert counts == {(p, s): n - 24 for s in "abc" for p, n in (("train", 96), ("val", 54))}
    pairs = short_pairs(clean, SPEC, manifest_short(SPEC, "abc"))
    last = short.select("split", "series", "target_dt", F.element_at("x", -1).alias("x_last"), "y_norm", "y_raw")
    assert rows_of(last) == rows_of(pairs, *last.columns)
    long = long_windows(clean, SPEC, manifest_long(SPEC, "abc"))
    assert long.count() == 3 * (96 - 48 + 54 - 48)


def test_published_feature_counts():
    stations = [f"s{i:02d}" for i in range(12)]
    assert len(manifest_short(AIR_QUALITY, stations).features) == 29
    assert len(manifest_long(AIR_QUALITY, stations).features) == 47
    assert len(manifest_all_rows(AIR_QUALITY, stations).features) == 39
