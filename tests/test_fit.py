"""Fitted tables, quantiles and lookups."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidegrid.operators.fill import fill_scalar, fit_series_means, mean_fill, seasonal_fill
from tidegrid.operators.fit import (
    fit_mode, fit_scaler, fit_scaler_by_key, fit_seasonal, fit_seasons, modes_of, scaler_after_fills, seasonal_of,
)
from tidegrid.operators.lookup import lookup_join
from tidegrid.operators.onehot import sparse_one_hot, vocabulary_index
from tidegrid.operators.quantiles import exact_quantiles
from tidegrid.operators.scale import apply_scaler, unscalable
from tidegrid.functions.encoding import one_hot, one_hot_names, vocabulary
from tidegrid.sources.stage import one_row


def test_mode_takes_the_smallest_on_ties_and_a_default(spark):
    df = spark.createDataFrame(
        [("a", "W"), ("a", "E"), ("a", "W"), ("a", "E"), ("a", None), ("a", None), ("a", None),
         ("b", None), ("c", "S")], "series string, wd string")
    got = {r["series"]: r["wd"] for r in fit_mode(df, ["series"], "wd").collect()}
    assert got == {"a": "E", "b": "N", "c": "S"}


def quantile(values, p):
    values = sorted(values)
    rank = p * (len(values) - 1)
    low = int(rank)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (rank - low)


def quantiles(spark, values, probs, limit):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = exact_quantiles(df, ["v"], probs, accuracy=limit).collect()
    return {r["prob"]: r["value"] for r in rows}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.floats(-1e6, 1e6), st.sampled_from([0.0, 1e-9, 5.0])), min_size=1, max_size=40),
       limit=st.sampled_from([20, 10_000]))
def test_quantiles_are_exact_either_way(spark, values, limit):
    probs = [0.0, 0.3, 0.5, 1.0]
    got = quantiles(spark, values, probs, limit)
    for p in probs:
        assert got[p] == pytest.approx(quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_by_narrowing_with_a_heavy_value_and_outliers(spark):
    rng = random.Random(3)
    values = [7.0] * 400 + [rng.gauss(0, 1) for _ in range(600)] + [1e12, -1e12]
    got = quantiles(spark, values, [0.1, 0.5, 0.9], limit=20)
    assert got == pytest.approx({p: quantile(values, p) for p in (0.1, 0.5, 0.9)})
    assert got[0.5] == statistics.median(values)


@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("values", [
    [float("nan"), 1.0, 2.0, 4.0], [float("inf"), 1.0, 2.0, 3.0, 4.0, 5.0], [-1.7e308, 0.0, 1.7e308],
    [10.0 ** k for k in range(-150, 151)], [3.0] * 500 + [4.0, 5.0], [1.0], [None, 2.0, None],
])
def test_quantiles_of_hard_columns(spark, values, accuracy):
    kept = [v for v in values if v is not None and v == v]
    got = quantiles(spark, values, [0.0, 0.3, 0.5, 0.75], accuracy)
    assert got == pytest.approx({p: quantile(kept, p) for p in (0.0, 0.3, 0.5, 0.75)}, rel=1e-9)


@pytest.mark.parametrize("accuracy", [2, 7])
def test_quantiles_whose_sketch_encloses_nothing(spark, accuracy):
    """Without slack a coarse sketch misses its ranks; they are found again by counting."""
    rng = random.Random(5)
    probs = [0.0, 0.13, 0.5, 0.77, 1.0]
    groups = {"a": [rng.choice([-1.0, 1.0]) * 10 ** rng.uniform(-3, 9) for _ in range(900)],
              "b": [float(rng.randrange(6)) for _ in range(500)], "c": [3.0], None: [-1e300, 1.0, 2.0, 1e300, 7.0]}
    rows = [(g, v, -v) for g, values in groups.items() for v in values] + [("c", None, float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double, w double")
    got = {(r["g"], r["column"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["v", "w"], probs, by=["g"], accuracy=accuracy, slack=0.0).collect()}
    assert len(got) == len(groups) * 2 * len(probs)
    for g, values in groups.items():
        for p in probs:
            assert got[g, "v", p] == pytest.approx(quantile(values, p), rel=1e-12)
            assert got[g, "w", p] == pytest.approx(quantile([-v for v in values], p), rel=1e-12)


def test_quantiles_found_again_in_many_rounds(spark, monkeypatch):
    monkeypatch.setattr("tidegrid.operators.quantiles.PARTS", 2)
    values = [float(i * i % 1009) for i in range(1200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], [0.31, 0.5], accuracy=2, slack=0.0).collect()}
    assert got == pytest.approx({p: quantile(values, p) for p in (0.31, 0.5)}, rel=1e-12)


def test_quantiles_without_values_and_with_many_groups(spark):
    df = spark.range(3000).selectExpr("id % 1000 AS g", "CAST(id AS DOUBLE) AS v", "CAST(NULL AS DOUBLE) AS w")
    rows = exact_quantiles(df, ["v", "w"], [0.5], by=["g"]).collect()
    assert {(r["g"], r["column"]): r["value"] for r in rows} == {(g, "v"): g + 1000.0 for g in range(1000)}


def test_quantiles_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", None)], "g string, v double")
    for limit in (20, 10_000):
        rows = exact_quantiles(df, ["v"], [0.5], by=["g"], accuracy=limit).collect()
        assert {r["g"]: r["value"] for r in rows} == {"a": 1.5, "b": 5.0}


def test_overall_mean_is_taken_after_the_series_fill(spark):
    df = spark.createDataFrame(
        [("a", 0, 1.0), ("a", 1, None), ("a", 2, None), ("b", 0, 9.0), ("c", 0, None)],
        "series string, pos long, m1 double")
    filled = mean_fill(df, ["series"], ["m1"], fit_series_means(df, ["series"], ["m1"]))
    got = {(r["series"], r["pos"]): r["m1"] for r in filled.collect()}
    # a counts three times once filled: (1 + 1 + 1 + 9) / 4
    assert got == {("a", 0): 1.0, ("a", 1): 1.0, ("a", 2): 1.0, ("b", 0): 9.0, ("c", 0): 3.0}


def test_zero_spread_gives_null_and_is_reported(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0)], "a double, b double")
    params = one_row(fit_scaler(df, ["a", "b"]))
    assert unscalable(params, ["a", "b"]) == ["b"]
    assert [r["b_norm"] for r in apply_scaler(df, params, ["a", "b"]).collect()] == [None, None]


@pytest.mark.parametrize("rows, salt", [(0, "pos"), (0, None), (100, None)])
def test_salted_and_broadcast_lookups_agree(spark, rows, salt):
    df = spark.range(300).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("pos"))
    hot = df.withColumn("k", F.when(F.col("pos") < 200, "0").otherwise(F.col("k")))
    lookup = spark.createDataFrame([("0", 10), ("1", 20)], "k string, v int")
    got = lookup_join(hot, lookup, ["k"], salt=salt, broadcast_rows=rows, hot_rows=100, salts=4)
    counts = {r["v"]: r["count"] for r in got.groupBy("v").count().collect()}
    want = {r["v"]: r["count"] for r in hot.join(lookup, "k", "left").groupBy("v").count().collect()}
    assert counts == want and got.count() == 300
    assert got.columns == ["k", "pos", "v"]
    other = lookup_join(hot, lookup, ["k"], salt=salt, broadcast_rows=rows, hot_rows=100, salts=4, counted=hot.select("k"))
    assert sorted(map(str, other.collect())) == sorted(map(str, got.collect()))


def test_per_series_parameters_add_epsilon(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "series string, m1 double")
    row = fit_scaler_by_key(df, ["series"], ["m1"]).first()
    assert row["m1_mu"] == 2.0 and row["m1_sigma"] == pytest.approx(2**0.5 + 1e-8, abs=1e-12)


def test_a_wide_vocabulary_is_refused(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("k"))
    assert len(vocabulary(df, "k", 20)) == 20
    with pytest.raises(ValueError, match="more than 19"):
        vocabulary(df, "k", 19)


@pytest.mark.parametrize("values", [["b", "a", None, "c", "a"], []])
def test_sparse_vectors_are_the_one_hot_columns(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, k string").repartition(3)
    seen = df.where("k <> 'c'")
    index = vocabulary_index(seen, "k")
    rows = sparse_one_hot(df, "k", index).withColumns(one_hot("k", vocabulary(seen, "k"))).collect()
    names = one_hot_names(vocabulary(seen, "k"))
    assert len(rows) == len(values)
    for r in rows:
        v = r["one_hot"]
        dense = [0.0] * v["size"]
        for i, x in zip(v["indices"], v["values"]):
            dense[i] = x
        assert dense == [r[n] for n in names]


def test_a_vocabulary_index_spans_all_ranges(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.format_string("%05d", F.col("id") % 1000)).alias("k")).repartition(7)
    index = {r["k"]: r["index"] for r in vocabulary_index(df, "k").collect()}
    assert index == {f"k{i:05d}": i for i in range(1000)}


def test_fits_of_one_scan_are_the_single_fits(spark):
    rng = np.random.default_rng(3)
    rows = [(s, int(m), None if rng.random() < 0.4 or m == 5 else float(1e6 + rng.normal()), rng.choice(["N", "S", None], p=[0.4, 0.4, 0.2]))
            for s in "abc" for m in rng.integers(1, 7, 200)]
    df = spark.createDataFrame([(a, b, c, None if d is None else str(d)) for a, b, c, d in rows], "series string, month int, m1 double, wd string")
    seasons = fit_seasons(df, ["series", "month"], ["m1"], "series", "wd")
    assert {tuple(r) for r in modes_of(seasons, "series", "wd").collect()} == {tuple(r) for r in fit_mode(df, ["series"], "wd").collect()}
    seasonal = fit_seasonal(df, ["series", "month"], ["m1"])
    got = {(r["series"], r["month"]): r["m1"] for r in seasonal_of(seasons, ["series", "month"], ["m1"]).collect()}
    assert got == {(r["series"], r["month"]): r["m1"] for r in seasonal.collect()}
    filled = fill_scalar(seasonal_fill(df, seasonal, ["series", "month"], ["m1"]), {"m1": 1e6 + 5}, ["m1"])
    want, have = fit_scaler(filled, ["m1"]).first(), scaler_after_fills(seasons, ["m1"], {"m1": 1e6 + 5}).first()
    assert tuple(have) == pytest.approx(tuple(want), rel=1e-9)
