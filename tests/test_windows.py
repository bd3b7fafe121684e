"""Window tensors, sequence functions and wide request rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.sequences import (
    explode_windows, flatten_window, in_window_rolling, lags_to_sequence, last_step, window_cell,
)
from tidegrid.operators.lagrows import lag_rows_to_windows
from tidegrid.operators.score import score_windows_with
from tidegrid.operators.strided import score_blocks_with
from tidegrid.operators.summaries import window_profile
from tidegrid.operators.windows import (
    persistence, series_lengths, sliding_windows, split_by_fraction,
)


@pytest.fixture(scope="module")
def wins(panel):
    df = panel({"a": [float(i) for i in range(10)], "b": [50.0, 51.0, 52.0], "c": [None, 1.0, 2.0, 3.0, 4.0]})
    df = df.withColumn("m2", F.col("m1") * 10)
    return sliding_windows(df, ["series"], "pos", "t", ["m1", "m2"], 3, "m1", "m2", size=4).cache()


def test_window_law(wins):
    rows = wins.where("series = 'a'").orderBy("target_pos").collect()
    assert len(rows) == 7
    for before, after in zip(rows, rows[1:]):
        assert after["x"][:-1] == before["x"][1:]
    assert rows[0]["x"] == [[0.0, 0.0], [1.0, 10.0], [2.0, 20.0]]
    assert (rows[0]["y_norm"], rows[0]["y_raw"]) == (3.0, 30.0)


def test_short_series_give_no_windows_and_missing_cells_keep_their_place(wins):
    assert {r[0] for r in wins.select("series").distinct().collect()} == {"a", "c"}
    first = wins.where("series = 'c'").orderBy("target_pos").first()
    assert first["x"] == [[None, None], [1.0, 10.0], [2.0, 20.0]]


def test_functions_over_steps(wins):
    row = wins.where("series = 'a'").orderBy("target_pos").select(
        last_step("x"), window_cell("x", -1, 0), window_cell("x", 1, 1), flatten_window("x")
    ).first()
    assert tuple(row) == ([2.0, 20.0], 2.0, 0.0, [0.0, 0.0, 1.0, 10.0, 2.0, 20.0])
    long = explode_windows(wins.where("series = 'a'"), ["target_pos"], ["m1", "m2"])
    assert long.count() == 7 * 3 * 2
    assert long.where("target_pos = 3 AND step = 2 AND feature = 'm2'").first()["value"] == 20.0


def test_profile_counts_missing_cells(wins):
    row = window_profile(wins, by=["series"]).where("series = 'c'").first()
    assert (row["windows"], row["steps"], row["features"], row["missing"]) == (2, 3, 2, 2)


def test_split_by_fraction_uses_the_float_product(panel):
    df = panel({"a": [1.0] * 100, "b": [1.0] * 7})
    out = split_by_fraction(df, ["series"], "pos", series_lengths(df, ["series"]))
    got = {r[0]: r[1] for r in out.where("split = 'val'").groupBy("series").agg(F.min("pos")).collect()}
    assert got == {"a": int(100 * (1 - 0.15)), "b": int(7 * (1 - 0.15))}


def test_persistence_has_no_first_prediction(panel):
    out = persistence(panel({"a": [1.0, 2.0, 3.0]}), ["series"], "pos", "m1", size=2).orderBy("pos")
    assert [r["pred"] for r in out.collect()] == [None, 1.0, 2.0]


def trailing(seq, k, f):
    return [f(seq[max(0, i - k + 1): i + 1]) for i in range(len(seq))]


def test_in_window_rolling_equals_numpy(spark):
    seq = np.random.default_rng(5).normal(50, 20, 24).tolist()
    df = spark.createDataFrame([(seq,)], "s array<double>")
    s = F.col("s")
    row = df.select(in_window_rolling(s, "mean", 6), in_window_rolling(s, "std", 6), in_window_rolling(s, "diff")).first()
    assert row[0] == pytest.approx(trailing(seq, 6, np.mean), rel=1e-13)
    assert row[1] == pytest.approx(trailing(seq, 6, np.std), rel=1e-12, abs=1e-12)
    assert row[2] == pytest.approx([0.0, *np.diff(seq)], rel=1e-13)
    with pytest.raises(ValueError, match="unknown kind"):
        in_window_rolling(s, "median", 3)


W = 4
ROLLING = {"m1_mean_2": ("m1", "mean", 2), "m1_std_3": ("m1", "std", 3), "m1_diff": ("m1", "diff", 1)}
STATS = {"m1": (10.0, 2.0), "m2": (1.0, 0.5), "m1_mean_2": (9.0, 3.0), "m1_std_3": (1.0, 4.0), "m1_diff": (0.5, 2.0)}


def expected(values, wd, hours, station):
    filled = {c: [STATS[c][0] if v is None else v for v in values[c]] for c in values}
    rolled = {
        "m1_mean_2": trailing(filled["m1"], 2, np.mean), "m1_std_3": trailing(filled["m1"], 3, np.std),
        "m1_diff": [0.0, *np.diff(filled["m1"])],
    }
    degrees = {"N": 0.0, "E": 90.0, "SSW": 202.5}
    x = []
    for i in range(W):
        row = [(filled[c][i] - STATS[c][0]) / STATS[c][1] for c in ("m1", "m2")]
        angle = np.deg2rad(degrees.get(wd[i], 0.0))
        row += [np.sin(angle), np.cos(angle)]
        row += [np.sin(2 * np.pi * hours[i] / 24), np.cos(2 * np.pi * hours[i] / 24), 0, 0, 0, 0]
        row += [(rolled[c][i] - STATS[c][0]) / STATS[c][1] for c in ROLLING]
        x.append(row + [float(station == s) for s in ("a", "b")])
    return x


@pytest.mark.parametrize("by_series", [False, True])
def test_wide_rows_equal_a_direct_computation(spark, by_series):
    values = {"m1": [8.0, None, 12.5, 7.0], "m2": [None, 1.5, 0.0, 2.0]}
    wd, hours = ["E", None, "SSW", "odd"], [22, 23, 0, 1]
    row = {"id": "r1", "station": "b"}
    for i in range(W):
        lag = W - i
        row |= {f"m1_lag_{lag}": values["m1"][i], f"m2_lag_{lag}": values["m2"][i],
                f"wd_lag_{lag}": wd[i], f"hour_lag_{lag}": hours[i]}
    kinds = {"m1": "double", "m2": "double", "wd": "string", "hour": "int"}
    schema = ", ".join(["id string", "station string"] + [f"{k} {kinds[k.split('_')[0]]}" for k in row if "lag" in k])
    df = spark.createDataFrame([tuple(row.values())], schema)
    if by_series:
        named = {"station": "b"} | {f"{c}{s}": v for c, st in STATS.items() for s, v in zip(("_mu", "_sigma"), st)}
        fitted = spark.createDataFrame([tuple(named.values())], ", ".join(
            f"{n} {'string' if n == 'station' else 'double'}" for n in named))
        options = {"by_series": fitted}
    else:
        options = {"params": {f"{c}{s}": v for c, st in STATS.items() for s, v in zip(("_mean", "_std"), st)}}
    out = lag_rows_to_windows(df, ["m1", "m2"], ROLLING, ["b", "a"], W, **options).first()
    assert out["id"] == "r1"
    np.testing.assert_allclose(np.array(out["x"]), np.array(expected(values, wd, hours, "b")), atol=1e-6)


def test_wide_rows_need_one_kind_of_parameters(spark):
    df = spark.createDataFrame([("r", "a")], "id string, station string")
    with pytest.raises(ValueError, match="either"):
        lag_rows_to_windows(df, [], {}, [], 1)


def test_lags_to_sequence_is_oldest_first(spark):
    df = spark.createDataFrame([(3.0, None, 1.0)], "q_lag_1 double, q_lag_2 double, q_lag_3 double")
    assert df.select(lags_to_sequence("q", 3, F.lit(9.0))).first()[0] == [1.0, 9.0, 3.0]


@pytest.mark.parametrize("size", [9, 8192])
@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("batch", [2, 1024])
def test_scores_over_views_are_those_over_tensors(panel, size, dense, batch):
    df = panel({"a": [float(i % 13) if i % 5 else None for i in range(90)], "b": [float(i) for i in range(7)], "c": [2.0] * 8})
    df = df.withColumn("m2", F.col("pos").cast("double"))
    args = (["series"], "pos", "t", ["m1", "m2", "l2"], 7)
    options = {"features": {"l2": ("m1", "lag", 2)}, "size": size, "dense": dense}

    def weigh(x):
        steps = np.arange(1, 8)[None, :, None] * np.array([1.0, 10.0, 0.1])
        return np.nansum(x * steps, axis=(1, 2))

    wins = sliding_windows(df, *args, "m1", "m1", **options)
    want = {(r["series"], r["target_dt"]): r["pred"] for r in score_windows_with(wins, weigh, ["series", "target_dt"]).collect()}
    got = score_blocks_with(df, *args, weigh, batch=batch, **options).collect()
    assert len(want) == 84 and len(got) == 84 and {r["target_pos"] for r in got} == set(range(7, 90))
    assert {(r["series"], r["target_dt"]): r["pred"] for r in got} == pytest.approx(want)


def test_scores_over_views_that_cross_arrow_batches(spark, panel):
    df = panel({"a": [float(i) for i in range(500)]})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = score_blocks_with(df, ["series"], "pos", "t", ["m1"], 30, lambda x: x[:, 0, 0] + x[:, -1, 0]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["target_pos"]: r["pred"] for r in got} == {i: float(i - 30 + i - 1) for i in range(30, 500)}
