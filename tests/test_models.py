"""Ridge, scoring, matching, blends and model comparison."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions.errors import huber, mae, mse, rmse
from tidegrid.operators.blend import align_predictions, blend, blend_grid, blend_mean, seed_mean
from tidegrid.operators.compare import best_model, leaderboard, merge_metrics
from tidegrid.operators.ridge import ridge_fit, ridge_fits, ridge_predict
from tidegrid.operators.score import (
    finish_predictions, match_coverage, match_predictions, score_windows_with, target_time,
)
from tidegrid.operators.strided import ridge_fit_blocks
from tidegrid.operators.windows import sliding_windows
from tidegrid.plans.forecast import fit_blend_weights


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_ridge_equals_the_closed_form_with_collinear_indicators(spark, alpha):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 10, 0.1]
    kind = rng.integers(0, 3, 200)
    x = np.hstack([x, np.eye(3)[kind]])  # indicators sum to one
    y = x @ [1, 2, 3, 0.5, -1, 2] + rng.normal(size=200) + 40
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double")
    model = ridge_fit(df, "x", "y", alpha)
    w, b = closed_form(x, y, alpha)
    np.testing.assert_allclose(model.weights, w, rtol=1e-8)
    assert model.intercept == pytest.approx(b, rel=1e-8)
    pred = ridge_predict(df, model, mean=3.0, std=2.0, x="x").select("x", "pred").collect()
    for r in pred[:5]:
        assert r["pred"] == pytest.approx((np.dot(r["x"], w) + b) * 2 + 3)


def test_blend_weights_without_penalty(spark):
    rng = np.random.default_rng(2)
    p = rng.normal(size=(100, 3))
    y = p @ [0.6, 0.3, 0.1] + 2
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(p, y)], "a double, b double, c double, y double")
    row = fit_blend_weights(df, ["a", "b", "c"], "y").first()
    assert tuple(row) == pytest.approx((0.6, 0.3, 0.1, 2.0))


def sets(spark, *rows):
    return [spark.createDataFrame(r, "id string, pred double") for r in rows]


def test_blends(spark):
    a, b = sets(spark, [("x", 10.0), ("y", -30.0)], [("y", 10.0), ("x", 20.0)])
    assert {r["id"]: r["pred"] for r in blend(a, b, 0.75).collect()} == {"x": 12.5, "y": 0.0}
    grid = blend_grid(a, b, [0.5, 1.0])
    assert {(r["w"], r["id"]): r["pred"] for r in grid.collect()} == {
        (0.5, "x"): 15.0, (0.5, "y"): 0.0, (1.0, "x"): 10.0, (1.0, "y"): 0.0}
    mean = {r["id"]: r["pred"] for r in blend_mean(a, b, b).collect()}
    assert mean == pytest.approx({"x": 50 / 3, "y": -10 / 3})


@pytest.mark.parametrize("other", [[("x", 1.0)], [("x", 1.0), ("z", 1.0)], [("x", 1.0), ("y", 1.0), ("y", 2.0)]])
def test_sets_with_other_ids_are_refused(spark, other):
    a, b = sets(spark, [("x", 1.0), ("y", 2.0)], other)
    for left, right in ((a, b), (b, a)):
        with pytest.raises(Exception, match="prediction set"):
            align_predictions(left, right).collect()


def test_missing_predictions_are_not_mismatched_ids(spark):
    a, b = sets(spark, [("x", None)], [("x", 2.0)])
    assert [tuple(r) for r in align_predictions(a, b).collect()] == [("x", None, 2.0)]


def test_matching_takes_the_last_and_falls_back(spark):
    ids = spark.createDataFrame([("i1", "a", 1), ("i2", "a", 2), ("i3", "b", 1)], "id string, s string, k int")
    preds = spark.createDataFrame([("a", 1, 5.0, 1), ("a", 1, 6.0, 2), ("b", 1, None, 1)], "s string, k int, pred double, o int")
    out = match_predictions(ids, preds, ["s", "k"], fallback=9.0, order="o")
    assert {r["id"]: (r["pred"], r["matched"]) for r in out.collect()} == {
        "i1": (6.0, True), "i2": (9.0, False), "i3": (None, True)}
    assert tuple(match_coverage(out).first()) == (3, 2, 1)


def test_finishing_clips_only_when_asked(spark):
    df = spark.createDataFrame([(-9.0,), (1.0,), (None,)], "pred double")
    assert [r[0] for r in finish_predictions(df, 5.0, 1.0).collect()] == [0.0, 6.0, None]
    assert [r[0] for r in finish_predictions(df, 5.0, 1.0, clip=False).collect()] == [-4.0, 6.0, None]


def test_target_time_reads_the_last_context_hour(spark):
    df = spark.createDataFrame(
        [("a", 2024, 2, 28, 22, 2024, 2, 28, 23)],
        "id string, year_0 int, month_0 int, day_0 int, hour_0 int, year_1 int, month_1 int, day_1 int, hour_1 int")
    assert str(target_time(df).first()["target_dt"]) == "2024-02-29 00:00:00"
    with pytest.raises(ValueError, match="year"):
        target_time(df.select("id"))


def test_user_scorer_runs_over_batches(spark):
    df = spark.createDataFrame([("a", [[1.0, 2.0], [3.0, 4.0]]), ("b", [[5.0, None], [7.0, 6.0]])], "id string, x array<array<float>>")
    out = score_windows_with(df, lambda ws: np.nansum(ws[:, :, 1], axis=1) + ws.shape[2], ["id"])
    assert {r["id"]: r["pred"] for r in out.collect()} == {"a": 8.0, "b": 8.0}
    assert score_windows_with(df.where("false"), lambda ws: ws[:, 0, 0], ["id"]).collect() == []
    assert out.schema.simpleString() == "struct<id:string,pred:double>"


def test_error_measures(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.0, -3.0), (None, 1.0)], "y double, p double")
    row = df.agg(mse("y", "p"), rmse("y", "p"), mae("y", "p"), huber("y", "p")).first()
    assert tuple(row) == pytest.approx((4.625, 4.625**0.5, 1.75, (0.125 + 2.5) / 2))


def test_leaderboard_and_best(spark):
    m = spark.createDataFrame([("persistence", 23.0, 11.0), ("ridge", 20.0, 10.0), ("other", 19.0, 9.0)], "model string, rmse double, mae double")
    rows = leaderboard(m).collect()
    assert [r["model"] for r in rows] == ["other", "ridge", "persistence"]
    assert (rows[0]["gain_persistence"], rows[0]["beats_ridge"], rows[1]["beats_ridge"]) == (4.0, True, False)
    assert tuple(best_model(m).first()) == ("other", 19.0)
    assert tuple(best_model(m, among=["persistence", "ridge"]).first()) == ("ridge", 20.0)
    merged = merge_metrics(m, spark.createDataFrame([("ridge", 1.0, 1.0)], m.schema))
    assert {r["model"]: r["rmse"] for r in merged.collect()} == {"persistence": 23.0, "ridge": 1.0, "other": 19.0}


def test_seed_mean(spark):
    df = spark.createDataFrame([("w1", 1.0), ("w1", 3.0), ("w2", 5.0)], "w string, pred double")
    assert {r["w"]: r["pred"] for r in seed_mean(df, ["w"]).collect()} == {"w1": 2.0, "w2": 5.0}


def test_several_predictions_without_an_order_are_refused(spark):
    ids = spark.createDataFrame([("a", 1)], "id string, k int")
    preds = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, pred double")
    with pytest.raises(Exception, match="no order"):
        match_predictions(ids, preds, ["k"], fallback=0.0).collect()


def test_hot_requests_are_split_over_tasks(spark):
    ids = spark.range(3000).selectExpr("id", "CAST(IF(id % 3 = 0, id, 7) AS INT) AS k")
    preds = spark.range(0, 3000, 2).selectExpr("CAST(id AS INT) AS k", "CAST(id AS DOUBLE) AS pred")
    plain = {r["id"]: (r["pred"], r["matched"]) for r in match_predictions(ids, preds, ["k"], 0.5).collect()}
    split = match_predictions(ids, preds, ["k"], 0.5, broadcast_rows=0, hot_rows=500, salts=8)
    assert {r["id"]: (r["pred"], r["matched"]) for r in split.collect()} == plain and len(plain) == 3000


def test_mean_blend_needs_the_same_ids(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "id string, pred double")
    assert {r["id"]: r["pred"] for r in blend_mean(a, a, a.withColumn("pred", F.col("pred") + 3)).collect()} == {"x": 2.0, "y": 3.0}
    for bad in (a.where("id = 'x'"), a.unionByName(a)):
        with pytest.raises(Exception, match="not once in every"):
            blend_mean(a, bad).collect()


def test_ridge_without_rows_says_so(spark):
    with pytest.raises(ValueError, match="no rows"):
        ridge_fit(spark.createDataFrame([], "x array<double>, y double"), "x", "y")


def test_ridge_on_whole_windows_equals_the_closed_form(spark):
    """24 steps of 29 features, with a large offset, over small blocks; several penalties in one scan."""
    rng = np.random.default_rng(5)
    names = [f"f{i}" for i in range(29)]
    cells = {s: rng.normal(1000.0, 3.0, (n, 29)).astype(np.float32).astype(float) for s, n in (("a", 900), ("b", 30), ("c", 20))}
    rows = [(s, i, float(2 * i), *row.tolist()) for s, own in cells.items() for i, row in enumerate(own)]
    df = spark.createDataFrame(rows, "series string, pos long, y double, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    df = df.withColumn("t", F.col("pos"))
    x = np.concatenate([np.stack([own[i - 24:i].ravel() for i in range(24, len(own))]) for own in cells.values() if len(own) > 24])
    y = np.concatenate([2.0 * np.arange(24, len(own)) for own in cells.values() if len(own) > 24])
    models = ridge_fit_blocks(df, ["series"], "pos", "t", names, 24, "y", [1.0, 50.0], size=100, batch=64)
    wins = sliding_windows(df, ["series"], "pos", "t", names, 24, "y", "y")
    flat = ridge_fits(wins, "x", "y_raw", [1.0, 50.0])
    for alpha in (1.0, 50.0):
        weights, intercept = closed_form(x, y, alpha)
        for model in (models[alpha], flat[alpha]):
            np.testing.assert_allclose(model.weights, weights, rtol=1e-5, atol=1e-7)
            assert model.intercept == pytest.approx(intercept, rel=1e-5)


def test_ridge_leaves_out_rows_with_missing_numbers(spark):
    rows = [([1.0, 2.0], 3.0), ([2.0, 1.0], 4.0), ([0.0, 5.0], 1.0), ([None, 1.0], 9.0), ([1.0, float("nan")], 9.0), ([1.0, 1.0], None), (None, 9.0)]
    model = ridge_fit(spark.createDataFrame(rows, "x array<double>, y double"), "x", "y", 0.5)
    weights, intercept = closed_form(np.array([[1.0, 2.0], [2.0, 1.0], [0.0, 5.0]]), np.array([3.0, 4.0, 1.0]), 0.5)
    assert model.weights == pytest.approx(list(weights)) and model.intercept == pytest.approx(intercept)
