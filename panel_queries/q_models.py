"""Baseline forecasters, scoring of requests, and blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.fixtures import (
    BY_TYPE, FORECAST_CUTOFF, MEASURES, hourly, sql_clean, sql_columns, sql_hourly, sql_interpolate, table,
)
from panel_queries.q_stats import SQL_PREDICTIONS, predictions, predictions_of
from panel_queries.registry import query, r6, rounded, sql_r6, sql_rounded
from tidegrid.functions.errors import rmse
from tidegrid.functions.sequences import window_cell
from tidegrid.operators.blend import WEIGHTS, align_predictions, blend, blend_grid, blend_mean, seed_mean
from tidegrid.operators.compare import evaluate
from tidegrid.operators.ridge import ridge_fit, ridge_predict
from tidegrid.operators.score import (
    finish_predictions, match_coverage, match_predictions, prediction_summary, score_windows,
    score_windows_with,
)
from tidegrid.operators.strided import ridge_fit_blocks, score_blocks_with
from tidegrid.operators.windows import last_step_pairs, sliding_windows
from tidegrid.plans.dataset import Manifest, manifest_long
from tidegrid.plans.forecast import (
    fit_blend_weights, flagship_scores, score_requests, score_requests_with,
)
from tidegrid.plans.preprocess import preprocess_apply, preprocess_fit
from tidegrid.sources.stage import stage

W = 24
NORMS = ["m1_norm", "m2_norm"]


@query(
    "persistence_rmse_by_type",
    "WITH" + sql_hourly("event_type") + ","
    + sql_interpolate("panel", ["m1"], "series", 6, "series, t, pos, m1 AS observed") + f""",
    seasonal AS (SELECT series, hour(t) AS hour, month(t) AS month, avg(m1) AS m FROM filled GROUP BY ALL),
    s AS (SELECT f.series, pos, observed, m1 AS interpolated, coalesce(m1, m) AS m1
          FROM filled f JOIN seasonal x ON f.series = x.series AND hour(t) = hour AND month(t) = month),
    med AS (SELECT median(m1) AS m FROM s),
    w AS (SELECT series, pos, observed, interpolated, coalesce(m1, m) AS m1 FROM s, med),
    p AS (SELECT *, lag(m1) OVER (PARTITION BY series ORDER BY pos) AS pred FROM w)
    SELECT series, count(*) AS cells, count(observed) AS observed, count(interpolated) AS after_interpolation,
           {sql_r6('avg(m1)')} AS mean, {sql_r6('stddev_samp(m1)')} AS std,
           {sql_r6('sqrt(avg((m1 - pred) * (m1 - pred)))')} AS rmse
    FROM p GROUP BY series""",
)
def persistence_rmse_by_type(spark, sf):
    """Flagship: one-step persistence error of every series after tiered imputation."""
    panel = hourly(spark, sf, "event_type")
    scores = flagship_scores(panel, ["series"], "pos", "t", "m1")
    return scores.select(
        "series", "cells", "observed", "after_interpolation", *rounded(["mean", "std", "rmse"])
    )


def _pairs(spark, sf):
    """Clean hourly panel, fitted parameters, and its targets with their last input step."""
    clean, fitted = preprocess_fit(hourly(spark, sf, "event_type"), BY_TYPE)
    pairs = last_step_pairs(clean, ["split", "series"], "pos", "t", NORMS, W, "m1_norm", "m1", dense=True)
    return stage(pairs, "pairs", ["split"]), fitted


SQL_PAIRS = "WITH" + sql_clean("event_type", FORECAST_CUTOFF) + """,
p AS (SELECT split, series, t, CAST(CAST(lag(m1_norm) OVER w AS FLOAT) AS DOUBLE) AS x1,
             CAST(CAST(lag(m2_norm) OVER w AS FLOAT) AS DOUBLE) AS x2,
             CAST(CAST(m1_norm AS FLOAT) AS DOUBLE) AS y, CAST(CAST(m1 AS FLOAT) AS DOUBLE) AS y_raw,
             row_number() OVER w AS r
      FROM clean WINDOW w AS (PARTITION BY split, series ORDER BY pos)),
pairs AS (SELECT * FROM p WHERE r > 24),
g AS (SELECT avg(x1) AS a1, avg(x2) AS a2, avg(y) AS ay, var_pop(x1) * count(*) + 1.0 AS s11,
             var_pop(x2) * count(*) + 1.0 AS s22, covar_pop(x1, x2) * count(*) AS s12,
             covar_pop(x1, y) * count(*) AS b1, covar_pop(x2, y) * count(*) AS b2
      FROM pairs WHERE split = 'train'),
w AS (SELECT *, (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) AS w1,
             (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) AS w2 FROM g),
model AS (SELECT w1, w2, ay - w1 * a1 - w2 * a2 AS b FROM w),
scored AS (SELECT split, series, t AS target_dt, y_raw, x1 * m1_std + m1_mean AS persistence,
                  (b + w1 * x1 + w2 * x2) * m1_std + m1_mean AS ridge
           FROM pairs, model, scaler)"""


@query("ridge_fit", SQL_PAIRS + f" SELECT {sql_r6('w1')} AS w1, {sql_r6('w2')} AS w2, {sql_r6('b')} AS b FROM model")
def ridge_fit_two_features(spark, sf):
    pairs, _ = _pairs(spark, sf)
    model = ridge_fit(pairs.where("split = 'train'"), "x_last", "y_norm", alpha=1.0)
    row = pairs.where("split = 'train'").agg(F.lit(model.weights[0]).alias("w1"),
                                              F.lit(model.weights[1]).alias("w2"),
                                              F.lit(model.intercept).alias("b"))
    return row.select(*rounded(["w1", "w2", "b"]))


@query(
    "ridge_on_flat_windows",
    SQL_PAIRS + f""",
    f AS (SELECT split, CAST(CAST(lag(m1_norm) OVER w AS FLOAT) AS DOUBLE) AS x2,
                 CAST(CAST(lag(m1_norm, 2) OVER w AS FLOAT) AS DOUBLE) AS x1, m1_norm AS y
          FROM clean WINDOW w AS (PARTITION BY split, series ORDER BY pos)),
    h AS (SELECT avg(x1) AS a1, avg(x2) AS a2, avg(y) AS ay, var_pop(x1) * count(*) + 2.0 AS s11,
                 var_pop(x2) * count(*) + 2.0 AS s22, covar_pop(x1, x2) * count(*) AS s12,
                 covar_pop(x1, y) * count(*) AS b1, covar_pop(x2, y) * count(*) AS b2
          FROM f WHERE split = 'train' AND x1 IS NOT NULL),
    v AS (SELECT *, (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) AS w1,
                 (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) AS w2 FROM h)
    SELECT {sql_r6('w1')} AS w1, {sql_r6('w2')} AS w2, {sql_r6('ay - w1 * a1 - w2 * a2')} AS b FROM v""",
)
def ridge_on_flat_windows(spark, sf):
    """A linear model of whole windows, here of two steps, fitted over views of the rows."""
    clean, _ = preprocess_fit(hourly(spark, sf, "event_type"), BY_TYPE)
    train = clean.where("split = 'train'")
    model = ridge_fit_blocks(train, ["series"], "pos", "t", ["m1_norm"], 2, "m1_norm", [2.0], dense=True)[2.0]
    row = train.agg(F.lit(model.weights[0]).alias("w1"), F.lit(model.weights[1]).alias("w2"), F.lit(model.intercept).alias("b"))
    return row.select(*rounded(["w1", "w2", "b"]))


def _scored(spark, sf):
    pairs, fitted = _pairs(spark, sf)
    mean, std = fitted.scaler["m1_mean"], fitted.scaler["m1_std"]
    model = ridge_fit(pairs.where("split = 'train'"), "x_last", "y_norm", alpha=1.0)
    last = F.element_at("x_last", 1).cast("double") * std + mean
    return ridge_predict(pairs.withColumn("persistence", last), model, mean, std, name="ridge")


@query("ridge_predict", SQL_PAIRS + f" SELECT split, series, target_dt, {sql_rounded(['persistence', 'ridge'], 4)} FROM scored")
def ridge_predict_windows(spark, sf):
    return _scored(spark, sf).select("split", "series", "target_dt", *rounded(["persistence", "ridge"], 4))


@query(
    "evaluate_baselines_by_split",
    SQL_PAIRS + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT split, '{m}' AS model, {sql_r6(f'sqrt(avg((y_raw - {m}) * (y_raw - {m})))', 4)} AS rmse, "
        f"{sql_r6(f'avg(abs(y_raw - {m}))', 4)} AS mae FROM scored GROUP BY split"
        for m in ("persistence", "ridge")
    ) + ")",
)
def evaluate_baselines_by_split(spark, sf):
    scores = evaluate(_scored(spark, sf), {"persistence": "persistence", "ridge": "ridge"})
    return scores.select("split", "model", *rounded(["rmse", "mae"], 4))


@query(
    "preprocess_apply_to_later_rows",
    "WITH" + sql_clean("event_type", FORECAST_CUTOFF) + f"""
    SELECT series, t, wd, {sql_rounded([*MEASURES, 'wd_sin', 'wd_cos', 'm1_norm', 'm2_norm', 'm3_norm'])}
    FROM clean WHERE split = 'val'""",
)
def preprocess_apply_to_later_rows(spark, sf):
    """Stored parameters on rows that were never fitted."""
    panel = stage(hourly(spark, sf, "event_type"), "panel")
    _, fitted = preprocess_fit(panel, BY_TYPE)
    later = panel.where(F.col("t") >= F.lit(FORECAST_CUTOFF).cast("timestamp_ntz"))
    applied = preprocess_apply(later, fitted, BY_TYPE)
    return applied.select(
        "series", "t", "wd", *rounded([*MEASURES, "wd_sin", "wd_cos", *BY_TYPE.norms])
    )


@query(
    "score_requests",
    SQL_PAIRS + f""",
    ids AS (SELECT series || '_' || strftime(t, '%Y-%m-%d %H:%M:%S') AS id, series, t FROM clean WHERE split = 'val')
    SELECT id, {sql_r6('CASE WHEN ridge IS NULL THEN m1_mean ELSE greatest(ridge, 0) END', 4)} AS pred, ridge IS NOT NULL AS matched
    FROM ids LEFT JOIN scored s ON s.split = 'val' AND ids.series = s.series AND ids.t = s.target_dt, scaler""",
)
def score_requests_of_val(spark, sf):
    """Fit on train, then answer a request for every later hour; the first day has no window."""
    panel = stage(hourly(spark, sf, "event_type"), "panel")
    clean, fitted = preprocess_fit(panel, BY_TYPE)
    pairs = last_step_pairs(clean, ["split", "series"], "pos", "t", NORMS, W, "m1_norm", "m1", dense=True)
    model = ridge_fit(pairs.where("split = 'train'"), "x_last", "y_norm")
    ids, later = _requests(panel)
    scored = score_requests(ids, later, fitted, BY_TYPE, Manifest(NORMS, [], W), model)
    return scored.select("id", r6("pred", 4).alias("pred"), "matched")


def _requests(panel):
    """One request per hour from the cutoff on, and the rows they are answered from."""
    later = panel.where(F.col("t") >= F.lit(FORECAST_CUTOFF).cast("timestamp_ntz"))
    name = F.concat("series", F.lit("_"), F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    return later.select(name.alias("id"), "series", F.col("t").alias("target_dt")), later


def mean_of_first_feature(windows):
    return windows[:, :, 0].mean(axis=1, dtype=float)


@query(
    "score_requests_by_function",
    "WITH" + sql_clean("event_type", FORECAST_CUTOFF) + f""",
    p AS (SELECT split, series || '_' || strftime(t, '%Y-%m-%d %H:%M:%S') AS id, row_number() OVER w AS r,
                 avg(CAST(CAST(m1_norm AS FLOAT) AS DOUBLE)) OVER (w ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING) AS m
          FROM clean WINDOW w AS (PARTITION BY split, series ORDER BY pos))
    SELECT id, {sql_r6('CASE WHEN r > 48 THEN greatest(m * m1_std + m1_mean, 0) ELSE m1_mean END', 4)} AS pred,
           r > 48 AS matched
    FROM p, scaler WHERE split = 'val'""",
)
def score_requests_by_function(spark, sf):
    """A user's function over the 48-step windows of later rows, all 32 features."""
    panel = stage(hourly(spark, sf, "event_type"), "panel")
    _, fitted = preprocess_fit(panel, BY_TYPE)
    ids, later = _requests(panel)
    manifest = manifest_long(BY_TYPE, ["click", "error", "purchase", "signup", "view"])
    scored = score_requests_with(ids, later, fitted, BY_TYPE, manifest, mean_of_first_feature)
    return scored.select("id", r6("pred", 4).alias("pred"), "matched")


SQL_WHOLE = "WITH" + sql_hourly("event_type") + f""",
whole AS (SELECT series, t, pos, {sql_columns('coalesce(@, 0) AS @')} FROM panel),
wins AS (SELECT series, t AS target_dt, CAST(CAST(lag(m1) OVER w AS FLOAT) AS DOUBLE) AS last,
                avg(CAST(CAST(m1 AS FLOAT) AS DOUBLE)) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS mean, pos
         FROM whole WINDOW w AS (PARTITION BY series ORDER BY pos))"""


def _tensors(spark, sf):
    whole = hourly(spark, sf, "event_type").fillna(0.0, subset=MEASURES)
    return sliding_windows(whole, ["series"], "pos", "t", MEASURES, W, "m1", "m1", dense=True)


@query(
    "score_windows_by_expression",
    SQL_WHOLE + f" SELECT series, target_dt, {sql_r6('last')} AS pred FROM wins WHERE pos >= 24",
)
def score_windows_by_expression(spark, sf):
    scored = score_windows(_tensors(spark, sf), lambda x: window_cell(x, -1, 0).cast("double"))
    return scored.select("series", "target_dt", r6("pred").alias("pred"))


@query(
    "score_windows_by_function",
    SQL_WHOLE + f" SELECT series, target_dt, {sql_r6('mean', 5)} AS pred FROM wins WHERE pos >= 24",
)
def score_windows_by_function(spark, sf):
    """A user's Python model over windows that are views of the rows."""
    whole = hourly(spark, sf, "event_type").fillna(0.0, subset=MEASURES)
    scored = score_blocks_with(whole, ["series"], "pos", "t", MEASURES, W, mean_of_first_feature, dense=True)
    return scored.select("series", "target_dt", r6("pred", 5).alias("pred"))


@query(
    "score_stored_windows_by_function",
    SQL_WHOLE + f" SELECT series, target_dt, {sql_r6('mean', 5)} AS pred FROM wins WHERE pos >= 24",
)
def score_stored_windows_by_function(spark, sf):
    """The same model over tensors, as they come from a stored window set."""
    scored = score_windows_with(_tensors(spark, sf), mean_of_first_feature, ["series", "target_dt"])
    return scored.select("series", "target_dt", r6("pred", 5).alias("pred"))


@query(
    "score_blocks_over_holes",
    "WITH" + sql_hourly("user_id") + f""",
    holed AS (SELECT series, t, pos, coalesce(m1, 0) AS m1 FROM panel WHERE pos % 11 NOT IN (3, 4) AND pos NOT BETWEEN 100 AND 180),
    wins AS (SELECT series, t, row_number() OVER w AS r,
                    avg(CAST(CAST(m1 AS FLOAT) AS DOUBLE)) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS mean
             FROM holed WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT series, t AS target_dt, {sql_r6('mean', 5)} AS pred FROM wins WHERE r > 24""",
)
def score_blocks_over_holes(spark, sf):
    """Windows count rows, also in small blocks and where positions are missing."""
    holed = hourly(spark, sf, "user_id").where("pos % 11 NOT IN (3, 4) AND pos NOT BETWEEN 100 AND 180").fillna(0.0, subset=["m1"])
    scored = score_blocks_with(holed, ["series"], "pos", "t", ["m1"], W, mean_of_first_feature, size=60)
    return scored.select("series", "target_dt", r6("pred", 5).alias("pred"))


SQL_MATCH = SQL_PREDICTIONS + f""",
ids AS (SELECT series || '_' || strftime(t, '%Y-%m-%d %H:%M:%S') AS id, series, t AS target_dt FROM panel),
mu AS (SELECT avg(y) AS mean FROM whole),
matched AS (
  SELECT ids.id, coalesce(p.recent, 50.0) AS pred, p.recent IS NOT NULL AS matched
  FROM ids LEFT JOIN preds p ON ids.series = p.series AND ids.target_dt = p.target_dt)"""


def _matched(spark, sf):
    name = F.concat("series", F.lit("_"), F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    panel = stage(hourly(spark, sf, "user_id").select("series", "t", "pos", "m1"), "panel")
    ids = panel.select(name.alias("id"), "series", F.col("t").alias("target_dt"))
    runs = F.array(F.struct(F.col("recent").alias("pred"), F.lit(2).alias("run")),
                   F.struct((F.col("recent") - 1).alias("pred"), F.lit(1).alias("run")))
    preds = predictions_of(panel).select("series", "target_dt", F.inline(runs))
    return match_predictions(ids, preds, ["series", "target_dt"], fallback=50.0, order="run")


@query("match_predictions", SQL_MATCH + f" SELECT id, {sql_r6('pred')} AS pred, matched FROM matched")
def match_predictions_to_ids(spark, sf):
    """Two runs predict every hour; the later run counts, and unmatched ids get the fallback."""
    return _matched(spark, sf).select("id", r6("pred").alias("pred"), "matched")


@query(
    "match_coverage",
    SQL_MATCH + """ SELECT count(*) AS total, count(*) FILTER (matched) AS matched,
    count(*) FILTER (NOT matched) AS fallback FROM matched""",
)
def match_coverage_of_ids(spark, sf):
    return match_coverage(_matched(spark, sf))


@query(
    "prediction_summary",
    SQL_PREDICTIONS + f""" SELECT count(*) AS rows, {sql_r6('min(recent)')} AS min,
    {sql_r6('max(recent)')} AS max, {sql_r6('avg(recent)')} AS mean FROM preds""",
)
def prediction_summary_of_preds(spark, sf):
    return prediction_summary(predictions(spark, sf), "recent").select("rows", *rounded(["min", "max", "mean"]))


@query(
    "finish_predictions",
    SQL_PREDICTIONS + f" SELECT id, {sql_r6('greatest(recent * 2.0 - 60.0, 0)')} AS pred FROM preds",
)
def finish_predictions_clipped(spark, sf):
    done = finish_predictions(predictions(spark, sf), mean=-60.0, std=2.0, pred="recent")
    return done.select("id", r6("recent").alias("pred"))


def _sets(spark, sf):
    both = stage(predictions(spark, sf).select("id", "last", "recent"), "predictions")
    return (both.select("id", F.col("last").alias("pred")), both.select("id", F.col("recent").alias("pred")))


@query("align_predictions", SQL_PREDICTIONS + f" SELECT id, {sql_r6('last')} AS a, {sql_r6('recent')} AS b FROM preds")
def align_prediction_sets(spark, sf):
    return align_predictions(*_sets(spark, sf)).select("id", *rounded(["a", "b"]))


@query("blend_weighted", SQL_PREDICTIONS + f" SELECT id, {sql_r6('greatest(0.7 * last + 0.3 * recent, 0)', 5)} AS pred FROM preds")
def blend_weighted(spark, sf):
    return blend(*_sets(spark, sf), 0.7).select("id", r6("pred", 5).alias("pred"))


_GRID = " UNION ALL ".join(f"SELECT {w}::DOUBLE AS w" for w in WEIGHTS)


@query(
    "blend_grid",
    SQL_PREDICTIONS + f""", weights AS ({_GRID})
    SELECT w, count(*) AS rows, {sql_r6('avg(w * last + (1 - w) * recent)')} AS mean,
           {sql_r6('max(w * last + (1 - w) * recent)')} AS max,
           {sql_r6('min(w * last + (1 - w) * recent)')} AS min FROM preds, weights GROUP BY w""",
)
def blend_grid_summary(spark, sf):
    rows = prediction_summary(blend_grid(*_sets(spark, sf)), by=["w"])
    return rows.select("w", "rows", *rounded(["mean", "max", "min"]))


@query(
    "blend_mean_of_three",
    SQL_PREDICTIONS + f" SELECT id, {sql_r6('(last + recent + 10.0) / 3', 5)} AS pred FROM preds",
)
def blend_mean_of_three(spark, sf):
    a, b = _sets(spark, sf)
    flat = a.select("id", F.lit(10.0).alias("pred"))
    return blend_mean(a, b, flat).select("id", r6("pred", 5).alias("pred"))


@query(
    "seed_mean_rmse",
    SQL_PREDICTIONS + f""" SELECT count(*) AS windows,
    {sql_r6('sqrt(avg((y - (last + recent) / 2) * (y - (last + recent) / 2)))')} AS rmse FROM preds""",
)
def seed_mean_rmse(spark, sf):
    """Two runs averaged per window before the error is taken."""
    df = stage(predictions(spark, sf).select("series", "target_dt", "y", "last", "recent"), "predictions")
    keys = ["series", "target_dt", "y"]
    runs = df.select(*keys, F.explode(F.array("last", "recent")).alias("pred"))
    mean = seed_mean(runs, keys)
    return mean.agg(F.count(F.lit(1)).alias("windows"), r6(rmse("y", "pred")).alias("rmse"))


@query(
    "fit_blend_weights",
    SQL_PREDICTIONS + f""", g AS (
      SELECT var_pop(last) AS s11, var_pop(recent) AS s22, covar_pop(last, recent) AS s12,
             covar_pop(last, y) AS b1, covar_pop(recent, y) AS b2, avg(last) AS a1, avg(recent) AS a2, avg(y) AS ay
      FROM preds), w AS (
      SELECT *, (b1 * s22 - b2 * s12) / (s11 * s22 - s12 * s12) AS w1,
             (b2 * s11 - b1 * s12) / (s11 * s22 - s12 * s12) AS w2 FROM g)
    SELECT {sql_r6('w1')} AS last, {sql_r6('w2')} AS recent, {sql_r6('ay - w1 * a1 - w2 * a2')} AS intercept FROM w""",
)
def fit_blend_weights_on_preds(spark, sf):
    df = predictions(spark, sf)
    fitted = fit_blend_weights(df, ["last", "recent"], "y")
    return fitted.select(*rounded(["last", "recent", "intercept"]))


@query(
    "match_predictions_with_a_hot_hour",
    """WITH hours AS (SELECT user_id, date_trunc('hour', min(ts)) AS t, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS pred
                      FROM events GROUP BY user_id),
    ids AS (SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN user_id ELSE 1 END AS user_id FROM events),
    runs AS (SELECT user_id, pred FROM hours WHERE user_id % 5 <> 2)
    SELECT id, coalesce(pred, 7.5) AS pred, pred IS NOT NULL AS matched FROM ids LEFT JOIN runs USING (user_id)""",
)
def match_predictions_with_a_hot_hour(spark, sf):
    """Two thirds of all requests ask for one key, which is split; the last of two runs counts."""
    events = table(spark, sf, "events")
    ids = events.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).otherwise(1).alias("user_id"))
    last = events.groupBy("user_id").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("pred")).where("user_id % 5 <> 2")
    runs = last.withColumn("run", F.lit(2)).unionByName(last.select("user_id", (F.col("pred") - 9).alias("pred"), F.lit(1).alias("run")))
    return match_predictions(ids, runs, ["user_id"], 7.5, order="run", broadcast_rows=0, hot_rows=500, salts=8).select("id", "pred", "matched")
