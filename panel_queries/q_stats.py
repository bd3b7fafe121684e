"""Normalisation, profiles and error metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.fixtures import (
    DAILY_CUTOFF, FILL_CUTOFF, MEASURES, daily, hourly, hourly_cells, sql_columns, sql_daily,
    sql_hourly, sql_hourly_cells, sql_split, table,
)
from panel_queries.registry import query, r6, rounded, sql_r6, sql_rounded
from tidegrid.functions.calendar import split_at
from tidegrid.functions.errors import huber, mse
from tidegrid.functions.scaling import inverse_scale
from tidegrid.operators.blocks import over_blocks
from tidegrid.operators.compare import best_model, evaluate, leaderboard
from tidegrid.operators.fit import (
    fit_scaler, fit_scaler_all, fit_scaler_by_key, scaler_long,
)
from tidegrid.operators.lookup import lookup_join
from tidegrid.operators.quantiles import exact_quantiles
from tidegrid.operators.scale import apply_scaler, apply_scaler_by_key, unmatched_keys
from tidegrid.operators.summaries import (
    describe_by_split, distinct_count, distinct_keys, extent, null_counts, scaler_check, value_counts,
)
from tidegrid.plans.analysis import correlation_with, key_ranking, weekday_means
from tidegrid.sources.stage import one_row, stage

FIRST_HOURS = "2024-01-01 06:00:00"
NORMS = [f"{c}_norm" for c in MEASURES]
# (train, val) of the daily supplier panel
SQL_PARTS = "WITH" + sql_daily("l_suppkey") + "," + sql_split("panel", DAILY_CUTOFF)
SQL_SCALER = f""",
scaler AS (SELECT {sql_columns('avg(@) AS @_mean, stddev_samp(@) AS @_std')}
           FROM parts WHERE split = 'train')"""


def parts(spark, sf):
    return split_at(daily(spark, sf, "l_suppkey"), DAILY_CUTOFF)


@query(
    "fit_scaler_train",
    SQL_PARTS + SQL_SCALER + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {sql_r6(c + '_mean')} AS mean, {sql_r6(c + '_std')} AS std FROM scaler"
        for c in MEASURES
    ) + ")",
)
def fit_scaler_train(spark, sf):
    fitted = fit_scaler(parts(spark, sf).where("split = 'train'"), MEASURES)
    return scaler_long(fitted, MEASURES).select("column", *rounded(["mean", "std"]))


@query(
    "fit_scaler_all_rows",
    "WITH" + sql_daily("l_suppkey") + f" SELECT {sql_columns(sql_r6('avg(@)', 9) + ' AS @_mean, ' + sql_r6('stddev_samp(@) + 1e-8', 9) + ' AS @_std')} FROM panel",
)
def fit_scaler_all_rows(spark, sf):
    fitted = fit_scaler_all(daily(spark, sf, "l_suppkey"), MEASURES)
    return fitted.select(*rounded([f"{c}{s}" for c in MEASURES for s in ("_mean", "_std")], 9))


SQL_BY_KEY = f"""
stats AS (SELECT series, {sql_columns('avg(@) AS @_mu, stddev_samp(@) + 1e-8 AS @_sigma')}
          FROM panel GROUP BY series)"""


@query(
    "fit_scaler_by_supplier",
    "WITH" + sql_daily("l_suppkey") + "," + SQL_BY_KEY
    + f" SELECT series, {sql_rounded([c + s for c in MEASURES for s in ('_mu', '_sigma')])} FROM stats",
)
def fit_scaler_by_supplier(spark, sf):
    fitted = fit_scaler_by_key(daily(spark, sf, "l_suppkey"), ["series"], MEASURES)
    return fitted.select("series", *rounded([f"{c}{s}" for c in MEASURES for s in ("_mu", "_sigma")]))


@query(
    "apply_scaler",
    SQL_PARTS + SQL_SCALER
    + f" SELECT series, t, {sql_columns(sql_r6('(@ - @_mean) / @_std') + ' AS @_norm')} FROM parts, scaler",
)
def apply_scaler_daily(spark, sf):
    df = parts(spark, sf)
    params = one_row(fit_scaler(df.where("split = 'train'"), MEASURES))
    return apply_scaler(df, params, MEASURES).select("series", "t", *rounded(NORMS))


@query(
    "apply_scaler_by_supplier",
    "WITH" + sql_daily("l_suppkey") + "," + SQL_BY_KEY
    + f""" SELECT p.series, t, {sql_columns(sql_r6('(@ - @_mu) / @_sigma') + ' AS @_norm')}
    FROM panel p JOIN stats s ON p.series = s.series""",
)
def apply_scaler_by_supplier(spark, sf):
    df = daily(spark, sf, "l_suppkey")
    fitted = stage(fit_scaler_by_key(df, ["series"], MEASURES), "scaler")
    scaled = apply_scaler_by_key(df, fitted, ["series"], MEASURES, salt="pos")
    return scaled.select("series", "t", *rounded(NORMS))


@query(
    "apply_scaler_by_supplier_salted",
    "WITH" + sql_daily("l_suppkey") + "," + SQL_BY_KEY
    + f""" SELECT p.series, t, {sql_r6('(m1 - m1_mu) / m1_sigma')} AS m1_norm
    FROM panel p JOIN stats s ON p.series = s.series""",
)
def apply_scaler_by_supplier_salted(spark, sf):
    """The join a table too large to broadcast gets: each series spread over salts."""
    df = daily(spark, sf, "l_suppkey")
    fitted = stage(fit_scaler_by_key(df, ["series"], ["m1"]), "scaler")
    joined = lookup_join(df, fitted, ["series"], salt="pos", broadcast_rows=0, hot_rows=1000, salts=8)
    return joined.select(
        "series", "t", r6((F.col("m1") - F.col("m1_mu")) / F.col("m1_sigma")).alias("m1_norm")
    )


@query(
    "inverse_scale",
    SQL_PARTS + SQL_SCALER
    + f" SELECT series, t, {sql_r6('(m1 - m1_mean) / m1_std * m1_std + m1_mean', 4)} AS m1 FROM parts, scaler",
)
def inverse_scale_daily(spark, sf):
    df = parts(spark, sf)
    params = one_row(fit_scaler(df.where("split = 'train'"), ["m1"]))
    scaled = apply_scaler(df, params, ["m1"])
    back = inverse_scale(F.col("m1_norm"), F.lit(params["m1_mean"]), F.lit(params["m1_std"]))
    return scaled.select("series", "t", r6(back, 4).alias("m1"))


@query(
    "series_without_parameters",
    "WITH" + sql_hourly_cells("user_id") + f"""
    SELECT series, count(*) AS rows FROM cells WHERE series NOT IN
      (SELECT series FROM cells WHERE t < TIMESTAMP '{FIRST_HOURS}') GROUP BY series""",
)
def series_without_parameters(spark, sf):
    """Users first seen after the first hours have no fitted parameters."""
    cells = split_at(hourly_cells(spark, sf, "user_id"), FIRST_HOURS)
    fitted = fit_scaler_by_key(cells.where("split = 'train'"), ["series"], ["m1"])
    return unmatched_keys(cells, fitted, ["series"])


@query(
    "describe_by_split",
    SQL_PARTS + f""" SELECT split, {sql_r6('avg(m2)', 4)} AS mean, {sql_r6('stddev_samp(m2)', 4)} AS std,
      min(m2) AS min, {sql_r6('quantile_cont(m2, 0.25)', 4)} AS q25, {sql_r6('median(m2)', 4)} AS median,
      {sql_r6('quantile_cont(m2, 0.75)', 4)} AS q75, max(m2) AS max FROM parts GROUP BY split""",
)
def describe_prices_by_split(spark, sf):
    d = describe_by_split(stage(parts(spark, sf), "panel", ["split"]), "m2")
    return d.select("split", *rounded(["mean", "std"], 4), "min", *rounded(["q25", "median", "q75"], 4), "max")


SQL_QUANTILES = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {p} AS prob, {sql_r6(f'quantile_cont(l_extendedprice, {p})')} AS value FROM lineitem"
    for p in ("0.001", "0.25", "0.5", "0.999")
) + ")"
PROBS = [0.001, 0.25, 0.5, 0.999]


def _quantiles(spark, sf, **options):
    q = exact_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], PROBS, **options)
    return q.select("prob", r6("value").alias("value"))


@query("exact_quantiles", SQL_QUANTILES)
def exact_quantiles_of_prices(spark, sf):
    return _quantiles(spark, sf)


@query("exact_quantiles_by_narrowing", SQL_QUANTILES)
def exact_quantiles_by_narrowing(spark, sf):
    """With coarse sketches, which leave many values between their ends to be counted."""
    return _quantiles(spark, sf, accuracy=50)


@query(
    "null_counts",
    "WITH" + sql_hourly("user_id") + "," + sql_split("panel", FILL_CUTOFF) + " SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT split, '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM parts GROUP BY split"
        for c in [*MEASURES, "wd"]
    ) + ")",
)
def null_counts_by_user(spark, sf):
    return null_counts(split_at(hourly(spark, sf, "user_id"), FILL_CUTOFF), [*MEASURES, "wd"])


@query(
    "extent_by_split",
    SQL_PARTS + """ SELECT split, count(*) AS rows, 7 AS columns, min(t) AS first, max(t) AS last
    FROM parts GROUP BY split""",
)
def extent_by_split(spark, sf):
    return extent(parts(spark, sf))


@query("distinct_series", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS series FROM events ORDER BY 1")
def distinct_series(spark, sf):
    return distinct_keys(hourly_cells(spark, sf, "user_id"), "series")


@query("distinct_series_count", "SELECT count(DISTINCT user_id) AS n FROM events")
def distinct_series_count(spark, sf):
    return distinct_count(hourly_cells(spark, sf, "user_id"), "series")


@query(
    "value_counts",
    "WITH" + sql_hourly_cells("user_id") + " SELECT series, count(*) AS n FROM cells GROUP BY series ORDER BY n DESC",
)
def value_counts_by_user(spark, sf):
    return value_counts(hourly_cells(spark, sf, "user_id"), "series")


@query(
    "scaler_check",
    SQL_PARTS + SQL_SCALER + f""", scaled AS (
      SELECT split, {sql_columns('(@ - @_mean) / @_std AS @_norm')} FROM parts, scaler)
    SELECT split, {sql_columns(sql_r6('avg(@_norm)') + ' AS @_norm_mean, ' + sql_r6('stddev_samp(@_norm)') + ' AS @_norm_std')}
    FROM scaled GROUP BY split""",
)
def scaler_check_daily(spark, sf):
    df = parts(spark, sf)
    params = one_row(fit_scaler(df.where("split = 'train'"), MEASURES))
    check = scaler_check(apply_scaler(df, params, MEASURES), NORMS)
    return check.select("split", *rounded([f"{n}{s}" for n in NORMS for s in ("_mean", "_std")]))


# Two simple forecasts of every user-hour: the last value, and the mean of the last three.
SQL_PREDICTIONS = "WITH" + sql_hourly("user_id") + """,
whole AS (SELECT series, t, pos, coalesce(m1, 0) AS y FROM panel),
preds AS (SELECT series || '_' || strftime(t, '%Y-%m-%d %H:%M:%S') AS id, series, t AS target_dt, y,
                 lag(y) OVER (PARTITION BY series ORDER BY pos) AS last,
                 avg(y) OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent
          FROM whole QUALIFY last IS NOT NULL)"""


def predictions(spark, sf):
    return predictions_of(hourly(spark, sf, "user_id"))


def predictions_of(panel):
    whole = panel.select("series", "t", "pos", F.coalesce("m1", F.lit(0.0)).alias("y"))
    both = over_blocks(whole, ["series"], "pos", 3, lambda d, w: d.withColumns({
        "last": F.lag("y", 1).over(w), "recent": F.avg("y").over(w.rowsBetween(-3, -1)),
    }), dense=True).where(F.col("last").isNotNull())
    name = F.concat("series", F.lit("_"), F.date_format("t", "yyyy-MM-dd HH:mm:ss"))
    return both.select(name.alias("id"), "series", F.col("t").alias("target_dt"), "y", "last", "recent")


SQL_METRICS = SQL_PREDICTIONS + """,
metrics AS (
  SELECT 'persistence' AS model, sqrt(avg((y - last) * (y - last))) AS rmse, avg(abs(y - last)) AS mae FROM preds
  UNION ALL
  SELECT 'ridge', sqrt(avg((y - recent) * (y - recent))), avg(abs(y - recent)) FROM preds
  UNION ALL
  SELECT 'half', sqrt(avg((y - (last + recent) / 2) * (y - (last + recent) / 2))),
         avg(abs(y - (last + recent) / 2)) FROM preds)"""


def metrics(spark, sf):
    df = predictions(spark, sf).withColumn("half", (F.col("last") + F.col("recent")) / 2)
    return evaluate(df, {"persistence": "last", "ridge": "recent", "half": "half"}, y="y", by=[])


@query("evaluate_models", SQL_METRICS + f" SELECT model, {sql_rounded(['rmse', 'mae'])} FROM metrics")
def evaluate_models(spark, sf):
    return metrics(spark, sf).select("model", *rounded(["rmse", "mae"]))


@query(
    "evaluate_by_series",
    SQL_PREDICTIONS + f"""
    SELECT series, 'last' AS model, {sql_r6('sqrt(avg((y - last) * (y - last)))')} AS rmse,
           {sql_r6('avg(abs(y - last))')} AS mae FROM preds GROUP BY series
    UNION ALL
    SELECT series, 'recent', {sql_r6('sqrt(avg((y - recent) * (y - recent)))')},
           {sql_r6('avg(abs(y - recent))')} FROM preds GROUP BY series""",
)
def evaluate_by_series(spark, sf):
    scores = evaluate(predictions(spark, sf), {"last": "last", "recent": "recent"}, y="y", by=["series"])
    return scores.select("series", "model", *rounded(["rmse", "mae"]))


@query(
    "mse_and_huber",
    SQL_PREDICTIONS + f""", e AS (SELECT abs(y - recent) AS e FROM preds)
    SELECT {sql_r6('avg(e * e)')} AS mse,
           {sql_r6('avg(CASE WHEN e <= 1 THEN e * e / 2 ELSE e - 0.5 END)')} AS huber FROM e""",
)
def mse_and_huber(spark, sf):
    df = predictions(spark, sf)
    return df.agg(r6(mse("y", "recent")).alias("mse"), r6(huber("y", "recent")).alias("huber"))


@query(
    "leaderboard",
    SQL_METRICS + f""", refs AS (
      SELECT max(rmse) FILTER (model = 'persistence') AS p, max(rmse) FILTER (model = 'ridge') AS r FROM metrics)
    SELECT model, {sql_rounded(['rmse', 'mae'])}, {sql_r6('p - rmse')} AS gain_persistence,
           p - rmse > 0 AS beats_persistence, {sql_r6('r - rmse')} AS gain_ridge, r - rmse > 0 AS beats_ridge
    FROM metrics, refs ORDER BY rmse""",
)
def leaderboard_of_models(spark, sf):
    board = leaderboard(stage(metrics(spark, sf), "metrics"))
    return board.select(
        "model", *rounded(["rmse", "mae", "gain_persistence"]), "beats_persistence",
        *rounded(["gain_ridge"]), "beats_ridge",
    )


@query("best_model", SQL_METRICS + f" SELECT model, {sql_r6('rmse')} AS rmse FROM metrics ORDER BY metrics.rmse LIMIT 1")
def best_of_models(spark, sf):
    return best_model(metrics(spark, sf)).select("model", r6("rmse").alias("rmse"))


@query(
    "target_correlation",
    "WITH" + sql_daily("l_suppkey") + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {sql_r6(f'corr({c}, m1)')} AS corr FROM panel" for c in ["m2", "m3"]
    ) + ")",
)
def target_correlation(spark, sf):
    return correlation_with(daily(spark, sf, "l_suppkey"), "m1", ["m2", "m3"]).select(
        "feature", r6("corr").alias("corr")
    )


@query(
    "weekday_weekend_means",
    "WITH" + sql_daily("l_suppkey") + f"""
    SELECT isodow(t) >= 6 AS weekend, {sql_columns(sql_r6('avg(@)', 4) + ' AS @')} FROM panel GROUP BY 1""",
)
def weekday_weekend_means(spark, sf):
    return weekday_means(daily(spark, sf, "l_suppkey"), "t", MEASURES).select("weekend", *rounded(digits=4))


@query(
    "series_ranking",
    "WITH" + sql_daily("l_suppkey") + f"""
    SELECT series, {sql_r6('avg(m2)', 4)} AS mean FROM panel GROUP BY series ORDER BY avg(m2) DESC""",
)
def series_ranking(spark, sf):
    return key_ranking(daily(spark, sf, "l_suppkey"), "series", "m2").select("series", r6("mean", 4).alias("mean"))
