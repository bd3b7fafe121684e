"""Files: what is written is read back and compared with the tables it came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.fixtures import (
    BY_TYPE, FORECAST_CUTOFF, MEASURES, daily, hourly, sql_clean, sql_columns, sql_daily, sql_hourly,
    sql_split, table,
)
from panel_queries.q_stats import SQL_METRICS, SQL_PREDICTIONS, metrics, predictions
from panel_queries.q_windows import SQL_WINDOWS, request_rows, windows_by_user
from panel_queries.registry import query, r6, rounded, sql_r6, sql_rounded
from tidegrid.functions.calendar import split_at, with_timestamp
from tidegrid.functions.encoding import vocabulary
from tidegrid.functions.sequences import window_cell
from tidegrid.operators.fit import fit_scaler_by_key
from tidegrid.plans.dataset import manifest_short
from tidegrid.plans.preprocess import preprocess_fit
from tidegrid.sources.files import (
    cached_windows, lag_row_schema, panel_schema, read_clean, read_lag_rows, read_panel,
    read_predictions, read_windows, write_clean, write_predictions, write_windows,
)
from tidegrid.sources.params import (
    load_fitted, load_manifest, load_scaler_by_series, read_metrics, save_fitted, save_manifest,
    save_scaler_by_series, upsert_metrics,
)
from tidegrid.sources.stage import scratch_path

CUTOFF = FORECAST_CUTOFF


@query(
    "read_panel_csv",
    "WITH" + sql_hourly("user_id") + f" SELECT series, t, {sql_rounded()}, wd FROM panel",
)
def read_panel_csv(spark, sf):
    """The hourly panel as raw CSV: four time integers, ``NA`` for missing cells."""
    path = scratch_path(spark, "panel-csv")
    parts = [F.year("t").alias("year"), F.month("t").alias("month"), F.day("t").alias("day"),
             F.hour("t").alias("hour")]
    raw = hourly(spark, sf, "user_id").select(*parts, *MEASURES, "wd", F.col("series").alias("station"))
    raw.write.csv(path, header=True, nullValue="NA")
    rows = read_panel(spark, path, panel_schema(MEASURES), rename={"station": "series"})
    return with_timestamp(rows).select("series", "t", *rounded(), "wd")


@query(
    "read_lag_rows_csv",
    "WITH" + sql_hourly("event_type") + f""",
    l AS (SELECT series AS station, pos, CAST(lag(m1, 24) OVER w AS FLOAT) AS m1_lag_24,
                 CAST(lag(m3, 1) OVER w AS FLOAT) AS m3_lag_1 FROM panel
          WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT station, count(*) AS rows, count(m1_lag_24) AS seen, {sql_r6('avg(CAST(m1_lag_24 AS DOUBLE))')} AS m1_lag_24,
           {sql_r6('avg(CAST(m3_lag_1 AS DOUBLE))')} AS m3_lag_1 FROM l WHERE pos >= 24 GROUP BY station""",
)
def read_lag_rows_csv(spark, sf):
    path = scratch_path(spark, "lag-rows")
    request_rows(spark, sf, "event_type").write.csv(path, header=True, nullValue="NA")
    rows = read_lag_rows(spark, path, lag_row_schema(MEASURES, 24))
    return rows.groupBy("station").agg(
        F.count(F.lit(1)).alias("rows"), F.count("m1_lag_24").alias("seen"),
        r6(F.avg("m1_lag_24")).alias("m1_lag_24"), r6(F.avg("m3_lag_1")).alias("m3_lag_1"),
    )


@query("predictions_csv", SQL_PREDICTIONS + f" SELECT id, {sql_r6('recent')} AS pred FROM preds")
def predictions_csv(spark, sf):
    path = scratch_path(spark, "predictions")
    write_predictions(predictions(spark, sf), path, pred="recent")
    return read_predictions(spark, path).select("id", r6("pred").alias("pred"))


@query(
    "clean_panel_files",
    "WITH" + sql_daily("l_suppkey") + "," + sql_split("panel", "2000-01-01 00:00:00")
    + f" SELECT series, t, {sql_rounded()} FROM parts WHERE split = 'val'",
)
def clean_panel_files(spark, sf):
    """One folder per split: the filter reads only the files of ``val``."""
    path = scratch_path(spark, "clean")
    write_clean(split_at(daily(spark, sf, "l_suppkey"), "2000-01-01 00:00:00"), path)
    return read_clean(spark, path).where("split = 'val'").select("series", "t", *rounded())


def _split_windows(spark, sf):
    return split_at(windows_by_user(spark, sf, dense=True), CUTOFF, "target_dt")


SQL_STORED = SQL_WINDOWS + f""" SELECT series, target_dt,
CASE WHEN target_dt < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'val' END AS split,
{sql_rounded(['y_raw', 'first_m1', 'mid_m2'])} FROM wins"""


def _stored_columns(wins):
    return wins.select(
        "series", "target_dt", "split", r6("y_raw").alias("y_raw"),
        r6(window_cell("x", 1, 0)).alias("first_m1"), r6(window_cell("x", 12, 1)).alias("mid_m2"),
    )


@query("window_files", SQL_STORED)
def window_files(spark, sf):
    path = scratch_path(spark, "windows")
    write_windows(_split_windows(spark, sf), path)
    return _stored_columns(read_windows(spark, path))


@query("cached_windows", SQL_STORED)
def cached_windows_twice(spark, sf):
    """The first windows are of other settings, the second call makes them anew, the third finds them and builds nothing."""
    path, inputs = scratch_path(spark, "cache"), [table(spark, sf, "events")]
    cached_windows(spark, path, lambda: _split_windows(spark, sf).where("split = 'val'"), {"splits": ["val"]}, inputs)
    cached_windows(spark, path, lambda: _split_windows(spark, sf), {"splits": ["train", "val"]}, inputs)

    def again():
        raise AssertionError("the windows were stored already")

    return _stored_columns(cached_windows(spark, path, again, {"splits": ["train", "val"]}, inputs))


@query(
    "fitted_bundle",
    "WITH" + sql_clean("event_type", CUTOFF) + f"""
    SELECT s.series, s.month, s.hour, {sql_columns(sql_r6('s.@') + ' AS @')}, modes.wd,
           {sql_r6('med.m1')} AS median_m1, {sql_r6('m1_mean')} AS m1_mean, {sql_r6('m1_std')} AS m1_std
    FROM seasonal s JOIN modes ON s.series = modes.series, med, scaler""",
)
def fitted_bundle(spark, sf):
    path = scratch_path(spark, "fitted")
    _, fitted = preprocess_fit(hourly(spark, sf, "event_type"), BY_TYPE)
    save_fitted(spark, fitted, path)
    back = load_fitted(spark, path)
    return back.seasonal.join(back.modes, "series").select(
        "series", "month", "hour", *rounded(), "wd",
        r6(F.lit(back.medians["m1"])).alias("median_m1"),
        *[r6(F.lit(back.scaler[n])).alias(n) for n in ("m1_mean", "m1_std")],
    )


@query(
    "scaler_json",
    "WITH" + sql_daily("l_suppkey") + f"""
    SELECT series, {sql_columns(sql_r6('avg(@)') + ' AS @_mu, ' + sql_r6('stddev_samp(@) + 1e-8') + ' AS @_sigma')}
    FROM panel GROUP BY series""",
)
def scaler_json(spark, sf):
    path = scratch_path(spark, "scaler-json")
    fitted = fit_scaler_by_key(daily(spark, sf, "l_suppkey"), ["series"], MEASURES)
    save_scaler_by_series(fitted, "series", MEASURES, path)
    back = load_scaler_by_series(spark, "series", MEASURES, path)
    return back.select("series", *rounded([f"{c}{s}" for c in MEASURES for s in ("_mu", "_sigma")]))


@query(
    "feature_manifest",
    """SELECT 'm' || i || '_norm' AS feature FROM range(1, 4) r(i)
    UNION ALL SELECT unnest(['wd_sin', 'wd_cos', 'hour_sin', 'hour_cos', 'month_sin', 'month_cos'])
    UNION ALL SELECT DISTINCT 'st_' || event_type FROM events""",
)
def feature_manifest(spark, sf):
    """Feature order with the series found in the events, through a file and back."""
    path = scratch_path(spark, "manifest")
    types = table(spark, sf, "events").select(F.col("event_type").alias("series"))
    save_manifest(spark, manifest_short(BY_TYPE, vocabulary(types, "series")), path)
    names = load_manifest(spark, path).features
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query(
    "upsert_metrics",
    SQL_METRICS + f""" SELECT model, {sql_r6('rmse')} AS rmse, {sql_r6('mae')} AS mae,
    CASE WHEN model = 'half' THEN 2.0 ELSE 1.0 END AS seconds FROM metrics""",
)
def upsert_metrics_twice(spark, sf):
    """The record of one model is replaced, the others stay."""
    path = scratch_path(spark, "metrics")
    first = metrics(spark, sf).withColumn("seconds", F.lit(1.0))
    wrong = first.withColumn("rmse", F.when(F.col("model") == "half", F.lit(0.0)).otherwise(F.col("rmse")))
    upsert_metrics(spark, path, wrong)
    upsert_metrics(spark, path, first.where("model = 'half'").withColumn("seconds", F.lit(2.0)))
    return read_metrics(spark, path).select("model", *rounded(["rmse", "mae"]), "seconds")
