"""Regular grids, interpolation and tiered filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.fixtures import (
    FILL_CUTOFF, HOUR, MEASURES, hourly, hourly_cells, sql_clean, sql_columns, sql_hourly,
    sql_hourly_cells, sql_interpolate, sql_modes, sql_seasonal_filled, sql_split, daily, table, sql_daily,
)
from panel_queries.registry import query, r6, rounded, sql_r6
from tidegrid.functions.calendar import floor_to_step, split_at, with_calendar_parts
from tidegrid.operators.densify import densify
from tidegrid.operators.blocks import with_position
from tidegrid.operators.fill import fit_series_means, fill_scalar, mean_fill, mode_fill, seasonal_fill
from tidegrid.operators.fit import fit_median, fit_mode, fit_seasonal
from tidegrid.operators.interpolate import fill_edges, interpolate
from tidegrid.plans.preprocess import TIER, preprocess_fit
from tidegrid.plans.spec import PanelSpec
from tidegrid.sources.stage import one_row, stage

SQL_R6 = sql_columns(sql_r6("@") + " AS @")
SEASON = ["series", "month", "hour"]
BY_USER = PanelSpec(measures=tuple(MEASURES), target="m1", wind="wd", cutoff=FILL_CUTOFF)


@query(
    "densify_hourly_by_user",
    "WITH" + sql_hourly("user_id") + f" SELECT series, t, pos, {SQL_R6}, wd FROM panel",
)
def densify_hourly_by_user(spark, sf):
    return hourly(spark, sf, "user_id").select("series", "t", "pos", *rounded(), "wd")


@query(
    "densify_own_span_by_user",
    "WITH" + sql_hourly("user_id", "series") + f" SELECT series, t, pos, {SQL_R6}, wd FROM panel",
)
def densify_own_span_by_user(spark, sf):
    return hourly(spark, sf, "user_id", span="series").select("series", "t", "pos", *rounded(), "wd")


@query(
    "row_position_by_user",
    "WITH" + sql_hourly_cells("user_id")
    + " SELECT series, t, row_number() OVER (PARTITION BY series ORDER BY t) - 1 AS pos FROM cells",
)
def row_position_by_user(spark, sf):
    """Positions of rows that are not on a full grid, numbered by time slice."""
    cells = stage(hourly_cells(spark, sf, "user_id"), "cells")
    return with_position(cells, ["series"], "t", HOUR, size=168).select("series", "t", "pos")


@query(
    "interpolate_capped_by_user",
    "WITH" + sql_hourly("user_id") + ","
    + sql_interpolate("panel", MEASURES, "series", 6, "series, t, pos")
    + f" SELECT series, t, {SQL_R6} FROM filled",
)
def interpolate_capped_by_user(spark, sf):
    df = interpolate(hourly(spark, sf, "user_id"), ["series"], "pos", MEASURES, limit=6)
    return df.select("series", "t", *rounded())


@query(
    "interpolate_in_blocks_by_user",
    "WITH" + sql_hourly("user_id") + ","
    + sql_interpolate("panel", MEASURES, "series", 6, "series, t, pos")
    + f" SELECT series, t, {SQL_R6} FROM filled",
)
def interpolate_in_blocks_by_user(spark, sf):
    """The same with blocks of a day, as long series get it: summaries carry the neighbours."""
    df = interpolate(hourly(spark, sf, "user_id"), ["series"], "pos", MEASURES, limit=6, size=24)
    return df.select("series", "t", *rounded())


@query(
    "interpolate_uncapped_by_user",
    "WITH" + sql_hourly("user_id") + ","
    + sql_interpolate("panel", MEASURES, "series", None, "series, t, pos")
    + f" SELECT series, t, {SQL_R6} FROM filled",
)
def interpolate_uncapped_by_user(spark, sf):
    df = interpolate(hourly(spark, sf, "user_id"), ["series"], "pos", MEASURES, limit=None)
    return df.select("series", "t", *rounded())


@query(
    "forward_backward_fill_by_user",
    "WITH" + sql_hourly("user_id") + f"""
    SELECT series, t, {sql_columns(sql_r6('''coalesce(@,
      last_value(@ IGNORE NULLS) OVER (PARTITION BY series ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      first_value(@ IGNORE NULLS) OVER (PARTITION BY series ORDER BY pos
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))''') + ' AS @')} FROM panel""",
)
def forward_backward_fill_by_user(spark, sf):
    return fill_edges(hourly(spark, sf, "user_id"), ["series"], "pos", MEASURES).select("series", "t", *rounded())


def _interpolated_by_split(spark, sf, key="user_id", cutoff=FILL_CUTOFF):
    df = with_calendar_parts(split_at(hourly(spark, sf, key), cutoff))
    return stage(interpolate(df, ["split", "series"], "pos", MEASURES, limit=6), "interpolated", ["split"])


@query(
    "fit_seasonal_by_user",
    "WITH" + sql_seasonal_filled("user_id", FILL_CUTOFF)
    + f" SELECT series, month, hour, {SQL_R6} FROM seasonal",
)
def fit_seasonal_by_user(spark, sf):
    train = _interpolated_by_split(spark, sf).where("split = 'train'")
    return fit_seasonal(train, SEASON, MEASURES).select(*SEASON, *rounded())


@query(
    "seasonal_fill_by_user",
    "WITH" + sql_seasonal_filled("user_id", FILL_CUTOFF)
    + f" SELECT series, t, split, {SQL_R6} FROM season_filled",
)
def seasonal_fill_by_user(spark, sf):
    df = _interpolated_by_split(spark, sf)
    lookup = stage(fit_seasonal(df.where("split = 'train'"), SEASON, MEASURES), "seasonal")
    return seasonal_fill(df, lookup, SEASON, MEASURES, salt="pos").select("series", "t", "split", *rounded())


@query(
    "fit_median_by_user",
    "WITH" + sql_clean("user_id", FILL_CUTOFF) + f" SELECT {SQL_R6} FROM med",
)
def fit_median_by_user(spark, sf):
    df = _interpolated_by_split(spark, sf)
    lookup = stage(fit_seasonal(df.where("split = 'train'"), SEASON, MEASURES), "seasonal")
    filled = seasonal_fill(df, lookup, SEASON, MEASURES, salt="pos")
    return fit_median(filled.where("split = 'train'"), MEASURES).select(*rounded())


@query(
    "median_fill_by_user",
    "WITH" + sql_hourly("user_id") + "," + sql_split("panel", FILL_CUTOFF) + f""",
    med AS (SELECT {sql_columns('median(@) AS @')} FROM parts WHERE split = 'train')
    SELECT series, t, {sql_columns(sql_r6('coalesce(p.@, med.@)') + ' AS @')} FROM parts p, med""",
)
def median_fill_by_user(spark, sf):
    df = stage(split_at(hourly(spark, sf, "user_id"), FILL_CUTOFF), "panel", ["split"])
    medians = one_row(fit_median(df.where("split = 'train'"), MEASURES))
    return fill_scalar(df, medians, MEASURES).select("series", "t", *rounded())


@query(
    "fit_mode_wind_by_user",
    "WITH" + sql_hourly("user_id") + "," + sql_modes("panel") + " SELECT series, wd FROM modes",
)
def fit_mode_wind_by_user(spark, sf):
    return fit_mode(hourly(spark, sf, "user_id"), ["series"], "wd")


@query(
    "mode_fill_wind_by_user",
    "WITH" + sql_hourly("user_id") + "," + sql_modes("panel") + """
    SELECT p.series, t, coalesce(p.wd, m.wd) AS wd FROM panel p LEFT JOIN modes m ON p.series = m.series""",
)
def mode_fill_wind_by_user(spark, sf):
    df = hourly(spark, sf, "user_id").select("series", "t", "pos", "wd")
    modes = stage(fit_mode(hourly_cells(spark, sf, "user_id"), ["series"], "wd"), "modes")
    return mode_fill(df, modes, ["series"], "wd", salt="pos").select("series", "t", "wd")


@query(
    "mean_fill_by_user",
    "WITH" + sql_hourly("user_id") + f""",
    late AS (SELECT series, t, pos, {sql_columns('''CASE WHEN t >= TIMESTAMP '2024-01-03'
             AND NOT (@ > 300) THEN @ END AS @''')} FROM panel),
    by_series AS (SELECT series, t, {sql_columns('coalesce(@, avg(@) OVER (PARTITION BY series)) AS @')}
                  FROM late),
    overall AS (SELECT {sql_columns('avg(@) AS @')} FROM by_series)
    SELECT series, t, {sql_columns(sql_r6('coalesce(b.@, o.@)', 9) + ' AS @')} FROM by_series b, overall o""",
)
def mean_fill_by_user(spark, sf):
    """Series mean, then overall mean, after masking early and extreme readings."""
    masked = {
        c: F.when((F.col("t") >= F.lit("2024-01-03").cast("timestamp_ntz")) & ~(F.col(c) > 300), F.col(c))
        for c in MEASURES
    }
    df = hourly(spark, sf, "user_id").withColumns(masked)
    means = stage(fit_series_means(df, ["series"], MEASURES), "means")
    return mean_fill(df, ["series"], MEASURES, means, salt="pos").select("series", "t", *rounded(digits=9))


@query(
    "clean_panel_by_user",
    "WITH" + sql_clean("user_id", FILL_CUTOFF) + f"""
    SELECT series, t, split, wd, {sql_columns(sql_r6('@') + ' AS @',
                                              MEASURES + ['wd_sin', 'wd_cos'] + [m + '_norm' for m in MEASURES])}
    FROM clean""",
)
def clean_panel_by_user(spark, sf):
    """All tiers, wind encoding and normalisation, fitted on train and applied to both splits."""
    clean, _ = preprocess_fit(hourly(spark, sf, "user_id"), BY_USER)
    cols = [*MEASURES, "wd_sin", "wd_cos", *BY_USER.norms]
    return clean.select("series", "t", "split", "wd", *[r6(c).alias(c) for c in cols])


@query(
    "fill_tier_counts_by_user",
    "WITH" + sql_seasonal_filled("user_id", FILL_CUTOFF) + ", " + ", ".join(
        f"""t_{c} AS (
        SELECT p.split, '{c}' AS measure, CASE WHEN p.{c} IS NOT NULL THEN 0 WHEN f.{c} IS NOT NULL THEN 1
               WHEN s.{c} IS NOT NULL THEN 2 ELSE 3 END AS tier
        FROM parts p JOIN filled f ON p.series = f.series AND p.t = f.t
        JOIN season_filled s ON p.series = s.series AND p.t = s.t)"""
        for c in MEASURES
    ) + " SELECT split, measure, tier, count(*) AS cells FROM ("
    + " UNION ALL ".join(f"SELECT * FROM t_{c}" for c in MEASURES)
    + ") GROUP BY split, measure, tier",
)
def fill_tier_counts_by_user(spark, sf):
    """How many cells each imputation tier filled."""
    clean, _ = preprocess_fit(hourly(spark, sf, "user_id"), BY_USER)
    tiers = F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c + TIER).alias("tier")) for c in MEASURES
    ])
    rows = clean.select("split", F.inline(tiers))
    return rows.groupBy("split", "measure", "tier").agg(F.count(F.lit(1)).alias("cells"))


@query(
    "densify_rows_between_steps",
    "WITH" + sql_hourly_cells("user_id") + """,
    first AS (SELECT series, t, min(ts) AS ts FROM (SELECT CAST(user_id AS VARCHAR) AS series, date_trunc('hour', ts) AS t, ts FROM events)
              GROUP BY series, t),
    spans AS (SELECT series, min(t) AS lo, max(t) AS hi FROM first GROUP BY series),
    grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM spans)
    SELECT g.series, g.t, """ + sql_r6("c.m1") + """ AS m1 FROM grid g LEFT JOIN cells c ON g.series = c.series AND g.t = c.t""",
)
def densify_rows_between_steps(spark, sf):
    """Rows at the time of their first event, not at full hours, keep their cells."""
    first = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("series"), floor_to_step("ts", HOUR).alias("t"), "ts")
    first = first.groupBy("series", "t").agg(F.min("ts").alias("ts"))
    cells = hourly_cells(spark, sf, "user_id").join(first, ["series", "t"]).select("series", F.col("ts").alias("t"), "m1")
    return densify(stage(cells, "cells"), ["series"], "t", HOUR).select("series", "t", r6("m1").alias("m1"))


@query(
    "seasonal_fill_daily_by_month",
    "WITH" + sql_daily("l_suppkey") + f""",
    seasonal AS (SELECT series, month(t) AS month, {sql_columns('avg(@) AS @')} FROM panel GROUP BY ALL)
    SELECT p.series, p.t, {", ".join(sql_r6(f"coalesce(p.{c}, s.{c}) + 1e-9") + f" AS {c}" for c in MEASURES)}
    FROM panel p LEFT JOIN seasonal s ON p.series = s.series AND month(p.t) = s.month""",
)
def seasonal_fill_daily_by_month(spark, sf):
    """Seasonal means over months that do vary."""
    panel = stage(daily(spark, sf, "l_suppkey").withColumn("month", F.month("t")), "panel")
    seasonal = stage(fit_seasonal(panel, ["series", "month"], MEASURES), "seasonal")
    filled = seasonal_fill(panel, seasonal, ["series", "month"], MEASURES, salt="pos")
    # means that end in 5 at the seventh place would round either way, as sums differ in their last bit
    return filled.select("series", "t", *[r6(F.col(c) + 1e-9).alias(c) for c in MEASURES])
