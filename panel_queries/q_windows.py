"""Sliding windows, their splits, and functions over the steps of a window."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from panel_queries.fixtures import (
    BY_TYPE, FORECAST_CUTOFF, MEASURES, hourly, sql_clean, sql_columns, sql_hourly, sql_interpolate,
    sql_modes, SQL_DEGREES,
)
from panel_queries.registry import query, r6, rounded, sql_r6, sql_rounded
from tidegrid.functions.calendar import split_at
from tidegrid.functions.errors import mae, rmse
from tidegrid.functions.sequences import (
    explode_windows, flatten_window, in_window_rolling, last_step, lags_to_sequence, window_cell,
)
from tidegrid.operators.fit import fit_scaler_by_key
from tidegrid.operators.lagrows import lag_rows_to_windows
from tidegrid.operators.summaries import value_counts, window_profile
from tidegrid.operators.windows import (
    last_step_pairs, persistence, series_lengths, sliding_windows, split_by_fraction,
)
from tidegrid.plans.dataset import (
    all_rows_windows, long_windows, manifest_all_rows, manifest_long, manifest_short, short_windows,
)
from tidegrid.plans.preprocess import prepare_all_rows, preprocess_fit
from tidegrid.sources.stage import stage

VOCAB = ["click", "error", "purchase", "signup", "view"]
W = 24


def filled_by_user(spark, sf):
    return hourly(spark, sf, "user_id").select("series", "t", "pos", *[
        F.coalesce(c, F.lit(0.0)).alias(c) for c in MEASURES
    ])


SQL_FILLED = "WITH" + sql_hourly("user_id") + f""",
whole AS (SELECT series, t, pos, {sql_columns('coalesce(@, 0) AS @')} FROM panel)"""


def windows_by_user(spark, sf, **options):
    return sliding_windows(
        filled_by_user(spark, sf), ["series"], "pos", "t", MEASURES, W, "m1", "m1", **options
    )


def _lagged(c: str, h: int) -> str:
    return f"lag(CAST({c} AS FLOAT), {h}) OVER (PARTITION BY series ORDER BY pos)"


SQL_WINDOWS = SQL_FILLED + f""",
wins AS (SELECT series, t AS target_dt, pos, CAST(m1 AS FLOAT) AS y_raw,
         {_lagged('m1', 24)} AS first_m1, {_lagged('m2', 13)} AS mid_m2, {_lagged('m3', 1)} AS last_m3
         FROM whole QUALIFY pos >= 24)"""


@query(
    "sliding_windows_by_user",
    SQL_WINDOWS + f""" SELECT series, target_dt, {sql_rounded(['y_raw', 'first_m1', 'mid_m2', 'last_m3'])},
    24 AS steps, 3 AS features FROM wins""",
)
def sliding_windows_by_user(spark, sf):
    """Windows of 24 hours, one per later hour; cells are taken out of the tensor to compare."""
    wins = windows_by_user(spark, sf)
    return wins.select(
        "series", "target_dt", r6("y_raw").alias("y_raw"),
        r6(window_cell("x", 1, 0)).alias("first_m1"), r6(window_cell("x", 12, 1)).alias("mid_m2"),
        r6(window_cell("x", -1, 2)).alias("last_m3"),
        F.size("x").alias("steps"), F.size(last_step("x")).alias("features"),
    )


@query(
    "sliding_windows_in_small_blocks",
    SQL_WINDOWS + f" SELECT series, target_dt, {sql_rounded(['y_raw', 'first_m1', 'mid_m2', 'last_m3'])} FROM wins",
)
def sliding_windows_in_small_blocks(spark, sf):
    wins = windows_by_user(spark, sf, size=30)
    return wins.select(
        "series", "target_dt", r6("y_raw").alias("y_raw"),
        r6(window_cell("x", 1, 0)).alias("first_m1"), r6(window_cell("x", 12, 1)).alias("mid_m2"),
        r6(window_cell("x", -1, 2)).alias("last_m3"),
    )


SQL_HOLES = "pos % 11 NOT IN (3, 4) AND pos NOT BETWEEN 100 AND 180"
SQL_HOLED_WINDOWS = SQL_FILLED + f""",
holed AS (SELECT * FROM whole WHERE {SQL_HOLES}),
wins AS (SELECT series, t AS target_dt, CAST(m1 AS FLOAT) AS y_raw, {_lagged('m1', 24)} AS first_m1,
         {_lagged('m2', 13)} AS mid_m2, {_lagged('m3', 1)} AS last_m3
         FROM holed QUALIFY row_number() OVER (PARTITION BY series ORDER BY pos) > 24)
SELECT series, target_dt, {sql_rounded(['y_raw', 'first_m1', 'mid_m2', 'last_m3'])} FROM wins"""


def _holed_windows(spark, sf, **options):
    panel = stage(filled_by_user(spark, sf).where(SQL_HOLES), "holed")
    wins = sliding_windows(panel, ["series"], "pos", "t", MEASURES, W, "m1", "m1", **options)
    return wins.select(
        "series", "target_dt", r6("y_raw").alias("y_raw"),
        r6(window_cell("x", 1, 0)).alias("first_m1"), r6(window_cell("x", 12, 1)).alias("mid_m2"),
        r6(window_cell("x", -1, 2)).alias("last_m3"),
    )


@query("windows_over_holes", SQL_HOLED_WINDOWS)
def windows_over_holes(spark, sf):
    """Rows were taken out after numbering: windows still count rows."""
    return _holed_windows(spark, sf)


@query("windows_over_holes_in_small_blocks", SQL_HOLED_WINDOWS)
def windows_over_holes_in_small_blocks(spark, sf):
    return _holed_windows(spark, sf, size=30)


@query(
    "windows_per_series",
    "WITH" + sql_hourly("user_id", "series")
    + " SELECT series, count(*) AS n FROM panel WHERE pos >= 24 GROUP BY series ORDER BY n DESC, series",
)
def windows_per_series(spark, sf):
    panel = hourly(spark, sf, "user_id", span="series")
    pairs = last_step_pairs(panel, ["series"], "pos", "t", ["m1"], W, "m1", "m1")
    return value_counts(pairs, "series")


@query(
    "last_step_of_windows",
    SQL_WINDOWS + f""" SELECT series, target_dt, {sql_rounded(['y_raw', 'last_m3'])} FROM wins""",
)
def last_step_of_windows(spark, sf):
    """The last step without the tensor, as linear models read it."""
    pairs = last_step_pairs(filled_by_user(spark, sf), ["series"], "pos", "t", MEASURES, W, "m1", "m1")
    return pairs.select(
        "series", "target_dt", r6("y_raw").alias("y_raw"), r6(F.element_at("x_last", 3)).alias("last_m3")
    )


@query(
    "flatten_windows",
    SQL_WINDOWS + f""" SELECT series, target_dt, 72 AS width, {sql_r6('mid_m2')} AS mid_m2 FROM wins""",
)
def flatten_windows(spark, sf):
    flat = windows_by_user(spark, sf).withColumn("flat", flatten_window("x"))
    return flat.select(
        "series", "target_dt", F.size("flat").alias("width"),
        r6(F.element_at("flat", 11 * 3 + 2)).alias("mid_m2"),
    )


@query(
    "explode_windows",
    "WITH" + sql_hourly("event_type") + f""",
    whole AS (SELECT series, t, pos, {sql_columns('coalesce(@, 0) AS @')} FROM panel),
    s AS (SELECT unnest(generate_series(0, 23)) AS step),
    long AS ({' UNION ALL '.join(
        f"SELECT a.series, step, '{c}' AS feature, CAST(b.{c} AS FLOAT) AS value FROM whole a, s, whole b "
        "WHERE a.pos >= 24 AND a.series = b.series AND b.pos = a.pos - 24 + step" for c in MEASURES)})
    SELECT series, CAST(step AS INTEGER) AS step, feature, count(*) AS n,
           {sql_r6('avg(CAST(value AS DOUBLE))')} AS mean FROM long GROUP BY series, step, feature""",
)
def explode_windows_by_type(spark, sf):
    whole = hourly(spark, sf, "event_type").fillna(0.0, subset=MEASURES)
    wins = sliding_windows(whole, ["series"], "pos", "t", MEASURES, W, "m1", "m1")
    long = explode_windows(wins, ["series", "target_dt"], MEASURES)
    return long.groupBy("series", "step", "feature").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg(F.col("value").cast("double"))).alias("mean")
    )


@query(
    "window_profile",
    "WITH" + sql_hourly("event_type") + f""",
    parts AS (SELECT *, CASE WHEN t < TIMESTAMP '{FORECAST_CUTOFF}' THEN 'train' ELSE 'val' END AS split,
                     (m1 IS NULL)::INT + (m2 IS NULL)::INT + (m3 IS NULL)::INT AS holes FROM panel),
    wins AS (SELECT split, CAST(m1 AS FLOAT) AS y, row_number() OVER w AS r,
                    sum(holes) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS holes
             FROM parts WINDOW w AS (PARTITION BY split, series ORDER BY pos))
    SELECT split, count(*) AS windows, 24 AS steps, 3 AS features, {sql_r6('min(y)')} AS y_min,
           {sql_r6('max(y)')} AS y_max, {sql_r6('avg(CAST(y AS DOUBLE))')} AS y_mean,
           CAST(sum(holes) AS BIGINT) AS missing
    FROM wins WHERE r > 24 GROUP BY split""",
)
def window_profile_by_type(spark, sf):
    panel = split_at(hourly(spark, sf, "event_type"), FORECAST_CUTOFF)
    wins = sliding_windows(panel, ["split", "series"], "pos", "t", MEASURES, W, "m1", "m1")
    profile = window_profile(wins)
    return profile.select(
        "split", "windows", "steps", "features", *rounded(["y_min", "y_max", "y_mean"]), "missing"
    )


@query(
    "split_by_fraction",
    "WITH" + sql_hourly("user_id", "series") + """
    SELECT series, t, CASE WHEN pos >= floor(count(*) OVER (PARTITION BY series) * (1::DOUBLE - 0.15::DOUBLE))
           THEN 'val' ELSE 'train' END AS split FROM panel""",
)
def split_by_fraction_by_user(spark, sf):
    panel = hourly(spark, sf, "user_id", span="series").select("series", "t", "pos")
    lengths = stage(series_lengths(panel, ["series"]), "lengths")
    return split_by_fraction(panel, ["series"], "pos", lengths, 0.15).select("series", "t", "split")


@query(
    "persistence_last_fraction",
    SQL_FILLED + f""",
    p AS (SELECT series, t, m1, lag(m1) OVER (PARTITION BY series ORDER BY pos) AS pred,
                 pos >= greatest(floor(count(*) OVER (PARTITION BY series) * (1::DOUBLE - 0.15::DOUBLE)), 1) AS val
          FROM whole)
    SELECT {sql_r6('sqrt(avg((m1 - pred) * (m1 - pred)))')} AS rmse, {sql_r6('avg(abs(m1 - pred))')} AS mae,
           count(*) AS n FROM p WHERE val""",
)
def persistence_last_fraction(spark, sf):
    """Persistence on the last 15 % of every user's hours."""
    whole = filled_by_user(spark, sf)
    lengths = stage(series_lengths(whole.select("series"), ["series"]), "lengths")
    scored = persistence(whole, ["series"], "pos", "m1")
    val = split_by_fraction(scored, ["series"], "pos", lengths).where("split = 'val' and pred is not null")
    return val.agg(
        r6(rmse("m1", "pred")).alias("rmse"), r6(mae("m1", "pred")).alias("mae"),
        F.count(F.lit(1)).alias("n"),
    )


# ---------------------------------------------------------------------------
# The variants' data sets, on the hourly panel of event types

SHORT = manifest_short(BY_TYPE, VOCAB)


@query(
    "windows_short_variant",
    "WITH" + sql_clean("event_type", FORECAST_CUTOFF) + f""",
    f AS (SELECT split, series, t, row_number() OVER w AS r, CAST(m1_norm AS FLOAT) AS y_norm,
                 CAST(m1 AS FLOAT) AS y_raw, CAST(lag(m2_norm, 24) OVER w AS FLOAT) AS first_m2,
                 CAST(lag(wd_cos, 1) OVER w AS FLOAT) AS last_wd_cos,
                 CAST(lag(sin(2 * pi() * hour / 24), 1) OVER w AS FLOAT) AS last_hour_sin
          FROM clean WINDOW w AS (PARTITION BY split, series ORDER BY pos))
    SELECT split, series, t AS target_dt, 24 AS steps, 14 AS features,
           {sql_rounded(['y_norm', 'y_raw', 'first_m2', 'last_wd_cos', 'last_hour_sin'], 4)},
           CASE WHEN series = 'error' THEN 1.0 ELSE 0.0 END AS is_error
    FROM f WHERE r > 24""",
)
def windows_short_variant(spark, sf):
    """Clean panel, calendar and series indicators, windows of 24 within each split."""
    clean, _ = preprocess_fit(hourly(spark, sf, "event_type"), BY_TYPE)
    wins = short_windows(clean, BY_TYPE, SHORT)

    def cell(step, name):
        return window_cell("x", step, SHORT.features.index(name))

    return wins.select(
        "split", "series", "target_dt", F.size("x").alias("steps"),
        F.size(last_step("x")).alias("features"), *rounded(["y_norm", "y_raw"], 4),
        r6(cell(1, "m2_norm"), 4).alias("first_m2"), r6(cell(-1, "wd_cos"), 4).alias("last_wd_cos"),
        r6(cell(-1, "hour_sin"), 4).alias("last_hour_sin"),
        cell(5, "st_error").cast("double").alias("is_error"),
    )


LONG = manifest_long(BY_TYPE, VOCAB)
LONG_CELLS = {"m1_lag6": 48, "m1_rmean12": 48, "m1_rstd6": 1, "m1_rmax24": 1, "is_weekend": 1, "dow_cos": 10}


@query(
    "windows_long_variant",
    "WITH" + sql_clean("event_type", FORECAST_CUTOFF) + f""",
    e AS (SELECT *, coalesce(lag(m1_norm, 6) OVER w, 0) AS m1_lag6,
                 avg(m1_norm) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS m1_rmean12,
                 coalesce(stddev_samp(m1_norm) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 0) AS m1_rstd6,
                 max(m1_norm) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS m1_rmax24,
                 CASE WHEN isodow(t) >= 6 THEN 1 ELSE 0 END AS is_weekend,
                 cos(2 * pi() * (isodow(t) - 1) / 7) AS dow_cos
          FROM clean WINDOW w AS (PARTITION BY split, series ORDER BY pos)),
    f AS (SELECT split, series, t AS target_dt, row_number() OVER w AS r,
                 {', '.join(f'CAST(lag({c}, {h}) OVER w AS FLOAT) AS {c}' for c, h in LONG_CELLS.items())}
          FROM e WINDOW w AS (PARTITION BY split, series ORDER BY pos))
    SELECT split, series, target_dt, 48 AS steps, 32 AS features, {sql_rounded(list(LONG_CELLS), 4)}
    FROM f WHERE r > 48""",
)
def windows_long_variant(spark, sf):
    """48 steps with lag and rolling features of the normalised target, in one exchange."""
    clean, _ = preprocess_fit(hourly(spark, sf, "event_type"), BY_TYPE)
    wins = long_windows(clean, BY_TYPE, LONG)
    return wins.select(
        "split", "series", "target_dt", F.size("x").alias("steps"),
        F.size(last_step("x")).alias("features"),
        *[r6(window_cell("x", 49 - h, LONG.features.index(c)), 4).alias(c) for c, h in LONG_CELLS.items()],
    )


ALL_ROWS = manifest_all_rows(BY_TYPE, VOCAB)
ALL_CELLS = {"m3_norm": 24, "wd_sin": 1, "m1_roll_mean_6_norm": 1, "m1_roll_std_6_norm": 24,
             "m1_diff_1_norm": 1, "m2_roll_mean_6_norm": 2}
ROLLED = ["m1_roll_mean_6", "m1_roll_std_6", "m1_diff_1", "m2_roll_mean_6"]


def _sql_all_rows(per_series: bool) -> str:
    scaled = [*MEASURES, *ROLLED]
    part = "PARTITION BY series" if per_series else ""
    norms = ", ".join(
        f"({c} - avg({c}) OVER ({part})) / (stddev_samp({c}) OVER ({part}) + 1e-8) AS {c}_norm" for c in scaled
    )
    return (
        "WITH" + sql_hourly("event_type") + ","
        + sql_interpolate("panel", MEASURES, "series", None, "series, t, pos, wd") + ","
        + sql_modes("panel") + f""",
    e AS (SELECT f.series, t, pos, m1, m2, m3, coalesce(f.wd, modes.wd) AS wd,
                 avg(m1) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS m1_roll_mean_6,
                 coalesce(stddev_samp(m1) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 0) AS m1_roll_std_6,
                 coalesce(m1 - lag(m1) OVER w, 0) AS m1_diff_1,
                 avg(m2) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS m2_roll_mean_6
          FROM filled f JOIN modes ON f.series = modes.series
          WINDOW w AS (PARTITION BY f.series ORDER BY pos)),
    n AS (SELECT *, sin(radians(coalesce({SQL_DEGREES}, 0))) AS wd_sin, {norms} FROM e),
    f AS (SELECT series, t AS target_dt, CAST(m1 AS FLOAT) AS y_raw,
                 CASE WHEN pos >= floor(count(*) OVER (PARTITION BY series) * 0.85::DOUBLE)
                      THEN 'val' ELSE 'train' END AS split, pos,
                 {', '.join(f'CAST(lag({c}, {h}) OVER w AS FLOAT) AS {c}' for c, h in ALL_CELLS.items())}
          FROM n WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT split, series, target_dt, 24 AS steps, 23 AS features, {sql_rounded(['y_raw', *ALL_CELLS], 4)}
    FROM f WHERE pos >= 24"""
    )


def _all_rows(spark, sf, per_series):
    prepared, _ = prepare_all_rows(hourly(spark, sf, "event_type"), BY_TYPE, per_series)
    wins = all_rows_windows(prepared, BY_TYPE, ALL_ROWS)
    return wins.select(
        "split", "series", "target_dt", F.size("x").alias("steps"),
        F.size(last_step("x")).alias("features"), r6("y_raw", 4).alias("y_raw"),
        *[r6(window_cell("x", 25 - h, ALL_ROWS.features.index(c)), 4).alias(c) for c, h in ALL_CELLS.items()],
    )


@query("windows_all_rows_global", _sql_all_rows(False))
def windows_all_rows_global(spark, sf):
    """Parameters of all rows, one set for all series; split by target position."""
    return _all_rows(spark, sf, per_series=False)


@query("windows_all_rows_per_series", _sql_all_rows(True))
def windows_all_rows_per_series(spark, sf):
    return _all_rows(spark, sf, per_series=True)


# ---------------------------------------------------------------------------
# Wide request rows: every window of the panel as one row of lagged columns


def request_rows(spark, sf, key="user_id"):
    """``id``, ``station`` and 24 lagged columns per measure; cells without events are missing."""
    panel = hourly(spark, sf, key)
    wins = sliding_windows(panel, ["series"], "pos", "t", MEASURES, W, "m1", "m1")
    lags = [
        window_cell("x", W + 1 - k, i).cast("double").alias(f"{c}_lag_{k}")
        for i, c in enumerate(MEASURES) for k in range(W, 0, -1)
    ]
    name = F.concat("series", F.lit("_"), F.date_format("target_dt", "yyyy-MM-dd HH:mm:ss"))
    return wins.select(name.alias("id"), F.col("series").alias("station"), *lags)


SQL_IDS = "series || '_' || strftime(t, '%Y-%m-%d %H:%M:%S') AS id"


@query(
    "lags_to_sequence",
    "WITH" + sql_hourly("user_id") + f""",
    l AS (SELECT {SQL_IDS}, pos,
                 coalesce({_lagged('m1', 24)}, 7.0) AS oldest, coalesce({_lagged('m1', 1)}, 7.0) AS newest
          FROM panel)
    SELECT id, {sql_rounded(['oldest', 'newest'], 3)}, 24 AS steps FROM l WHERE pos >= 24""",
)
def lags_to_sequence_of_requests(spark, sf):
    seq = lags_to_sequence("m1", W, F.lit(7.0))
    rows = request_rows(spark, sf).select("id", seq.alias("seq"))
    return rows.select(
        "id", r6(F.element_at("seq", 1), 3).alias("oldest"), r6(F.element_at("seq", -1), 3).alias("newest"),
        F.size("seq").alias("steps"),
    )


@query(
    "in_window_rolling",
    "WITH" + sql_hourly("event_type") + f""",
    v AS (SELECT series, t, pos, coalesce(CAST(m1 AS FLOAT), 7.0)::DOUBLE AS m1 FROM panel),
    l AS (SELECT {SQL_IDS}, pos, avg(m1) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS mean_last,
                 avg(m1) OVER (w ROWS BETWEEN 24 PRECEDING AND 22 PRECEDING) AS mean_third,
                 stddev_pop(m1) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS std_last,
                 stddev_pop(m1) OVER (w ROWS BETWEEN 24 PRECEDING AND 23 PRECEDING) AS std_second,
                 0.0 AS std_first, 0.0 AS diff_first, lag(m1, 1) OVER w - lag(m1, 2) OVER w AS diff_last
          FROM v WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT id, {sql_rounded(['mean_last', 'mean_third', 'std_last', 'std_second', 'std_first', 'diff_first',
                             'diff_last'], 4)}
    FROM l WHERE pos >= 24""",
)
def in_window_rolling_of_requests(spark, sf):
    """Rolling values inside the window: population deviation, cut at the window's start."""
    rows = request_rows(spark, sf, "event_type").select(
        "id", lags_to_sequence("m1", W, F.lit(7.0)).alias("seq")
    )
    seq = F.col("seq")
    rolled = rows.select(
        "id", in_window_rolling(seq, "mean", 6).alias("mean"), in_window_rolling(seq, "std", 6).alias("std"),
        in_window_rolling(seq, "diff").alias("diff"),
    )
    at = F.element_at
    return rolled.select(
        "id", r6(at("mean", -1), 4).alias("mean_last"), r6(at("mean", 3), 4).alias("mean_third"),
        r6(at("std", -1), 4).alias("std_last"), r6(at("std", 2), 4).alias("std_second"),
        r6(at("std", 1), 4).alias("std_first"), r6(at("diff", 1), 4).alias("diff_first"),
        r6(at("diff", -1), 4).alias("diff_last"),
    )


@query(
    "request_rows_to_windows",
    "WITH" + sql_hourly("event_type") + f""",
    s AS (SELECT series, {sql_columns('avg(@) AS @_mu, stddev_samp(@) + 1e-8 AS @_sigma')} FROM panel GROUP BY series),
    v AS (SELECT p.series, t, pos, {sql_columns('coalesce(CAST(@ AS FLOAT)::DOUBLE, @_mu) AS @, @_mu, @_sigma')}
          FROM panel p JOIN s ON p.series = s.series),
    l AS (SELECT {SQL_IDS}, series AS station, pos,
                 CAST((lag(m2, 24) OVER w - m2_mu) / m2_sigma AS FLOAT) AS first_m2,
                 CAST((avg(m1) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) - m1_mu) / m1_sigma AS FLOAT)
                   AS last_mean,
                 CAST((stddev_pop(m1) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) - m1_mu) / m1_sigma
                   AS FLOAT) AS last_std
          FROM v WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT id, station, 24 AS steps, 18 AS features, {sql_rounded(['first_m2', 'last_mean', 'last_std'], 4)},
           0.0 AS wd_sin, 1.0 AS wd_cos, CASE WHEN station = 'view' THEN 1.0 ELSE 0.0 END AS is_view
    FROM l WHERE pos >= 24""",
)
def request_rows_to_windows(spark, sf):
    """Model input from wide rows with per-series parameters."""
    rolling = {"m1_roll_mean_3": ("m1", "mean", 3), "m1_roll_std_6": ("m1", "std", 6)}
    fitted = fit_scaler_by_key(hourly(spark, sf, "event_type"), ["series"], MEASURES)
    for name in rolling:  # parameters of the source column stand in for those of the feature
        fitted = fitted.withColumns({
            f"{name}_mu": F.col("m1_mu"), f"{name}_sigma": F.col("m1_sigma")
        })
    fitted = stage(fitted.withColumnRenamed("series", "station"), "scaler")
    wins = lag_rows_to_windows(
        request_rows(spark, sf, "event_type"), MEASURES, rolling, VOCAB, W, by_series=fitted
    )
    return wins.select(
        "id", "station", F.size("x").alias("steps"), F.size(last_step("x")).alias("features"),
        r6(window_cell("x", 1, 1), 4).alias("first_m2"), r6(window_cell("x", -1, 11), 4).alias("last_mean"),
        r6(window_cell("x", -1, 12), 4).alias("last_std"),
        window_cell("x", 3, 3).cast("double").alias("wd_sin"),
        window_cell("x", 3, 4).cast("double").alias("wd_cos"),
        window_cell("x", 3, 17).cast("double").alias("is_view"),
    )


REQUEST_ROLLING = {"m1_roll_mean_3": ("m1", "mean", 3), "m1_roll_std_6": ("m1", "std", 6)}
SQL_PARTS = {"hour": ("hour(@)", 24, 0), "month": ("month(@)", 12, 1), "dow": ("(dayofweek(@) + 6) % 7", 7, 0)}


def _sql_circle(part: str, at: str) -> str:
    value, period, first = SQL_PARTS[part]
    angle = f"2 * pi() * ({value.replace('@', at)} - {first}) / {period}"
    return f"{sql_r6(f'sin({angle})', 4)} AS {part}_sin, {sql_r6(f'cos({angle})', 4)} AS {part}_cos"


@query(
    "request_rows_with_calendar",
    "WITH" + sql_hourly("event_type") + f""",
    s AS (SELECT {sql_columns('avg(@) AS @_mean, stddev_samp(@) + 1e-8 AS @_std')} FROM panel),
    v AS (SELECT series, t, pos, wd, {sql_columns('coalesce(CAST(@ AS FLOAT)::DOUBLE, @_mean) AS @, @_mean, @_std')} FROM panel, s),
    l AS (SELECT {SQL_IDS}, pos, t - INTERVAL 22 HOUR AS step_at, lag(wd, 22) OVER w AS wd,
                 CAST((lag(m3, 22) OVER w - m3_mean) / m3_std AS FLOAT) AS third_m3,
                 CAST((avg(m1) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) - (m1_mean + 1)) / (m1_std * 2) AS FLOAT) AS last_mean,
                 CAST((stddev_pop(m1) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) - (m1_mean + 2)) / (m1_std * 3) AS FLOAT) AS last_std
          FROM v WINDOW w AS (PARTITION BY series ORDER BY pos))
    SELECT id, {sql_rounded(['third_m3', 'last_mean', 'last_std'], 4)},
           {sql_r6(f'sin(radians(coalesce({SQL_DEGREES}, 0)))', 4)} AS wd_sin, {sql_r6(f'cos(radians(coalesce({SQL_DEGREES}, 0)))', 4)} AS wd_cos,
           {_sql_circle('hour', 'step_at')}, {_sql_circle('month', 'step_at')}, {_sql_circle('dow', 'step_at')}
    FROM l WHERE pos >= 24""",
)
def request_rows_with_calendar(spark, sf):
    """Model input with global parameters, lagged wind and calendar parts, and own parameters of each feature."""
    panel = stage(hourly(spark, sf, "event_type"), "panel")
    params = panel.agg(*[f(c).alias(c + n) for c in MEASURES for f, n in (
        (F.avg, "_mean"), (lambda x: F.stddev_samp(x) + 1e-8, "_std"))]).first().asDict()
    for i, name in enumerate(REQUEST_ROLLING, 1):
        params[f"{name}_mean"], params[f"{name}_std"] = params["m1_mean"] + i, params["m1_std"] * (i + 1)
    rows = request_rows(spark, sf, "event_type").withColumn(
        "t", F.to_timestamp_ntz(F.substring_index("id", "_", -1), F.lit("yyyy-MM-dd HH:mm:ss")))
    parts = {"hour": F.hour, "month": F.month, "dow": lambda t: (F.dayofweek(t) + 5) % 7}
    rows = rows.withColumns({f"{p}_lag_{k}": f(F.col("t") - F.expr(f"INTERVAL '{k}' HOUR"))
                             for p, f in parts.items() for k in range(W, 0, -1)})
    wind = Window.partitionBy("series").orderBy("pos")  # five short series
    winds = panel.select(F.col("series").alias("station"), "t", *[
        F.lag("wd", k).over(wind).alias(f"wd_lag_{k}") for k in range(W, 0, -1)])
    wins = lag_rows_to_windows(rows.join(winds, ["station", "t"]), MEASURES, REQUEST_ROLLING, VOCAB, W, params=params)
    cells = {"third_m3": (3, 2), "last_mean": (-1, 11), "last_std": (-1, 12), "wd_sin": (3, 3), "wd_cos": (3, 4),
             "hour_sin": (3, 5), "hour_cos": (3, 6), "month_sin": (3, 7), "month_cos": (3, 8), "dow_sin": (3, 9), "dow_cos": (3, 10)}
    return wins.select("id", *[r6(window_cell("x", *at), 4).alias(n) for n, at in cells.items()])
