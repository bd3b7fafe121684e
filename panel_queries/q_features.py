"""Calendar, categorical, lag and rolling features."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.fixtures import (
    FORECAST_CUTOFF, MEASURES, SQL_DEGREES, daily, hourly, hourly_cells, sql_columns,
    sql_daily, sql_hourly, sql_hourly_cells, table,
)
from panel_queries.registry import query, r6, rounded, sql_r6, sql_rounded
from tidegrid.functions.calendar import (
    calendar_features, cyclical, day_of_week_features, is_weekend, split_at, with_calendar_parts,
    with_timestamp,
)
from tidegrid.functions.encoding import circular_encode, compass_degrees, one_hot, one_hot_auto
from tidegrid.functions.scaling import clip_lower, feature_frame, fill_residual, null_if_nan
from tidegrid.operators.onehot import sparse_one_hot, vocabulary_index
from tidegrid.sources.stage import stage
from tidegrid.operators.rolling import rolling_features
from tidegrid.operators.score import target_time
from tidegrid.operators.summaries import in_key_order, key_sample

PI2 = "(2 * pi())"


@query(
    "timestamp_from_parts",
    """SELECT event_id, date_trunc('hour', ts) AS t FROM events""",
)
def timestamp_from_parts(spark, sf):
    parts = table(spark, sf, "events").select(
        "event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
        F.day("ts").alias("day"), F.hour("ts").alias("hour"),
    )
    return with_timestamp(parts).select("event_id", "t")


@query(
    "calendar_parts",
    "SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour FROM events",
)
def calendar_parts(spark, sf):
    return with_calendar_parts(table(spark, sf, "events"), "ts").select("event_id", "month", "hour")


@query(
    "split_at_cutoff",
    f"""SELECT event_id, CASE WHEN ts < TIMESTAMP '{FORECAST_CUTOFF}' THEN 'train' ELSE 'val' END AS split
        FROM events""",
)
def split_at_cutoff(spark, sf):
    return split_at(table(spark, sf, "events"), FORECAST_CUTOFF, "ts").select("event_id", "split")


@query(
    "compass_degrees",
    "WITH" + sql_hourly_cells("user_id") + f"""
    SELECT series, t, wd, {SQL_DEGREES} AS degrees, coalesce({SQL_DEGREES}, 0.0) AS degrees_or_north FROM cells""",
)
def compass_degrees_of_cells(spark, sf):
    return hourly_cells(spark, sf, "user_id").select(
        "series", "t", "wd", compass_degrees("wd").alias("degrees"),
        compass_degrees("wd", default=0.0).alias("degrees_or_north"),
    )


@query(
    "circular_wind",
    "WITH" + sql_hourly_cells("user_id") + f"""
    SELECT series, t, {sql_r6(f'sin(radians({SQL_DEGREES}))')} AS wd_sin,
           {sql_r6(f'cos(radians({SQL_DEGREES}))')} AS wd_cos FROM cells""",
)
def circular_wind(spark, sf):
    wd_sin, wd_cos = circular_encode(compass_degrees("wd"))
    return hourly_cells(spark, sf, "user_id").select(
        "series", "t", r6(wd_sin).alias("wd_sin"), r6(wd_cos).alias("wd_cos")
    )


CALENDAR = ["hour_sin", "hour_cos", "month_sin", "month_cos"]


@query(
    "cyclical_calendar",
    f"""WITH c AS (
      SELECT event_id, sin({PI2} * hour(ts) / 24) AS hour_sin, cos({PI2} * hour(ts) / 24) AS hour_cos,
             sin({PI2} * (month(ts) - 1) / 12) AS month_sin, cos({PI2} * (month(ts) - 1) / 12) AS month_cos
      FROM events)
    SELECT event_id, {sql_rounded(CALENDAR)} FROM c""",
)
def cyclical_calendar(spark, sf):
    df = table(spark, sf, "events").withColumns(calendar_features("ts"))
    return df.select("event_id", *rounded(CALENDAR))


@query(
    "cyclical_month_of_orders",
    f"""SELECT l_orderkey, l_linenumber, {sql_r6(f'sin({PI2} * (month(l_shipdate) - 1) / 12)')} AS month_sin,
               {sql_r6(f'cos({PI2} * (month(l_shipdate) - 1) / 12)')} AS month_cos FROM lineitem""",
)
def cyclical_month_of_orders(spark, sf):
    month_sin, month_cos = cyclical(F.month("l_shipdate"), 12, offset=1)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r6(month_sin).alias("month_sin"), r6(month_cos).alias("month_cos")
    )


@query(
    "day_of_week",
    f"""SELECT l_orderkey, l_linenumber,
               {sql_r6(f'sin({PI2} * (isodow(l_shipdate) - 1) / 7)')} AS dow_sin,
               {sql_r6(f'cos({PI2} * (isodow(l_shipdate) - 1) / 7)')} AS dow_cos,
               CASE WHEN isodow(l_shipdate) >= 6 THEN 1.0 ELSE 0.0 END::FLOAT AS is_weekend
        FROM lineitem""",
)
def day_of_week(spark, sf):
    df = table(spark, sf, "lineitem").withColumns(day_of_week_features("l_shipdate"))
    return df.select(
        "l_orderkey", "l_linenumber", *rounded(["dow_sin", "dow_cos"]),
        is_weekend("l_shipdate").alias("is_weekend"),
    )


TYPES = ["click", "purchase", "signup", "view"]


@query(
    "one_hot_fixed",
    f"""SELECT event_id, {', '.join(f"(event_type = '{v}')::INT::FLOAT AS st_{v}" for v in TYPES)} FROM events""",
)
def one_hot_fixed(spark, sf):
    """A vocabulary without ``error``: its rows are all zero."""
    return table(spark, sf, "events").select("event_id", *[
        e.alias(n) for n, e in one_hot("event_type", TYPES).items()
    ])


@query(
    "one_hot_discovered",
    f"""SELECT event_id,
        {', '.join(f"(event_type = '{v}')::INT::FLOAT AS st_{v}" for v in [*TYPES, 'error'])} FROM events""",
)
def one_hot_discovered(spark, sf):
    df = table(spark, sf, "events")
    return df.select("event_id", *[e.alias(n) for n, e in one_hot_auto(df, "event_type").items()])


@query(
    "clip_lower",
    f"SELECT l_orderkey, l_linenumber, {sql_r6('greatest(l_extendedprice - 30000, 0)')} AS x FROM lineitem",
)
def clip_lower_prices(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r6(clip_lower(F.col("l_extendedprice") - 30000)).alias("x")
    )


@query(
    "fill_residual",
    "WITH" + sql_hourly("event_type") + f" SELECT series, t, {sql_columns(sql_r6('coalesce(@, 0)') + ' AS @')} FROM panel",
)
def fill_residual_by_type(spark, sf):
    return fill_residual(hourly(spark, sf, "event_type"), MEASURES).select("series", "t", *rounded())


@query(
    "nan_to_null",
    """SELECT event_id, CASE WHEN value >= 100 THEN value END AS value FROM events""",
)
def nan_to_null(spark, sf):
    x = F.when(F.col("value") < 100, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", null_if_nan(x).alias("value"))


@query(
    "feature_frame",
    "WITH" + sql_hourly_cells("user_id") + """
    SELECT series, t, CAST(m3 AS FLOAT) AS m3, CAST(m1 AS FLOAT) AS m1 FROM cells""",
)
def feature_frame_by_user(spark, sf):
    return feature_frame(hourly_cells(spark, sf, "user_id"), ["m3", "m1"], keep=["series", "t"])


@query(
    "target_time_of_request",
    "SELECT event_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS target_dt FROM events",
)
def target_time_of_request(spark, sf):
    """Requests with two context hours each; the target follows the last one."""
    ts = F.col("ts")
    earlier = ts - F.expr("INTERVAL 1 HOUR")
    parts = {"year": F.year, "month": F.month, "day": F.day, "hour": F.hour}
    wide = table(spark, sf, "events").select(
        "event_id",
        *[fn(x).alias(f"{p}_lag_{k}") for k, x in ((2, earlier), (1, ts)) for p, fn in parts.items()],
    )
    return target_time(wide).select("event_id", "target_dt")


@query(
    "key_sample",
    "WITH" + sql_hourly_cells("user_id") + " SELECT series, t, m1 FROM cells ORDER BY series, t LIMIT 5",
)
def key_sample_by_user(spark, sf):
    return key_sample(hourly_cells(spark, sf, "user_id"), ["series", "t", "m1"], ["series", "t"], 5)


@query(
    "key_order",
    "WITH" + sql_daily("l_suppkey") + " SELECT series, t, m1 FROM panel ORDER BY series, t",
)
def key_order(spark, sf):
    return in_key_order(daily(spark, sf, "l_suppkey"), "series", "t").select("series", "t", "m1")


@query(
    "union_of_panels",
    "WITH" + sql_hourly_cells("user_id") + """,
    a AS (SELECT 'user' AS kind, series, t, m1 FROM cells),
    b AS (SELECT 'type' AS kind, event_type AS series, date_trunc('hour', ts) AS t,
                 CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m1
          FROM events GROUP BY event_type, date_trunc('hour', ts))
    SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def union_of_panels(spark, sf):
    def named(kind, key):
        return hourly_cells(spark, sf, key).select(F.lit(kind).alias("kind"), "series", "t", "m1")

    return named("user", "user_id").unionByName(named("type", "event_type"))


def _over(rows: int) -> str:
    return f"OVER (PARTITION BY series ORDER BY pos ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


LAGS = {f"m1_lag{h}": ("m1", "lag", h) for h in (1, 2, 3, 6, 12, 24)}
MEANS = {f"m1_rmean{w}": ("m1", "mean", w) for w in (3, 6, 12, 24)}
STDS = {f"m1_rstd{w}": ("m1", "std", w) for w in (3, 6, 12)}
MAXS = {f"m1_rmax{w}": ("m1", "max", w) for w in (6, 24)}
DIFFS = {f"{c}_diff_1": (c, "diff", 1) for c in MEASURES}


def _sql_feature(c: str, kind: str, n: int) -> str:
    lag = f"lag({c}, {n}) OVER (PARTITION BY series ORDER BY pos)"
    return {
        "lag": f"coalesce({lag}, 0)",
        "mean": f"avg({c}) {_over(n)}",
        "std": f"coalesce(stddev_samp({c}) {_over(n)}, 0)",
        "max": f"max({c}) {_over(n)}",
        "diff": f"coalesce({c} - {lag}, 0)",
    }[kind]


def _sql_rolling(features: dict) -> str:
    cols = ", ".join(f"{_sql_feature(*f)} AS {n}" for n, f in features.items())
    return (
        "WITH" + sql_daily("l_suppkey") + f", f AS (SELECT series, t, {cols} FROM panel) "
        f"SELECT series, t, {sql_rounded(list(features))} FROM f"
    )


def _rolling(spark, sf, features, **options):
    df = rolling_features(daily(spark, sf, "l_suppkey"), ["series"], "pos", features, **options)
    return df.select("series", "t", *rounded(list(features)))


@query("lag_features_daily", _sql_rolling(LAGS))
def lag_features_daily(spark, sf):
    return _rolling(spark, sf, LAGS)


@query("rolling_mean_daily", _sql_rolling(MEANS))
def rolling_mean_daily(spark, sf):
    return _rolling(spark, sf, MEANS)


@query("rolling_std_daily", _sql_rolling(STDS))
def rolling_std_daily(spark, sf):
    return _rolling(spark, sf, STDS)


@query("rolling_max_daily", _sql_rolling(MAXS))
def rolling_max_daily(spark, sf):
    return _rolling(spark, sf, MAXS)


@query("diff_daily", _sql_rolling(DIFFS))
def diff_daily(spark, sf):
    return _rolling(spark, sf, DIFFS)


@query("rolling_all_in_small_blocks", _sql_rolling({**LAGS, **MEANS, **STDS, **MAXS}))
def rolling_all_in_small_blocks(spark, sf):
    """All features of the 48-step variant in one pass, with blocks of 64 rows."""
    return _rolling(spark, sf, {**LAGS, **MEANS, **STDS, **MAXS}, size=64)


@query("rolling_over_holes", "WITH" + sql_daily("l_suppkey") + ", holed AS (SELECT * FROM panel WHERE pos % 7 <> 5), f AS (SELECT series, t, "
       + ", ".join(f"{_sql_feature(*f)} AS {n}" for n, f in {**LAGS, **MEANS}.items())
       + f" FROM holed) SELECT series, t, {sql_rounded(list({**LAGS, **MEANS}))} FROM f")
def rolling_over_holes(spark, sf):
    """Frames count rows, also where every seventh position is missing, in blocks of 50."""
    features = {**LAGS, **MEANS}
    panel = daily(spark, sf, "l_suppkey").where("pos % 7 <> 5").select("series", "t", "pos", "m1")
    return rolling_features(stage(panel, "holed"), ["series"], "pos", features, size=50).select("series", "t", *rounded(list(features)))


@query(
    "one_hot_sparse_by_part",
    """WITH v AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS i, count(*) OVER () AS size
               FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 10))
    SELECT l_orderkey, l_linenumber, (SELECT max(size) FROM v) AS size, i AS place, CASE WHEN i IS NULL THEN 0 ELSE 1 END AS ones
    FROM lineitem LEFT JOIN v USING (l_partkey)""",
)
def one_hot_sparse_by_part(spark, sf):
    """A vocabulary as wide as the parts, of some rows only; the others may hold values that were not seen."""
    items = table(spark, sf, "lineitem")
    index = vocabulary_index(items.where("l_quantity > 10"), "l_partkey")
    coded = sparse_one_hot(items, "l_partkey", index, salt="l_orderkey")
    return coded.select("l_orderkey", "l_linenumber", F.col("one_hot.size").alias("size"),
                        F.try_element_at("one_hot.indices", F.lit(1)).alias("place"),
                        F.aggregate("one_hot.values", F.lit(0), lambda n, v: n + v.cast("int")).alias("ones"))
