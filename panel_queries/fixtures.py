"""Panels made from the given tables, as DataFrames and as SQL.

Averages are decimal sums divided by counts, so that their values do not depend on
the order in which rows are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegrid.functions.calendar import floor_to_step
from tidegrid.functions.encoding import COMPASS
from tidegrid.operators.densify import densify, series_spans
from tidegrid.plans.spec import PanelSpec, raw_rolling_features

HOUR, DAY = 3600, 86400
MEASURES = ["m1", "m2", "m3"]
FILL_CUTOFF = "2024-01-03 00:00:00"
FORECAST_CUTOFF = "2024-01-25 00:00:00"
DAILY_CUTOFF = "2000-01-01 00:00:00"

BY_TYPE = PanelSpec(
    measures=tuple(MEASURES), target="m1", wind="wd", cutoff=FORECAST_CUTOFF,
    rolling=raw_rolling_features("m1", ("m2", "m3")), dense=True,
)


SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def exact_avg(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))


def wind_name(e: Column) -> Column:
    """A compass name (or none) derived from an event number."""
    names = F.array(*[F.lit(n) for n in COMPASS])
    return F.when(e % 7 != 0, F.element_at(names, (e % 16 + 1).cast("int")))


def hourly_cells(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """Observed cells only: one row per series and hour with events."""
    k = F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int")
    return (
        table(spark, sf, "events")
        .select(F.col(key).cast("string").alias("series"), floor_to_step("ts", HOUR).alias("t"),
                "value", "event_id", k.alias("k"))
        .groupBy("series", "t")
        .agg(exact_avg("value").alias("m1"), F.max("value").alias("m2"),
             (F.sum("k").cast("double") / F.count(F.lit(1))).alias("m3"),
             wind_name(F.min("event_id")).alias("wd"))
    )


def hourly(spark: SparkSession, sf: str, key: str, span: str = "common") -> DataFrame:
    """Dense hourly panel of events per ``key``."""
    named = table(spark, sf, "events").select(F.col(key).cast("string").alias("series"), "ts")
    spans = series_spans(named, ["series"], "ts", HOUR, span)
    return densify(hourly_cells(spark, sf, key), ["series"], "t", HOUR, spans=spans)


def daily(spark: SparkSession, sf: str, key: str) -> DataFrame:
    """Dense daily panel of line items per ``key``."""
    items = table(spark, sf, "lineitem").select(
        F.col(key).cast("string").alias("series"), F.col("l_shipdate").alias("t"),
        "l_quantity", "l_extendedprice", "l_discount",
    )
    cells = items.groupBy("series", "t").agg(
        exact_avg("l_quantity").alias("m1"), exact_avg("l_extendedprice").alias("m2"),
        exact_avg("l_discount").alias("m3"),
    )
    spans = series_spans(items, ["series"], "t", DAY, "common")
    return densify(cells, ["series"], "t", DAY, spans=spans)


# ---------------------------------------------------------------------------
# The same as SQL: each function returns common table expressions ending in ``panel``.

SQL_COMPASS = "[" + ", ".join(f"'{n}'" for n in COMPASS) + "]"


def sql_hourly_cells(key: str) -> str:
    return f"""
ev AS (
  SELECT CAST({key} AS VARCHAR) AS series, date_trunc('hour', ts) AS t, value, event_id,
         CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
cells AS (
  SELECT series, t, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m1,
         max(value) AS m2, CAST(sum(k) AS DOUBLE) / count(*) AS m3,
         CASE WHEN min(event_id) % 7 <> 0 THEN {SQL_COMPASS}[min(event_id) % 16 + 1] END AS wd
  FROM ev GROUP BY series, t)"""


def _sql_grid(source: str, step: str, cols: str, span: str = "common") -> str:
    if span == "common":
        spans = f"""
spans AS (
  SELECT series, lo, hi FROM (SELECT DISTINCT series FROM {source}),
         (SELECT min(t) AS lo, max(t) AS hi FROM {source}))"""
    else:
        spans = f"""
spans AS (SELECT series, min(t) AS lo, max(t) AS hi FROM {source} GROUP BY series)"""
    return f"""{spans},
grid AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 {step})) AS t FROM spans),
panel AS (
  SELECT g.series, g.t, row_number() OVER (PARTITION BY g.series ORDER BY g.t) - 1 AS pos, {cols}
  FROM grid g LEFT JOIN cells c ON g.series = c.series AND g.t = c.t)"""


def sql_hourly(key: str, span: str = "common") -> str:
    return sql_hourly_cells(key) + "," + _sql_grid("ev", "HOUR", "m1, m2, m3, wd", span)


def sql_daily(key: str) -> str:
    return f"""
items AS (
  SELECT CAST({key} AS VARCHAR) AS series, l_shipdate AS t, l_quantity, l_extendedprice, l_discount
  FROM lineitem),
cells AS (
  SELECT series, t,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m1,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m2,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m3
  FROM items GROUP BY series, t),""" + _sql_grid("items", "DAY", "m1, m2, m3")


def sql_split(source: str, cutoff: str, name: str = "parts") -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN t < TIMESTAMP '{cutoff}' THEN 'train' ELSE 'val' END AS split,
         month(t) AS month, hour(t) AS hour
  FROM {source})"""


def sql_interpolate(
    source: str, cols: list[str], part: str, limit: int | None, rest: str, name: str = "filled"
) -> str:
    """Interpolation as SQL; ``rest`` lists the other columns to keep."""
    nb, out = [], []
    for c in cols:
        for side, frame in (("p", "UNBOUNDED PRECEDING AND 1 PRECEDING"),
                            ("n", "1 FOLLOWING AND UNBOUNDED FOLLOWING")):
            fn = "last_value" if side == "p" else "first_value"
            over = f"OVER (PARTITION BY {part} ORDER BY pos ROWS BETWEEN {frame})"
            nb.append(f"{fn}({c} IGNORE NULLS) {over} AS {c}_{side}v")
            nb.append(
                f"{fn}(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) {over} AS {c}_{side}p"
            )
        line = (f"CASE WHEN {c}_pp IS NULL THEN {c}_nv WHEN {c}_np IS NULL THEN {c}_pv "
                f"ELSE {c}_pv + ({c}_nv - {c}_pv) * (pos - {c}_pp) / ({c}_np - {c}_pp) END")
        if limit is not None:
            line = (f"CASE WHEN coalesce(pos - {c}_pp <= {limit}, false) "
                    f"OR coalesce({c}_np - pos <= {limit}, false) THEN {line} END")
        out.append(f"coalesce({c}, {line}) AS {c}")
    return f"""
{name}_nb AS (SELECT *, {', '.join(nb)} FROM {source}),
{name} AS (SELECT {rest}, {', '.join(out)} FROM {name}_nb)"""


def sql_columns(template: str, cols: list[str] = MEASURES, sep: str = ", ") -> str:
    """``template`` once per column, ``@`` standing for its name."""
    return sep.join(template.replace("@", c) for c in cols)


def sql_modes(source: str, name: str = "modes", col: str = "wd") -> str:
    return f"""
{name} AS (
  SELECT series, coalesce({col}, 'N') AS {col} FROM (
    SELECT series, {col}, row_number() OVER (
             PARTITION BY series ORDER BY ({col} IS NULL), n DESC, {col}) AS r
    FROM (SELECT series, {col}, count(*) AS n FROM {source} GROUP BY series, {col}))
  WHERE r = 1)"""


SQL_DEGREES = f"(nullif(list_position({SQL_COMPASS}, wd), 0) - 1) * 22.5"


def sql_seasonal_filled(key: str, cutoff: str) -> str:
    """Panel, split, capped interpolation per split, seasonal means of train: ``season_filled``."""
    return (
        sql_hourly(key) + "," + sql_split("panel", cutoff) + ","
        + sql_interpolate("parts", MEASURES, "split, series", 6, "series, t, pos, split, month, hour, wd")
        + f""",
seasonal AS (
  SELECT series, month, hour, {sql_columns('avg(@) AS @')}
  FROM filled WHERE split = 'train' GROUP BY series, month, hour),
season_filled AS (
  SELECT f.series, t, pos, split, f.month, f.hour, wd, {sql_columns('coalesce(f.@, s.@) AS @')}
  FROM filled f LEFT JOIN seasonal s
    ON f.series = s.series AND f.month = s.month AND f.hour = s.hour)"""
    )


def sql_clean(key: str, cutoff: str) -> str:
    """The whole train-fitted cleaning as SQL, ending in ``clean``."""
    return (
        sql_seasonal_filled(key, cutoff)
        + f""",
med AS (SELECT {sql_columns('median(@) AS @')} FROM season_filled WHERE split = 'train'),"""
        + sql_modes("(SELECT * FROM filled WHERE split = 'train')")
        + f""",
whole AS (
  SELECT s.series, t, pos, split, month, hour, coalesce(s.wd, modes.wd) AS wd,
         {sql_columns('coalesce(s.@, med.@) AS @')}
  FROM season_filled s LEFT JOIN modes ON s.series = modes.series, med),
scaler AS (
  SELECT {sql_columns('avg(@) AS @_mean, stddev_samp(@) AS @_std')} FROM whole WHERE split = 'train'),
clean AS (
  SELECT whole.*, sin(radians({SQL_DEGREES})) AS wd_sin, cos(radians({SQL_DEGREES})) AS wd_cos,
         {sql_columns('(@ - @_mean) / @_std AS @_norm')}
  FROM whole, scaler)"""
    )
