"""Profiles of a panel, its splits and its windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.operators.quantiles import exact_quantiles

QUARTILES = {0.25: "q25", 0.5: "median", 0.75: "q75"}


def describe_by_split(df: DataFrame, col: str, split: str = "split") -> DataFrame:
    """Mean, sample deviation, extremes and exact quartiles per split.

    Quartiles of many rows take several scans: stage ``df`` first if it is costly.
    """
    moments = df.groupBy(split).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"),
    )
    q = exact_quantiles(df, [col], list(QUARTILES), by=[split])
    quartiles = q.groupBy(split).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in QUARTILES.items()
    ])
    return moments.join(quartiles, split).select(
        split, "mean", "std", "min", "q25", "median", "q75", "max"
    )


def null_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("split",)) -> DataFrame:
    """Missing cells as rows ``(by, column, missing)``."""
    wide = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in cols])
    return wide.select(*by, F.inline(entries))


def extent(df: DataFrame, t: str = "t", split: str = "split") -> DataFrame:
    """Rows, columns and time range per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.min(t).alias("first"), F.max(t).alias("last"),
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values in order."""
    return df.select(key).distinct().orderBy(key)


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_distinct(key).alias("n"))


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)


def scaler_check(df: DataFrame, cols: Sequence[str], split: str = "split") -> DataFrame:
    """Mean and deviation of normalised columns: 0 and 1 on the rows they were fitted on."""
    aggs = [a for c in cols for a in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]
    return df.groupBy(split).agg(*aggs)


def window_profile(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Windows, their shape, target range and missing cells."""
    missing = F.aggregate(
        F.flatten("x"), F.lit(0).cast("long"),
        lambda n, v: n + F.when(v.isNull() | F.isnan(v), 1).otherwise(0),
    )
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("windows"),
        F.max(F.size("x")).alias("steps"),
        F.max(F.size(F.element_at("x", 1))).alias("features"),
        F.min("y_raw").alias("y_min"), F.max("y_raw").alias("y_max"), F.avg("y_raw").alias("y_mean"),
        F.sum(missing).alias("missing"),
    )


def key_sample(df: DataFrame, cols: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order, key columns only."""
    return df.select(*cols).orderBy(*order).limit(n)


def in_key_order(df: DataFrame, series: str, t: str) -> DataFrame:
    return df.orderBy(series, t)
