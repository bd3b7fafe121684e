"""Error metrics per model and the comparison against baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.errors import mae, rmse


def evaluate(
    df: DataFrame, models: dict[str, str], y: str = "y_raw", by: Sequence[str] = ("split",)
) -> DataFrame:
    """RMSE and MAE of ``{model: prediction column}`` over the same rows, one pass."""
    aggs = [
        F.struct(F.lit(m).alias("model"), rmse(y, p).alias("rmse"), mae(y, p).alias("mae"))
        for m, p in models.items()
    ]
    return df.groupBy(*by).agg(F.array(*aggs).alias("__m")).select(*by, F.inline("__m"))


def leaderboard(metrics: DataFrame, baselines: Sequence[str] = ("persistence", "ridge")) -> DataFrame:
    """Models by RMSE with their improvement over each baseline and whether they beat it."""
    refs = metrics.agg(F.struct(*[
        F.max(F.when(F.col("model") == b, F.col("rmse"))).alias(b) for b in baselines
    ]).alias("r")).scalar()
    ranked = metrics.withColumn("__r", refs)
    cols = []
    for b in baselines:
        gain = F.col("__r").getField(b) - F.col("rmse")
        cols += [gain.alias(f"gain_{b}"), (gain > 0).alias(f"beats_{b}")]
    return ranked.select("model", "rmse", "mae", *cols).orderBy("rmse", "model")


def best_model(metrics: DataFrame, among: Sequence[str] | None = None) -> DataFrame:
    """The model with the smallest RMSE."""
    rows = metrics.where(F.col("model").isin(list(among))) if among else metrics
    return rows.agg(F.min_by("model", "rmse").alias("model"), F.min("rmse").alias("rmse"))


def merge_metrics(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored records with those of the same model replaced."""
    return stored.join(new.select("model"), "model", "left_anti").unionByName(new)
