"""Summary questions asked of a panel before modelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def correlation_with(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of each feature with the target, one pass."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.corr(c, target).alias("corr")) for c in features
    ]
    return df.agg(F.array(*pairs).alias("__p")).select(F.inline("__p"))


def weekday_means(df: DataFrame, t: str, cols: Sequence[str]) -> DataFrame:
    """Means of working days against those of weekends."""
    weekend = (F.weekday(t) >= 5).alias("weekend")
    return df.groupBy(weekend).agg(*[F.avg(c).alias(c) for c in cols])


def key_ranking(df: DataFrame, key: str, col: str) -> DataFrame:
    """Series by mean, highest first."""
    return df.groupBy(key).agg(F.avg(col).alias("mean")).orderBy(F.desc("mean"), key)
