"""How many rows a task gets, whatever the size of the tables.

A panel packs well: 64 MB of shuffled rows, Spark's usual share, can be some 20 million rows in memory, and a fixed number
of partitions gets more of them as the tables grow. So shuffles start with a partition for so many rows, and adaptive
execution puts only small ones together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 400_000
PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
DEFAULT_PARTS = "spark.sql.shuffle.partitions"
LIMITS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20, "spark.sql.files.maxPartitionBytes": 16 << 20}


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions in which each holds about ``TASK_ROWS`` of ``rows``, and never fewer than the session's."""
    return max(int(spark.conf.get(DEFAULT_PARTS)), -(-rows // TASK_ROWS))


def bounded_shares(df: DataFrame, rows: int = 0) -> DataFrame:
    """Lower what a task reads from files and shuffles, let shuffles begin with enough partitions for ``rows``, and give back ``df``.

    The settings are read when a job runs, so they stay; they are never loosened.
    """
    spark = df.sparkSession
    for setting, limit in LIMITS.items():
        if _bytes(spark.conf.get(setting)) > limit:
            spark.conf.set(setting, str(limit))
    parts = parts_for(spark, rows)
    if parts > int(spark.conf.get(PARTS, None) or spark.conf.get(DEFAULT_PARTS)):
        spark.conf.set(PARTS, str(parts))
    return df
