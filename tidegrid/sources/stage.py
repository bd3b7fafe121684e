"""Staged tables: small fits and shared intermediates written once to shared storage.

Writing cuts the lineage, so a lost executor re-reads a file instead of
recomputing the chain behind it, and it gives Catalyst a real size to plan with.
The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import lru_cache
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidegrid-stage-")


def stage_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


_created: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, remembered for :func:`clear_stages`."""
    path = f"{stage_dir(spark)}/tidegrid/{name}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def clear_stages(spark: SparkSession) -> int:
    """Delete the tables this process staged, once nothing reads them any more."""
    count = len(_created)
    while _created:
        path = spark._jvm.org.apache.hadoop.fs.Path(_created.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def stage(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table before the end; nothing may read it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        name = folder.rsplit("/", 1)[1]
        for path in [p for p in _created if p.rsplit("/", 1)[1] == name]:
            _created.remove(path)
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def one_row(df: DataFrame) -> dict[str, Any]:
    """The values of a one-row table of global parameters, for use as literals."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row of parameters, got {len(rows)}")
    return rows[0].asDict()
