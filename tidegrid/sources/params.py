"""Storing what was fitted: lookup tables, manifests and metric records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegrid.operators.compare import merge_metrics
from tidegrid.plans.dataset import Manifest
from tidegrid.plans.preprocess import Fitted

METRICS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("seconds", T.DoubleType()),
])


def _write_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_fitted(spark: SparkSession, fitted: Fitted, path: str) -> None:
    """The fitted bundle as a folder: parquet for the tables, JSON for the one-row values."""
    fitted.seasonal.write.parquet(f"{path}/seasonal")
    if fitted.modes is not None:
        fitted.modes.write.parquet(f"{path}/modes")
    values = {
        "medians": fitted.medians, "scaler": fitted.scaler, "has_modes": fitted.modes is not None,
    }
    _write_json(spark, values, f"{path}/values")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    values = _read_json(spark, f"{path}/values")
    modes = spark.read.parquet(f"{path}/modes") if values["has_modes"] else None
    seasonal = spark.read.parquet(f"{path}/seasonal")
    return Fitted(seasonal, modes, values["medians"], values["scaler"])


def save_scaler_by_series(fitted: DataFrame, series: str, cols: Sequence[str], path: str) -> None:
    """Per-series parameters as JSON lines ``{series, stats: {column: {mu, sigma}}}``."""
    stats = F.map_from_arrays(
        F.array(*[F.lit(c) for c in cols]),
        F.array(*[
            F.struct(F.col(f"{c}_mu").alias("mu"), F.col(f"{c}_sigma").alias("sigma")) for c in cols
        ]),
    )
    fitted.select(series, stats.alias("stats")).write.json(path)


def load_scaler_by_series(spark: SparkSession, series: str, cols: Sequence[str], path: str) -> DataFrame:
    schema = f"`{series}` string, stats map<string, struct<mu: double, sigma: double>>"
    rows = spark.read.schema(schema).json(path)
    return rows.select(series, *[
        F.col("stats")[c][v].alias(f"{c}_{v}") for c in cols for v in ("mu", "sigma")
    ])


def save_manifest(spark: SparkSession, manifest: Manifest, path: str) -> None:
    _write_json(spark, manifest.to_dict(), path)


def load_manifest(spark: SparkSession, path: str) -> Manifest:
    return Manifest(**_read_json(spark, path))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the metric records (empty if nothing was stored)."""
    schema = T.StructType([*METRICS, T.StructField("version", T.IntegerType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], METRICS)
    stored = spark.read.schema(schema).parquet(path)
    newest = stored.agg(F.max("version")).scalar()
    return stored.where(F.col("version") == newest).drop("version")


def _newest(spark: SparkSession, path: str) -> int:
    if not _exists(spark, path):
        return 0
    return spark.read.schema("version int").parquet(path).agg(F.max("version")).first()[0] or 0


def _commit(spark: SparkSession, written: str, version: str) -> bool:
    """Give a written folder its final name; false if another writer was first. One rename, which never replaces a folder."""
    jvm = spark._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (written, version))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(source).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(files.makeQualified(source), files.makeQualified(target), plain)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass()):
            files.delete(files.makeQualified(source), True)
            return False
        raise
    return True


def upsert_metrics(spark: SparkSession, path: str, new: DataFrame, tries: int = 20) -> DataFrame:
    """Read, replace the records of the same models, write as the next version.

    Versions are folders, so readers keep a whole set while one is being written. A set is written aside and then renamed
    to the version after the one it was merged with. Where another writer has taken that version, the
    records are merged with it and tried again, so no writer fails or loses another's records.
    """
    for _ in range(tries):
        newest = _newest(spark, path)
        merged = merge_metrics(read_metrics(spark, path), new.select(*METRICS.names))
        written = f"{path}/_{uuid.uuid4().hex}"
        merged.write.parquet(written)
        if _commit(spark, written, f"{path}/version={newest + 1}"):
            return read_metrics(spark, path)
    raise RuntimeError(f"other writers took the next version {tries} times")
