"""Readers and writers for panels, request rows, predictions, clean panels and windows."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegrid.functions.scaling import null_if_nan

# Raw column names of the air-quality panel and our names for them.
RAW_MEASURES = {
    "PM2.5": "pm25", "PM10": "pm10", "SO2": "so2", "NO2": "no2", "CO": "co", "O3": "o3",
    "TEMP": "temp", "PRES": "pres", "DEWP": "dewp", "RAIN": "rain", "WSPM": "wspm",
}
RAW_TARGET = "PM2.5"


def panel_schema(
    measures: Sequence[str] = tuple(RAW_MEASURES), wind: str | None = "wd", series: str = "station"
) -> T.StructType:
    """Hourly rows: four time integers, the measures, wind direction and series name."""
    fields = [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour")]
    fields += [T.StructField(c, T.DoubleType()) for c in measures]
    if wind:
        fields.append(T.StructField(wind, T.StringType()))
    return T.StructType([*fields, T.StructField(series, T.StringType())])


# What readers of data frames usually take for a missing cell.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, rename: Mapping[str, str] = {}) -> DataFrame:  # noqa: B006
    """Headed CSV with an explicit schema; missing-value tokens and NaN become NULL in every column.

    Numbers are read as text and cast, since one token in a numeric column would spoil its row.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.csv(path, header=True, schema=as_text, enforceSchema=False)

    def cell(f: T.StructField):
        text = F.trim(F.col(f"`{f.name}`"))
        value = F.when(~text.isin(MISSING), F.col(f"`{f.name}`") if f.dataType == T.StringType() else text)
        value = value if f.dataType == T.StringType() else value.cast(f.dataType)
        return (null_if_nan(value) if f.dataType == T.DoubleType() else value).alias(rename.get(f.name, f.name))

    return raw.select(*[cell(f) for f in schema])


def read_panel(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    rename: Mapping[str, str] = RAW_MEASURES,
) -> DataFrame:
    """Raw hourly CSV with header; missing-value tokens, empty and NaN cells become NULL.

    With an explicit schema nothing is inferred, and only the columns used are parsed.
    """
    return _read_csv(spark, path, schema or panel_schema(), rename)


def lag_row_schema(
    features: Sequence[str], window: int = 24, parts: Sequence[str] = (), wind: str | None = None
) -> T.StructType:
    """Wide request rows: ``id``, ``station`` and ``<feature>_lag_W … _lag_1`` per feature."""
    fields = [T.StructField("id", T.StringType()), T.StructField("station", T.StringType())]
    for names, kind in ((features, T.DoubleType()), (parts, T.IntegerType()),
                        ([wind] if wind else [], T.StringType())):
        fields += [
            T.StructField(f"{c}_lag_{k}", kind) for c in names for k in range(window, 0, -1)
        ]
    return T.StructType(fields)


def read_lag_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Wide request rows; missing cells, in whatever usual spelling, become NULL."""
    return _read_csv(spark, path, schema)


def write_predictions(df: DataFrame, path: str, pred: str = "pred", target: str = RAW_TARGET,
                      partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """``id`` and the prediction as headed CSV; a blend grid is split by ``partition_by``."""
    out = df.select(*partition_by, "id", F.col(pred).alias(target))
    out.write.partitionBy(*partition_by).mode(mode).csv(path, header=True)


def read_predictions(spark: SparkSession, path: str, pred: str = "pred", target: str = RAW_TARGET) -> DataFrame:
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(target, T.DoubleType())])
    return _read_csv(spark, path, schema, {target: pred})


def write_clean(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A clean panel, one folder per split, so that reading a split reads only its files."""
    df.write.partitionBy("split").mode(mode).parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Files of so many splits are open in a task at once. Without it every task sorts its tensors by split first.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def write_windows(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Window tensors with targets and target times, one folder per split."""
    conf = df.sparkSession.conf
    before = {name: conf.get(name, None) for name in OPEN_FILES}
    for name, value in OPEN_FILES.items():
        conf.set(name, value)
    try:
        df.write.partitionBy("split").option("compression", "zstd").mode(mode).parquet(path)
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def input_state(df: DataFrame) -> list[tuple[str, int, int]]:
    """Path, length and time of change of every file that ``df`` reads, from listings of their folders."""
    spark = df.sparkSession
    files = sorted(df.inputFiles())
    found = []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        for status in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            found.append((status.getPath().toUri().getPath(), status.getLen(), status.getModificationTime()))
    read = {unquote(urlsplit(f).path) for f in files}
    return sorted(f for f in found if f[0] in read)


def fingerprint(spec: Mapping[str, Any] | None, inputs: Sequence[DataFrame] = ()) -> str:
    """A hash of settings that JSON can say, and of the state of the files that ``inputs`` read."""
    state = {"spec": spec, "inputs": [input_state(df) for df in inputs]}
    return hashlib.sha256(json.dumps(state, sort_keys=True, default=str).encode()).hexdigest()


def cached_windows(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                   spec: Mapping[str, Any] | None = None, inputs: Sequence[DataFrame] = ()) -> DataFrame:
    """The windows stored at ``path``, built and written first if there are none of this ``spec`` and these ``inputs``.

    ``spec`` is what the windows depend on, such as the manifest and the panel's options; ``inputs`` are the tables they are
    built from, of which the files count. Both are hashed into a file beside the windows, written last: other
    settings, a changed file or a write that did not finish make the windows anew.
    """
    wanted = fingerprint(spec, inputs)
    note = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spec")
    fs = note.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")) or _read_note(fs, note) != wanted:
        write_windows(build(), path, mode="overwrite")
        out = fs.create(note, True)
        out.write(bytearray(wanted.encode()))
        out.close()
    return read_windows(spark, path)


def _read_note(fs: Any, note: Any) -> str | None:
    if not fs.exists(note):
        return None
    stream = fs.open(note)
    try:
        return bytes(stream.readNBytes(1000)).decode()
    finally:
        stream.close()
