"""Applying fitted forecasters and matching their output to requested ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.functions.calendar import timestamp_of
from tidegrid.functions.scaling import clip_lower
from tidegrid.operators.lookup import lookup_join
from tidegrid.sources.stage import stage


def score_windows(df: DataFrame, scorer: Callable[[Column], Column], x: str = "x",
                  name: str = "pred") -> DataFrame:
    """Predictions by a scorer that is a column expression (persistence, a linear model)."""
    return df.withColumn(name, scorer(F.col(x)))


def score_windows_with(
    df: DataFrame, predict: Callable[[np.ndarray], Sequence[float]], keep: Sequence[str],
    x: str = "x", name: str = "pred",
) -> DataFrame:
    """Predictions by a user's function over Arrow batches of windows.

    ``predict`` gets one float32 array ``(windows, steps, features)``, missing cells as NaN, and
    returns one number per window; batch size is Spark's Arrow batch setting.
    """
    wanted = list(keep)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            windows = batch.column(len(wanted))
            if not len(windows):
                continue
            steps = windows.flatten()
            cells = steps.flatten().cast(pa.float32()).to_numpy(zero_copy_only=False)
            shape = len(windows), len(steps) // len(windows), -1
            pred = np.asarray(predict(cells.reshape(shape)), np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred)], [*wanted, name])

    narrow = df.select(*wanted, x)
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != x]
        + [f"`{name}` double"]
    )
    return narrow.mapInArrow(batches, schema)


def target_time(df: DataFrame, name: str = "target_dt") -> DataFrame:
    """One hour after the last context hour of a wide request row.

    The year, month, day and hour columns are found by their prefix; the last one of
    each in column order belongs to the most recent hour.
    """
    last = {}
    for part in ("year", "month", "day", "hour"):
        found = [c for c in df.columns if c.startswith(part)]
        if not found:
            raise ValueError(f"no column starts with {part!r}")
        last[part] = F.col(f"`{found[-1]}`")
    return df.withColumn(name, timestamp_of(**last) + F.expr("INTERVAL 1 HOUR"))


def match_predictions(
    ids: DataFrame, preds: DataFrame, keys: Sequence[str], fallback: float,
    pred: str = "pred", order: str | None = None, **options,
) -> DataFrame:
    """Each id with its prediction, or ``fallback`` when none matches.

    Several predictions for a key: the last by ``order`` counts, of equals the largest; without
    ``order`` they fail the job. The predictions are staged, then looked up with hot keys
    split (``options`` of ``lookup_join``), so many requests for one hour spread over tasks.
    """
    if order:
        last = F.max(F.struct(F.col(order).alias("order"), F.col(pred).alias("pred")))["pred"]
    else:
        last = F.when(F.count(F.lit(1)) == 1, F.any_value(pred)).otherwise(
            F.raise_error(F.lit("several predictions for a key and no order among them")))
    unique = preds.groupBy(*keys).agg(last.alias("__pred"), F.lit(True).alias("__found"))
    matched = F.coalesce("__found", F.lit(False))
    return lookup_join(ids, stage(unique, "predictions"), list(keys), **options).select(
        *ids.columns,
        F.when(matched, F.col("__pred")).otherwise(F.lit(float(fallback))).alias(pred),
        matched.alias("matched"),
    )


def finish_predictions(df: DataFrame, mean: float, std: float, pred: str = "pred",
                       clip: bool = True) -> DataFrame:
    """Back to raw units; negative predictions become 0 unless ``clip`` is off."""
    raw = F.col(pred) * F.lit(float(std)) + F.lit(float(mean))
    return df.withColumn(pred, clip_lower(raw) if clip else raw)


def match_coverage(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("matched").alias("matched"),
        F.count_if(~F.col("matched")).alias("fallback"),
    )


def prediction_summary(df: DataFrame, pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(pred).alias("min"), F.max(pred).alias("max"),
        F.avg(pred).alias("mean"),
    )
