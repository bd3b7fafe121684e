"""Time columns. Event time is TIMESTAMP_NTZ throughout, so no zone is ever applied."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F



def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def timestamp_of(year, month, day, hour) -> Column:
    """Zone-free timestamp from four integer columns."""
    parts = [_col(c).cast("int") for c in (year, month, day, hour)]
    return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))


def with_timestamp(
    df: DataFrame, year="year", month="month", day="day", hour="hour", name: str = "t"
) -> DataFrame:
    return df.withColumn(name, timestamp_of(year, month, day, hour))


def with_calendar_parts(df: DataFrame, t: str = "t") -> DataFrame:
    """``month`` 1-12 and ``hour`` 0-23 derived from the timestamp."""
    return df.withColumns({"month": F.month(t), "hour": F.hour(t)})


def epoch_seconds(t: str | Column) -> Column:
    """Seconds since 1970-01-01 of a zone-free timestamp, without a zone conversion.

    Measured from a date before any data, as the cast drops fractions towards zero.
    """
    since = _col(t) - F.expr("TIMESTAMP_NTZ '0001-01-01 00:00:00'")
    return since.cast("interval second").cast("long") - 62135596800


def from_epoch_seconds(seconds: Column) -> Column:
    """Inverse of :func:`epoch_seconds`."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.expr("INTERVAL '1' SECOND") * seconds


def floor_to_step(t: str | Column, step_seconds: int) -> Column:
    """Start of the step a timestamp falls into."""
    return from_epoch_seconds(F.floor(epoch_seconds(t) / step_seconds) * step_seconds)


def cyclical(c: str | Column, period: float, offset: float = 0) -> tuple[Column, Column]:
    """(sin, cos) of a periodic value, so that both ends of the period are neighbours."""
    angle = (_col(c) - offset) * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def calendar_features(t: str = "t") -> dict[str, Column]:
    """Hour-of-day and month-of-year encodings."""
    hour_sin, hour_cos = cyclical(F.hour(t), 24)
    month_sin, month_cos = cyclical(F.month(t), 12, offset=1)
    return {
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }


def day_of_week_features(t: str = "t") -> dict[str, Column]:
    """Monday = 0 … Sunday = 6 on a circle of seven."""
    dow_sin, dow_cos = cyclical(F.weekday(t), 7)
    return {"dow_sin": dow_sin, "dow_cos": dow_cos}


def is_weekend(t: str = "t") -> Column:
    return (F.weekday(t) >= 5).cast("float")


def split_at(df: DataFrame, cutoff: str, t: str = "t", name: str = "split") -> DataFrame:
    """``train`` strictly before ``cutoff``, ``val`` from it on (half-open)."""
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.withColumn(name, F.when(F.col(t) < at, "train").otherwise("val"))
