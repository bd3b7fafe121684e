"""Categorical and circular encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The sixteen compass points, clockwise from north, 22.5 degrees apart.
COMPASS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
]
COMPASS_STEP = 22.5


def compass_degrees(wd: str | Column, default: float | None = None) -> Column:
    """Degrees of a compass name; unknown or missing names give ``default``."""
    wd = F.col(wd) if isinstance(wd, str) else wd
    entries = [F.lit(v) for i, name in enumerate(COMPASS) for v in (name, i * COMPASS_STEP)]
    degrees = F.try_element_at(F.create_map(*entries), wd)
    return degrees if default is None else F.coalesce(degrees, F.lit(float(default)))


def circular_encode(degrees: Column) -> tuple[Column, Column]:
    radians = F.radians(degrees)
    return F.sin(radians), F.cos(radians)


def wind_features(wd: str = "wd", default: float | None = None) -> dict[str, Column]:
    wd_sin, wd_cos = circular_encode(compass_degrees(wd, default))
    return {"wd_sin": wd_sin, "wd_cos": wd_cos}


def one_hot_names(vocab: Sequence[str], prefix: str = "st_") -> list[str]:
    return [f"{prefix}{v}" for v in sorted(vocab)]


def one_hot(c: str, vocab: Sequence[str], prefix: str = "st_") -> dict[str, Column]:
    """One 0/1 column per value of a fixed vocabulary; unseen values are all zero."""
    return {
        f"{prefix}{v}": F.coalesce((F.col(c) == F.lit(v)).cast("float"), F.lit(0.0).cast("float"))
        for v in sorted(vocab)
    }


MOST_COLUMNS = 2000


def vocabulary(df: DataFrame, c: str, max_values: int = MOST_COLUMNS) -> list[str]:
    """Sorted distinct values of ``c``; more than ``max_values`` are refused, as each becomes a column."""
    rows = df.select(c).where(F.col(c).isNotNull()).distinct().take(max_values + 1)
    if len(rows) > max_values:
        raise ValueError(f"{c} has more than {max_values} values; see sparse_one_hot")
    return sorted(r[0] for r in rows)


def one_hot_auto(df: DataFrame, c: str, prefix: str = "st_", max_values: int = MOST_COLUMNS) -> dict[str, Column]:
    return one_hot(c, vocabulary(df, c, max_values), prefix)
