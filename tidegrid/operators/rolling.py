"""Lag, trailing-window and difference features over row frames.

The functions return ``{name: expression}`` for a block window, so that all
features of a stage are one projection over one exchange (``rolling_features``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from tidegrid.operators.blocks import BLOCK_ROWS, over_blocks


def _trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def lag(c: str, w: WindowSpec, h: int) -> Column:
    """Value ``h`` rows back, 0 where there is none (0 is the mean in normalised units)."""
    return F.coalesce(F.lag(c, h).over(w), F.lit(0.0))


def rolling_mean(c: str, w: WindowSpec, rows: int) -> Column:
    return F.avg(c).over(_trailing(w, rows))


def rolling_std(c: str, w: WindowSpec, rows: int) -> Column:
    """Sample deviation, 0 with fewer than two values."""
    return F.coalesce(F.stddev_samp(c).over(_trailing(w, rows)), F.lit(0.0))


def rolling_max(c: str, w: WindowSpec, rows: int) -> Column:
    return F.max(c).over(_trailing(w, rows))


def diff(c: str, w: WindowSpec, h: int = 1) -> Column:
    """Change against ``h`` rows back, 0 where there is none."""
    return F.coalesce(F.col(c) - F.lag(c, h).over(w), F.lit(0.0))


KINDS = {
    "lag": (lag, lambda n: n),
    "mean": (rolling_mean, lambda n: n - 1),
    "std": (rolling_std, lambda n: n - 1),
    "max": (rolling_max, lambda n: n - 1),
    "diff": (diff, lambda n: n),
}


def reach(features: Mapping[str, tuple[str, str, int]]) -> int:
    """How many earlier rows the widest of ``{name: (column, kind, n)}`` reads."""
    return max((KINDS[kind][1](n) for _, kind, n in features.values()), default=0)


def feature_columns(features: Mapping[str, tuple[str, str, int]], w: WindowSpec) -> list[Column]:
    return [KINDS[kind][0](c, w, n).alias(name) for name, (c, kind, n) in features.items()]


def rolling_features(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    features: Mapping[str, tuple[str, str, int]],
    size: int = BLOCK_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Add every feature of ``{name: (column, kind, n)}``; kinds are those of ``KINDS``."""
    return over_blocks(
        df, keys, pos, reach(features),
        lambda d, w: d.select("*", *feature_columns(features, w)), size, dense,
    )
