"""Model input from wide request rows: one row holds one window of lagged columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.functions.calendar import cyclical
from tidegrid.functions.encoding import circular_encode, compass_degrees, one_hot
from tidegrid.functions.scaling import zscore
from tidegrid.functions.sequences import in_window_rolling, lags_to_sequence
from tidegrid.operators.lookup import lookup_join

# Period and first value of each calendar part.
CALENDAR_PARTS = {"hour": (24, 0), "month": (12, 1), "dow": (7, 0)}


def _constant(value: Column, window: int) -> Column:
    return F.array_repeat(value.cast("double"), window)


def _lagged(df: DataFrame, name: str, window: int) -> Column | None:
    """The lagged columns of ``name`` as an array, if the rows have them."""
    names = [f"{name}_lag_{k}" for k in range(window, 0, -1)]
    if not set(names) <= set(df.columns):
        return None
    return F.array(*[F.col(f"`{n}`") for n in names])


def lag_rows_to_windows(
    df: DataFrame,
    measures: Sequence[str],
    rolling: Mapping[str, tuple[str, str, int]],
    vocab: Sequence[str],
    window: int = 24,
    wind: str = "wd",
    series: str = "station",
    params: Mapping[str, float] | None = None,
    by_series: DataFrame | None = None,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """``(keep, series, x)`` with ``x`` in the order of the all-rows manifest.

    Parameters are global (``params``: ``<c>_mean, <c>_std``) or those of the row's
    series (``by_series``: ``<c>_mu, <c>_sigma``); a missing step becomes the mean.
    Rolling features are taken inside the window and with population deviation, as
    prediction has no earlier rows: not what training computes. Wind that is absent
    points north; absent calendar parts give (0, 0).
    """
    if (params is None) == (by_series is None):
        raise ValueError("pass either params or by_series")
    if by_series is not None:
        df = lookup_join(df, by_series, [series])

    def stats(c: str) -> tuple[Column, Column]:
        if params is not None:
            return F.lit(float(params[f"{c}_mean"])), F.lit(float(params[f"{c}_std"]))
        return F.col(f"{c}_mu"), F.col(f"{c}_sigma")

    def scaled(seq: Column, c: str) -> Column:
        mean, std = stats(c)
        return F.transform(seq, lambda v: zscore(v, mean, std))

    raw = {c: lags_to_sequence(c, window, stats(c)[0]) for c in measures}
    df = df.withColumns({f"__seq_{c}": s for c, s in raw.items()})
    seq = {c: F.col(f"__seq_{c}") for c in measures}

    rows: list[Column] = [scaled(seq[c], c) for c in measures]
    if wind:
        names = _lagged(df, wind, window)
        names = F.array_repeat(F.lit(None).cast("string"), window) if names is None else names
        degrees = F.transform(names, lambda v: compass_degrees(v, default=0.0))
        rows += [F.transform(degrees, lambda d: circular_encode(d)[0]),
                 F.transform(degrees, lambda d: circular_encode(d)[1])]
    for part, (period, offset) in CALENDAR_PARTS.items():
        values = _lagged(df, part, window)
        if values is None:
            rows += [_constant(F.lit(0.0), window)] * 2
        else:
            rows += [F.transform(values, lambda v: cyclical(v, period, offset)[0]),
                     F.transform(values, lambda v: cyclical(v, period, offset)[1])]
    rows += [
        scaled(in_window_rolling(seq[c], kind, n), name) for name, (c, kind, n) in rolling.items()
    ]
    rows += [_constant(e, window) for e in one_hot(series, vocab).values()]

    # zipping first evaluates each feature's array once, not once per step
    names = [f"f{i}" for i in range(len(rows))]
    steps = F.arrays_zip(*[r.alias(n) for r, n in zip(rows, names)])
    x = F.transform(steps, lambda s: F.array(*[s.getField(n).cast("float") for n in names]))
    return df.select(*keep, series, x.alias("x"))
