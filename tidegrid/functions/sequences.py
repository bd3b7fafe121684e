"""Column functions over the steps of one window (arrays, oldest step first)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lags_to_sequence(feature: str, window: int, fill: Column | None = None) -> Column:
    """``<feature>_lag_W … _lag_1`` as one array, missing steps replaced by ``fill``."""
    steps = [F.col(f"`{feature}_lag_{k}`").cast("double") for k in range(window, 0, -1)]
    seq = F.array(*steps)
    return seq if fill is None else F.transform(seq, lambda x: F.coalesce(x, fill))


def _trailing(seq: Column, j: Column, k: int) -> Column:
    """The last ``k`` steps up to 0-based step ``j``, cut at the start of the window."""
    start = F.greatest(j - (k - 2), F.lit(1))
    return F.slice(seq, start, j + 2 - start)


def in_window_mean(seq: Column, k: int) -> Column:
    def mean(_x, j):
        part = _trailing(seq, j, k)
        return F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / F.size(part)

    return F.transform(seq, mean)


def in_window_std(seq: Column, k: int) -> Column:
    """Population deviation (one step gives 0), by running mean and squared distance."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def add(a, x):
        n = a["n"] + 1.0
        m = a["m"] + (x - a["m"]) / n
        return F.struct(
            n.alias("n"), m.alias("m"), (a["q"] + (x - a["m"]) * (x - m)).alias("q")
        )

    def std(_x, j):
        return F.aggregate(_trailing(seq, j, k), zero, add, lambda a: F.sqrt(a["q"] / a["n"]))

    return F.transform(seq, std)


def in_window_diff(seq: Column) -> Column:
    return F.transform(
        seq, lambda x, j: F.when(j == 0, F.lit(0.0)).otherwise(x - F.element_at(seq, j.cast("int")))
    )


def in_window_rolling(seq: Column, kind: str, k: int = 1) -> Column:
    if kind == "mean":
        return in_window_mean(seq, k)
    if kind == "std":
        return in_window_std(seq, k)
    if kind == "diff":
        return in_window_diff(seq)
    raise ValueError(f"unknown kind {kind!r}")


def last_step(x: str | Column = "x") -> Column:
    """Feature vector of the most recent step."""
    return F.element_at(x, -1)


def window_cell(x: str | Column, step: int, index: int) -> Column:
    """Feature ``index`` (0-based, manifest order) at ``step`` (1-based, negative from the end)."""
    return F.element_at(F.element_at(x, step), index + 1)


def flatten_window(x: str | Column = "x") -> Column:
    return F.flatten(x)


def explode_windows(df: DataFrame, ids: Sequence[str], manifest: Sequence[str], x: str = "x") -> DataFrame:
    """Long form ``(ids, step, feature, value)``; ``step`` counts from 0, oldest first."""
    names = F.array(*[F.lit(c) for c in manifest])
    return (
        df.select(*ids, F.posexplode(x).alias("step", "row"))
        .select(*ids, "step", F.posexplode("row").alias("f", "value"))
        .select(*ids, "step", F.element_at(names, F.col("f") + 1).alias("feature"), "value")
    )
