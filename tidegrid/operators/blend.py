"""Combining prediction sets ``(id, pred)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.scaling import clip_lower
from tidegrid.operators.shares import bounded_shares

# Share of the first set in each blend of the grid.
WEIGHTS = (0.5, 0.6, 0.7, 0.75, 0.8)


def _unique(df: DataFrame, pred: str, name: str) -> DataFrame:
    """One row per id; a repeated id is an error.

    Ids are dealt out first: nearly all are different, so that adding them up before the shuffle would only hold a task's input.
    """
    once = F.when(F.count(F.lit(1)) == 1, F.any_value(pred)).otherwise(
        F.raise_error(F.concat(F.lit("repeated id in a prediction set: "), F.col("id").cast("string")))
    )
    return bounded_shares(df).repartition("id").groupBy("id").agg(once.alias(name), F.lit(True).alias(f"__has_{name}"))


def align_predictions(a: DataFrame, b: DataFrame, pred: str = "pred") -> DataFrame:
    """``(id, a, b)``; the job fails unless both sets hold exactly the same ids."""
    joined = _unique(a, pred, "a").join(_unique(b, pred, "b"), "id", "full_outer")
    both = F.col("__has_a") & F.col("__has_b")
    checked = F.when(F.coalesce(both, F.lit(False)), F.col("id")).otherwise(
        F.raise_error(F.concat(F.lit("id is in one prediction set only: "), F.col("id").cast("string")))
    )
    return joined.select(checked.alias("id"), "a", "b")


def blend(a: DataFrame, b: DataFrame, w: float, pred: str = "pred") -> DataFrame:
    """``w`` of the first set and the rest of the second, bounded at 0."""
    mixed = F.col("a") * w + F.col("b") * (1 - w)
    return align_predictions(a, b, pred).select("id", clip_lower(mixed).alias(pred))


def blend_grid(
    a: DataFrame, b: DataFrame, weights: Sequence[float] = WEIGHTS, pred: str = "pred"
) -> DataFrame:
    """Every blend of the grid as rows ``(w, id, pred)``; the sets are aligned once."""
    grid = F.array(*[F.lit(float(w)) for w in weights])
    mixed = F.col("a") * F.col("w") + F.col("b") * (1 - F.col("w"))
    return (
        align_predictions(a, b, pred)
        .select("id", "a", "b", F.explode(grid).alias("w"))
        .select("w", "id", clip_lower(mixed).alias(pred))
    )


def blend_mean(*sets: DataFrame, pred: str = "pred") -> DataFrame:
    """Equal-weight mean of several sets, not bounded; the job fails unless all hold the same ids once each."""
    rows = sets[0].select("id", pred, F.lit(0).alias("set"))
    for i, s in enumerate(sets[1:], 1):
        rows = rows.unionByName(s.select("id", pred, F.lit(i).alias("set")))
    complete = reduce(and_, [F.count_if(F.col("set") == i) == 1 for i in range(len(sets))])
    mean = F.when(complete, F.avg(pred)).otherwise(
        F.raise_error(F.concat(F.lit("id is not once in every prediction set: "), F.col("id").cast("string"))))
    return bounded_shares(rows).repartition("id").groupBy("id").agg(mean.alias(pred))


def seed_mean(preds: DataFrame, keys: Sequence[str], pred: str = "pred") -> DataFrame:
    """Mean prediction of each window over repeated runs."""
    return preds.groupBy(*keys).agg(F.avg(pred).alias(pred))
