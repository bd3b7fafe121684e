"""Applying fitted normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.scaling import zscore
from tidegrid.operators.lookup import lookup_join


def apply_scaler(df: DataFrame, params: Mapping[str, Any], cols: Sequence[str]) -> DataFrame:
    """``<c>_norm`` from global parameters ``<c>_mean, <c>_std`` (see ``one_row``)."""
    def lit(name):
        return F.lit(params[name]).cast("double")

    return df.withColumns({
        f"{c}_norm": zscore(F.col(c), lit(f"{c}_mean"), lit(f"{c}_std")) for c in cols
    })


def unscalable(params: Mapping[str, Any], cols: Sequence[str]) -> list[str]:
    """Columns whose fitted spread is zero or unknown, so that their ``_norm`` is NULL."""
    return [c for c in cols if not params[f"{c}_std"]]


def apply_scaler_by_key(
    df: DataFrame, fitted: DataFrame, keys: Sequence[str], cols: Sequence[str], salt: str | None = None
) -> DataFrame:
    """``<c>_norm`` from the parameters of each row's own series.

    A series without parameters gets NULL; count such rows with :func:`unmatched_keys`.
    """
    stats = fitted.select(*keys, *[f"{c}{s}" for c in cols for s in ("_mu", "_sigma")])
    joined = lookup_join(df, stats, keys, salt)
    norm = [zscore(F.col(c), F.col(f"{c}_mu"), F.col(f"{c}_sigma")).alias(f"{c}_norm") for c in cols]
    return joined.select(*df.columns, *norm)


def unmatched_keys(df: DataFrame, fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key that has no fitted parameters."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(fitted.select(*keys), list(keys), "left_anti")
