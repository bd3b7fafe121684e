"""Forecast error measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mse(y, p) -> Column:
    e = _col(y) - _col(p)
    return F.avg(e * e)


def rmse(y, p) -> Column:
    return F.sqrt(mse(y, p))


def mae(y, p) -> Column:
    return F.avg(F.abs(_col(y) - _col(p)))


def huber(y, p, delta: float = 1.0) -> Column:
    """Quadratic within ``delta`` of the target, linear beyond."""
    e = F.abs(_col(y) - _col(p))
    return F.avg(F.when(e <= delta, e * e * 0.5).otherwise((e - 0.5 * delta) * delta))
