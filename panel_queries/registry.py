"""Where query functions and their comparison SQL are collected."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def r6(c: str | Column, digits: int = 6) -> Column:
    """A fixed number of decimals by one rule in both engines (their ``round`` differ on ties)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * 10.0**digits + 0.5) / 10.0**digits


def sql_r6(expr: str, digits: int = 6) -> str:
    return f"floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits}"


def rounded(cols: Sequence[str] = ("m1", "m2", "m3"), digits: int = 6) -> list[Column]:
    return [r6(c, digits).alias(c) for c in cols]


def sql_rounded(cols: Sequence[str] = ("m1", "m2", "m3"), digits: int = 6) -> str:
    return ", ".join(f"{sql_r6(c, digits)} AS {c}" for c in cols)
