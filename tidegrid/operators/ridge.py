"""Ridge regression on the last step's features or on whole windows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MOMENTS = "i int, n long, means array<double>, products array<double>"


@dataclass(frozen=True)
class Moments:
    """Rows, means of the columns, and the products of their deviations."""

    n: int
    means: np.ndarray
    products: np.ndarray


@dataclass(frozen=True)
class RidgeModel:
    weights: list[float]
    intercept: float

    def predict(self, x: str | Column) -> Column:
        """Prediction in target units of the fit, from a feature array."""
        x = F.col(x) if isinstance(x, str) else x
        terms = F.zip_with(
            x, F.array(*[F.lit(w) for w in self.weights]), lambda a, w: a.cast("double") * w
        )
        return F.aggregate(terms, F.lit(self.intercept), lambda s, v: s + v)


def moments(df: DataFrame, tables: Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]]) -> Moments:
    """Count, means and centred products of the columns of ``tables``, which turns a task's batches into numbers.

    Each task gives its own means and products, a row for each column; rows of one column meet and merge one by one, so no
    task holds more than a matrix and the driver gets one. Rows with a missing number are left out.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, means, products = 0, None, None
        for table in tables(batches):
            table = table[~np.isnan(table).any(axis=1)]
            if not len(table):
                continue
            if means is None:
                means, products = np.zeros(table.shape[1]), np.zeros((table.shape[1], table.shape[1]))
            own = table.mean(axis=0)
            off, total = own - means, n + len(table)
            centred = table - own
            products += centred.T @ centred + np.outer(off, off) * (n * len(table) / total)
            means, n = means + off * (len(table) / total), total
        if n:
            for i in range(0, len(means)):
                yield _moment_rows([(i, n, means, products[i])])

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i, n, means, products in zip(*[c.to_pylist() for c in batch.columns]):
                own = (i, n, np.array(means), np.array(products))
                if held is None or held[0] != i:
                    if held is not None:
                        yield _moment_rows([held])
                    held = own
                    continue
                _, m, before, sums = held
                off = own[2] - before
                held = (i, m + n, before + off * (n / (m + n)), sums + own[3] + off[i] * off * (m * n / (m + n)))
        if held is not None:
            yield _moment_rows([held])

    rows = df.mapInArrow(partial, MOMENTS).repartition("i").sortWithinPartitions("i").mapInArrow(merged, MOMENTS).collect()
    rows = sorted(rows, key=lambda r: r["i"])
    if not rows:
        raise ValueError("there are no rows to fit a ridge model on")
    return Moments(rows[0]["n"], np.array(rows[0]["means"]), np.array([r["products"] for r in rows]))


def _moment_rows(rows: Sequence[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = zip(*rows)
    types = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([x.tolist() if isinstance(x, np.ndarray) else x for x in c], t) for c, t in zip(columns, types)],
        ["i", "n", "means", "products"])


def solved(found: Moments, alphas: Sequence[float]) -> dict[float, RidgeModel]:
    """The model for each penalty; the last column is the target."""
    gram, right = found.products[:-1, :-1], found.products[:-1, -1]
    models = {}
    for alpha in alphas:
        weights = np.linalg.lstsq(gram + alpha * np.eye(len(gram)), right, rcond=None)[0]
        models[alpha] = RidgeModel([float(w) for w in weights], float(found.means[-1] - weights @ found.means[:-1]))
    return models


def ridge_fits(df: DataFrame, x: str, y: str, alphas: Sequence[float]) -> dict[float, RidgeModel]:
    """Least squares with each of ``alphas`` times the squared weights, from one scan; the intercept is free.

    ``x`` is an array of features, or a window of them, which is flattened. Rows with a missing number are left out.
    """
    flat = F.flatten(x) if df.schema[x].dataType.simpleString().startswith("array<array") else F.col(x)
    rows = df.select(flat.cast("array<double>").alias("x"), F.col(y).cast("double").alias("y"))

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if len(batch):
                cells = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                yield np.column_stack([cells, batch.column(1).to_numpy(zero_copy_only=False)]).astype(np.float64)

    return solved(moments(rows, tables), alphas)


def ridge_fit(df: DataFrame, x: str, y: str, alpha: float = 1.0) -> RidgeModel:
    """:func:`ridge_fits` for one penalty."""
    return ridge_fits(df, x, y, [alpha])[alpha]


def ridge_predict(
    df: DataFrame, model: RidgeModel, mean: float, std: float, x: str = "x_last", name: str = "pred"
) -> DataFrame:
    """Predictions in raw target units."""
    return df.withColumn(name, model.predict(x) * F.lit(std) + F.lit(mean))
