"""Windows as views: a model reads sliding windows that are never written out.

A tensor of ``window`` steps repeats every row ``window`` times. Here each block comes to a task once, with its
halo and in order, and the windows over it are strided views of one array of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F

from tidegrid.functions.scaling import feature_array
from tidegrid.operators.blocks import BLOCK_ROWS, HALO, blocked
from tidegrid.operators.ridge import RidgeModel, moments, solved
from tidegrid.operators.rolling import feature_columns, reach

Predict = Callable[[np.ndarray], Sequence[float]]


def predicted(predict: Predict, views: np.ndarray, at: np.ndarray, batch: int) -> np.ndarray:
    """``predict`` for the windows at the rising places ``at``, ``batch`` at a time; neighbours go in as one view."""
    out = np.empty(len(at), np.float64)
    for a in range(0, len(at), batch):
        own = at[a:a + batch]
        together = own[-1] - own[0] == len(own) - 1
        out[a:a + batch] = predict(views[own[0]:own[-1] + 1] if together else views[own])
    return out


def score_blocks_with(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    t: str,
    manifest: Sequence[str],
    window: int,
    predict: Predict,
    keep: Sequence[str] = (),
    features: Mapping[str, tuple[str, str, int]] | None = None,
    fill: float | None = None,
    name: str = "pred",
    size: int = BLOCK_ROWS,
    dense: bool = False,
    batch: int = 1024,
) -> DataFrame:
    """What ``score_windows_with`` gives for the windows of ``sliding_windows``, without the tensors.

    ``predict`` gets float32 arrays ``(windows, window, features)`` of at most ``batch`` windows, missing cells as NaN, and
    returns one number a window. Where windows follow each other, the array is a view of the rows: ``predict`` must not write to it.
    Rows: ``keys``, ``keep``, ``target_pos``, ``target_dt`` and the prediction. A series gives as many as it has
    rows beyond the first ``window``. Other arguments are those of ``sliding_windows``.
    """
    narrow, kept = _ordered_rows(df, keys, pos, t, manifest, window, keep, features, fill, size, dense)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, views, at in _views(batches, len(kept), window, len(manifest)):
            pred = predicted(predict, views, at, batch)
            own = part.select(list(range(len(kept)))).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(pred)], [*kept, name])

    schema = ", ".join([f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in kept] + [f"`{name}` double"])
    return narrow.mapInArrow(run, schema)


def ridge_fit_blocks(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    t: str,
    manifest: Sequence[str],
    window: int,
    target: str,
    alphas: Sequence[float] = (1.0,),
    features: Mapping[str, tuple[str, str, int]] | None = None,
    fill: float | None = None,
    size: int = BLOCK_ROWS,
    dense: bool = False,
    batch: int = 1024,
) -> dict[float, RidgeModel]:
    """Ridge models of ``target`` on all cells of the window before it, flattened oldest step first.

    The windows are views of the rows, and each task keeps one matrix of (``window`` x features) squared numbers; see
    ``ridge_fits``. Windows with a missing cell or target are left out.
    """
    narrow, kept = _ordered_rows(df, keys, pos, t, manifest, window, [target], features, fill, size, dense)
    y = kept.index(target)

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for part, rows, views, at in _views(batches, len(kept), window, len(manifest)):
            targets = part.column(y).cast(pa.float64()).to_numpy(zero_copy_only=False)[rows]
            for a in range(0, len(at), batch):
                cells = views[at[a:a + batch]].reshape(-1, window * len(manifest)).astype(np.float64)
                yield np.column_stack([cells, targets[a:a + batch]])

    return solved(moments(narrow, tables), alphas)


def _ordered_rows(df, keys, pos, t, manifest, window, keep, features, fill, size, dense) -> tuple[DataFrame, list[str]]:
    """Blocks with their halos, each in one task and in order: kept columns, whether a row ends a window, its features."""
    features = features or {}
    needed = [*keys, *keep, pos, t, *[c for c, _, _ in features.values()], *[c for c in manifest if c not in features]]
    rows, by = blocked(df.select(*dict.fromkeys(needed)), keys, pos, window + reach(features), size, dense)
    w = Window.partitionBy(*by).orderBy(pos)
    # the row number brings a block's rows into one task in order, and says how many stand before a row
    rows = rows.select("*", F.row_number().over(w).alias("__n"), *feature_columns(features, w))
    kept = [*keys, *keep, "target_pos", "target_dt"]
    return rows.select(
        *keys, *keep, F.col(pos).alias("target_pos"), F.col(t).alias("target_dt"),
        (~F.col(HALO) & (F.col("__n") > window)).alias("__scored"), feature_array(manifest, fill).alias("__x")), kept


def _views(
    batches: Iterable[pa.RecordBatch], kept: int, window: int, width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch the rows that end a window, all windows over the cells as views, and which of them are those rows'."""
    carried = np.zeros((0, width), np.float32)
    for part in batches:
        own = part.column(kept + 1).flatten().cast(pa.float32()).to_numpy(zero_copy_only=False).reshape(-1, width)
        cells = np.concatenate([carried, own])
        rows = np.flatnonzero(part.column(kept).to_numpy(zero_copy_only=False))
        if len(rows):
            views = sliding_window_view(cells, window, axis=0).transpose(0, 2, 1)
            yield part, rows, views, rows + len(carried) - window
        carried = cells[-window:].copy()
