"""The bytes of a column of texts, without a Python object a text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each text begins (one more entry: the end). Nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]
