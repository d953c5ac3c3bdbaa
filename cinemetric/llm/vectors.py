"""Which vectors take part, and their blocks as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    x = embedding.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return embedding.isNotNull() & (F.size(x) > 0) & ~odd & F.exists(x, lambda v: v != 0)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
