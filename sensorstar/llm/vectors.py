"""Vectors of whole numbers: made from embeddings, as matrices, and their exact products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def floored(embedding: str, factor: int) -> Column:
    """``floor(factor * x)`` of each component, ``x`` as double; NULL if the vector is
    null or any component is null or not finite."""
    component = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(component, lambda x: F.floor(F.lit(float(factor)) * x)))


def longest(column: str) -> Column:
    """The longest vector of a table; 0 where there is none."""
    return F.coalesce(F.max(F.size(column)), F.lit(0))


def as_matrix(rows: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of at most ``width`` numbers, shorter ones filled up with zeros."""
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    values = rows.flatten().to_numpy(zero_copy_only=False)
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.astype(np.int64, copy=False).reshape(len(rows), width)
    found = np.zeros((len(rows), width), np.int64)
    found[np.arange(width)[None, :] < lengths[:, None]] = values
    return found


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices, exact while they fit 64 bits: by
    floats where every sum is a whole number that floats can hold."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def list_of(values: pa.Array, count: int = 1) -> pa.Array:
    """Values as ``count`` lists of equal length."""
    each = len(values) // count if count else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * each, pa.int32()), values)
