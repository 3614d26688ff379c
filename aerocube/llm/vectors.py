"""Embeddings as vectors of whole numbers, for operators that need exact sums and scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of a component's unit.
STEPS = 256


def whole(vector: Column) -> Column:
    """A vector's components as array<long>: floor(256 * component). NULL for a null vector and for one with a null or
    non-finite component."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS)))


def longest(rows: DataFrame, x: str) -> int:
    """The number of components of the longest vector; 0 without rows."""
    return rows.agg(F.max(F.size(x))).first()[0] or 0


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows of int64; those that are shorter than `dims` get zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), "int64")
    out[np.arange(dims) < sizes[:, None]] = flat
    return out
