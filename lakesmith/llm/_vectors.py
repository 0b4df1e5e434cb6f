"""Integer vectors from embedding columns (helper of the operators on vectors)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256


def limit(dims: int) -> int:
    """Bound of integer components within which squared distances and inner products fit a long."""
    return int((2**61 / max(dims, 1)) ** 0.5)


def finite(vector: Column, most: int) -> Column:
    """Whether a vector is not null and each component is not null, finite and within ``most`` once scaled."""
    x = vector.cast("array<double>")
    return F.coalesce(F.forall(x, lambda c: F.coalesce(F.abs(c * SCALE) < F.lit(float(most)), F.lit(False))), F.lit(False))


def whole(vector: Column) -> Column:
    """``floor(256 * x)`` of each component, taken as a double."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("int"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dims`` components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets)).astype(np.int64)
    flat = np.asarray(column.flatten()).astype(np.int32, copy=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
