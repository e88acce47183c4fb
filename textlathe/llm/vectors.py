"""Vector columns shared by the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """True for vectors that are not null, hold no null, NaN or infinity, and
    are not zero (empty vectors are zero)."""
    v = F.col(vector) if isinstance(vector, str) else vector
    v = v.cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list<double> Arrow column, without nulls, as an n x dim array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe from overflow and underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
