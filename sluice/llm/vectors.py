"""What the vector operators share: which vectors take part, and how they reach numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components, null ones, empty ones and those of length zero apart."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of equally long lists as doubles."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    return np.concatenate(flat or [np.empty(0)]).astype(np.float64).reshape(-1, width)


def row_dots(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products with one vector, each row added up in the same order wherever it stands."""
    return (rows * vector).sum(axis=1)
