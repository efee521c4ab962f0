"""Vectors as numpy matrices: the usable rows of a table, and batches of equal length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """No null vector, and no null or non-finite component."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column whose rows all have ``dim`` entries."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
