"""What the operators on embeddings share: which vectors take part, and vectors as numpy rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: str) -> Column:
    """Vectors that are not null, empty or zero and hold no null or non-finite component."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def rows(column: pa.Array) -> np.ndarray:
    """Arrow lists of one length as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True) if x.size else np.ones((len(x), 1))
    x = x / largest  # squares of very large or small components stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
