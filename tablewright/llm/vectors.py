"""Vectors in columns: which ones can be compared, and batches of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def by_size(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix (double) of the vectors of each length in a column without nulls."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return {int(d): (rows := np.flatnonzero(sizes == d), values[starts[rows][:, None] + np.arange(d)]) for d in np.unique(sizes)}
