"""Embeddings as whole numbers, for the operators that want exact sums of them (operators 11 and 12)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole components stay below this in size, so that they are longs and a difference of two is one as well.
LIMIT = 1 << 62


def whole_vectors(vectors: DataFrame, scale: int, shift: int = 0, *others: str) -> DataFrame:
    """(vec_id, the other columns, x, size): ``floor(scale * c) + shift`` of every component c, as longs.

    Rows go whose vector is null or holds a null, non-finite or, beyond ``LIMIT``, unrepresentable component. Empty vectors stay.
    """
    given = F.col("embedding").cast("array<double>")
    small = F.forall(given, lambda c: c.isNotNull() & (F.abs(c) * scale < float(LIMIT - abs(shift))))  # NaN is above every number
    return vectors.where(given.isNotNull() & small).select(
        F.col("vec_id").cast("long").alias("vec_id"), *others,
        F.transform(given, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x"), F.size(given).alias("size"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The rows of a list column, all ``size`` long, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def by_size(batch: pa.RecordBatch):
    """(size, its rows) for every vector length in the batch."""
    sizes = batch.column("size").to_numpy(zero_copy_only=False)
    found = np.unique(sizes).tolist()
    for size in found:
        yield size, batch if len(found) == 1 else batch.take(pa.array(np.flatnonzero(sizes == size)))


def fits_long(values: np.ndarray) -> pa.Array:
    """Whole numbers of any size as longs, null where one does not fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if abs(int(v)) < 1 << 63 else None for v in values], pa.int64())
