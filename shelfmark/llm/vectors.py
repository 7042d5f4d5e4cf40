"""Embedding columns as integer matrices, for the operators that search and whiten them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Scaled entries must stay below this, so that floor(scale * c) is exact and sums of them fit.
LARGEST = 1 << 40


def finite_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows whose vector is not null and holds neither nulls nor non-finite entries."""
    v = df[f"`{vector_col}`"].cast("array<double>")
    rows = df.select(df[f"`{id_col}`"].alias("id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def floored(column: pa.Array, scale: int, dims: int | None = None) -> np.ndarray:
    """A matrix of floor(scale * c), int64; shorter vectors count as padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    dims = int(sizes.max(initial=0)) if dims is None else dims
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise OverflowError(f"entries of {LARGEST // scale} and more cannot be scaled by {scale}")
    if (sizes == dims).all():
        return flat.astype(np.int64).reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out
