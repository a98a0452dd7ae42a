"""Helpers for columns of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType


def numbers(df: DataFrame, column: str) -> Column:
    """The vector as floats or doubles; other numbers, and text that holds numbers, as doubles."""
    kind = df.schema[column].dataType
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType)):
        return F.col(f"`{column}`")
    return F.col(f"`{column}`").try_cast("array<double>")


def finite(vector: Column) -> Column:
    """Whether a vector is there, holds something, and only finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaling by the largest entry first keeps squares in range."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
