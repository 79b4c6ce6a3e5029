"""Vectors as integers: the multiples of 1/256 below their components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SCALE = 256
#: Integers from this size on are refused, as sums of their products might not fit in 64 bits.
LIMIT = 1 << 24


def is_usable(vector: str) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False))


def floored(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component as an array of ints; one of ``LIMIT`` or more ends the job with an error."""

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * scale)
        return F.when(F.abs(value) < LIMIT, value).otherwise(F.raise_error(F.lit("a component is too large"))).cast("int")

    return F.transform(vector, whole)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The arrays of a column as rows of 64-bit integers; they must have the same length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = set(whole.value_lengths().to_pylist())
    if len(sizes) > 1:
        raise ValueError(f"vectors differ in length: {sorted(sizes)[:5]}")
    return whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(whole), -1)


def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact matrix product of integers: by floating point where that holds all sums, else by integers."""
    largest = float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * one.shape[-1]
    if largest < 1 << 52:
        return (one.astype(np.float64) @ two.astype(np.float64)).astype(np.int64)
    return one @ two
