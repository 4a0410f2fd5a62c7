"""What the operators on vectors share: which rows take part, and vectors as arrays of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(vector: str) -> Column:
    """Whether a vector is there and every component is a finite number."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def of_one_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows with the length of most vectors (ties: the longest), and that length; 0 for no rows."""
    most = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = most["d"] if most else 0
    return rows.where(F.size(vector) == dim), dim


def single(rows: DataFrame, vector: str) -> bool:
    """Whether components are stored in 32 bits, so that they lose nothing in them."""
    return isinstance(rows.schema[vector].dataType.elementType, T.FloatType)


def as_doubles(vectors: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length, without nulls, as rows of doubles."""
    return np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), dim)


def binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    raw = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1] * raw.itemsize), len(raw), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def from_binary(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Rows that ``binary`` has written."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)
