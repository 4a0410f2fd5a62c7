"""Name similarity. ``indel_ratio`` is 200 * LCS / (|a| + |b|), in Arrow batches, to be used behind ``may_reach``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows: one step for each letter of ``b``."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        both = row & at.get(c, 0)
        row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


@F.arrow_udf(IntegerType())
def lcs_length(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else lcs(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())


def indel_ratio(a: Column, b: Column) -> Column:
    size = F.length(a) + F.length(b)
    return F.when(size > 0, 200.0 * lcs_length(a, b) / size).otherwise(100.0)


def may_reach(a: Column, b: Column, least: float) -> Column:
    """Whether lengths alone allow ``indel_ratio`` of at least ``least``: the cheap filter before it."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= least * (F.length(a) + F.length(b))


def token_sort(key: Column) -> Column:
    return F.array_join(F.array_sort(F.split(key, " ")), " ")


def token_set_ratio(a: Column, b: Column) -> Column:
    """Similarity of shared words against each side's words."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    both = F.array_join(F.array_sort(F.array_intersect(x, y)), " ")
    left = F.trim(F.concat_ws(" ", both, F.array_join(F.array_sort(F.array_except(x, y)), " ")))
    right = F.trim(F.concat_ws(" ", both, F.array_join(F.array_sort(F.array_except(y, x)), " ")))
    return F.greatest(F.when(both != "", F.greatest(indel_ratio(both, left), indel_ratio(both, right))).otherwise(0.0), indel_ratio(left, right))
