"""Unions and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


class ColumnMismatch(ValueError):
    """Tables of a strict union have different columns."""


def strict_union(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; every table needs the columns of the first, in any order."""
    want = set(frames[0].columns)
    for i, f in enumerate(frames[1:], 1):
        if set(f.columns) != want:
            missing, extra = sorted(want - set(f.columns)), sorted(set(f.columns) - want)
            raise ColumnMismatch(f"table {i}: missing {missing}, extra {extra}")
    return reduce(lambda a, b: a.unionByName(b), frames)


def loose_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of left that right lacks."""
    return left.select(key).subtract(right.select(key))
