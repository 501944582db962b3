"""Joins whose keys may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match each other; keeps the left side's key columns."""
    renamed = right.select(
        *(right[c].alias(f"__{c}") if c in keys else right[c] for c in right.columns)
    )
    condition = reduce(
        lambda a, b: a & b, (left[key].eqNullSafe(renamed[f"__{key}"]) for key in keys)
    )
    return left.join(renamed, condition, how).drop(*(f"__{key}" for key in keys))
