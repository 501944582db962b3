"""Joins with keys of which a few hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of all rows is hot, so there are at most 1 / HOT_SHARE of them. One
# with HOT_ROWS rows or fewer is no burden for a task.
HOT_SHARE = 0.001
HOT_ROWS = 5_000


def join_by_key(
    rows: DataFrame, values: DataFrame, key: str, count: str, total: int
) -> DataFrame:
    """Inner join of `rows` with `values`, which has one row per key and in `count` how many of the
    `total` rows have it. The few hot keys are sent to the rows, which stay where they are, so that no
    key with a large part of all rows gets into one task; the others are joined by key."""
    if total <= HOT_ROWS:
        return rows.join(values, key).drop(count)
    hot = F.col(count) > max(HOT_ROWS, HOT_SHARE * total)
    met = rows.join(F.broadcast(values.filter(hot)), key, "left")
    rest = met.filter(F.col(count).isNull()).select(*rows.columns)
    sent = met.filter(F.col(count).isNotNull())
    return sent.unionByName(rest.join(values.filter(~hot), key)).drop(count)
