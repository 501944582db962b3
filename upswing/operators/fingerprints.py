"""What changed between two versions of a table, found by checksums before rows are compared.

A group's fingerprint is its number of rows and checksums over their hashes that do not depend on the
order of rows: equal tables have equal fingerprints however they are stored.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.functions.scalar import WINDOW_DAYS, as_date
from upswing.operators.joins import null_safe_join
from upswing.schemas import PARTITION_COLUMN
from upswing.sources.tables import staged

CHECKSUMS = ["rows", "mixed", "low", "high"]
_LOW = (1 << 24) - 1


def _row_hash(columns: list[str]) -> Column:
    """NULL is a value of its own: hashes alone would pass over it."""
    return F.xxhash64(*(F.col(c) for c in columns), *(F.col(c).isNull() for c in columns))


def fingerprints(df: DataFrame, groups: list[str]) -> DataFrame:
    """`groups` and `CHECKSUMS` per group. Rows that occur twice would cancel out in an exclusive or
    alone; the sums of 24 bits each hold for 2^39 rows."""
    hashed = df.withColumn("row_hash", _row_hash(sorted(df.columns)))
    return hashed.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("row_hash").alias("mixed"),
        F.sum(F.col("row_hash").bitwiseAND(_LOW)).alias("low"),
        F.sum(F.shiftrightunsigned("row_hash", 24).bitwiseAND(_LOW)).alias("high"),
    )


def changed_groups(before: DataFrame, now: DataFrame, groups: list[str]) -> DataFrame:
    """Groups whose fingerprints differ, with `change` (`new`, `gone` or `changed`) and both numbers
    of rows. A NULL is a group like others."""
    sides = [
        df.select(*groups, F.lit(side).alias("side"), F.struct(*CHECKSUMS).alias("print"))
        for df, side in ((before, 0), (now, 1))
    ]
    met = reduce(DataFrame.unionByName, sides).groupBy(*groups).agg(
        *(F.first(F.when(F.col("side") == side, F.col("print")), ignorenulls=True).alias(name)
          for side, name in ((0, "old"), (1, "new")))
    )
    change = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "gone")
    return met.filter(~F.col("old").eqNullSafe(F.col("new"))).select(
        *groups,
        change.otherwise("changed").alias("change"),
        F.coalesce("old.rows", F.lit(0)).alias("rows_before"),
        F.coalesce("new.rows", F.lit(0)).alias("rows_now"),
    )


def report_days_of(changed: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Report days from `first` to `last` whose window holds a changed stream day (`part_day`)."""
    seen = F.sequence("part_day", F.date_add("part_day", WINDOW_DAYS - 1))
    return (
        changed.select(F.explode(seen).alias("report_date"))
        .filter(F.col("report_date").between(F.lit(as_date(first)), F.lit(as_date(last))))
        .distinct()
    )


def whole_build_diff(
    left: DataFrame, right: DataFrame, keys: list[str], groups: list[str]
) -> DataFrame:
    """Rows that differ between two builds of a table, by `keys` (which include `groups`).

    Fingerprints per group are compared first; only rows of groups that differ are read again, and if
    the day partition is among the groups, only the days that hold such groups (there is at most one
    per calendar day, so the list is small). Rows are counted per key and all values, so a repeated row
    counts. Per key: `rows_left` and `rows_right`, how many rows each side has too many, and `changed`,
    the names of columns that differ if both sides have rows of the key (of several, the smallest rows).
    """
    columns = [c for c in left.columns if c not in keys]
    differing = staged(
        changed_groups(fingerprints(left, groups), fingerprints(right, groups), groups), "diff-groups"
    )
    sides = []
    for df, n in ((left, 1), (right, -1)):
        if PARTITION_COLUMN in groups:
            found = differing.select(PARTITION_COLUMN).distinct().collect()
            day = F.col(PARTITION_COLUMN)
            listed = [row[0] for row in found if row[0] is not None]
            wanted = day.isin(listed) if listed else F.lit(False)
            df = df.filter(wanted | day.isNull() if len(listed) < len(found) else wanted)
        met = null_safe_join(df, differing.select(*groups), groups, "left_semi")
        sides.append(
            met.select(*keys, F.struct(*columns).alias("values"), F.lit(n).alias("n"))
        )
    surplus = (
        sides[0].unionByName(sides[1]).groupBy(*keys, "values").agg(F.sum("n").alias("n"))
    ).filter("n <> 0")
    more_left, more_right = F.col("n") > 0, F.col("n") < 0
    met = surplus.groupBy(*keys).agg(
        F.min(F.when(more_left, F.col("values"))).alias("left"),
        F.min(F.when(more_right, F.col("values"))).alias("right"),
        F.coalesce(F.sum(F.when(more_left, F.col("n"))), F.lit(0)).alias("rows_left"),
        F.coalesce(F.sum(F.when(more_right, -F.col("n"))), F.lit(0)).alias("rows_right"),
    )
    names = F.array_compact(
        F.array(
            *(
                F.when(~F.col("left")[c].eqNullSafe(F.col("right")[c]), F.lit(c))
                for c in columns
            )
        )
    )
    both = F.col("left").isNotNull() & F.col("right").isNotNull()
    return met.select(
        *keys, "rows_left", "rows_right", F.when(both, F.array_join(names, ",")).alias("changed")
    )
