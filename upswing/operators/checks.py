"""Readiness, audits and comparisons of builds."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.functions.scalar import as_date
from upswing.sources.tables import on_day, since_day


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def partition_volumes(tables: dict[str, DataFrame], since: date | str) -> DataFrame:
    """Rows per table and day since a day."""
    return _union(
        [
            since_day(df, since)
            .groupBy("part_day")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("name"), "part_day", "n_rows")
            for name, df in tables.items()
        ]
    )


def footer_volumes(
    spark: SparkSession, paths: dict[str, str], since: date | str
) -> DataFrame:
    """The same for written day-partitioned tables (name to folder), from the row counts in the files'
    footers: the count per partition is pushed into the scan, and no column is read.

    The push-down needs the file source's second version and two settings, which are made in a session
    of their own; the caller's stays as it is.
    """
    counting = spark.newSession()
    counting.conf.set("spark.sql.sources.useV1SourceList", "")
    counting.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return partition_volumes(
        {name: counting.read.parquet(path) for name, path in paths.items()}, since
    )


def readiness(tables: dict[str, DataFrame], day: date | str, more_than: int = 0) -> DataFrame:
    """Per table: rows on that day and whether there are more than wanted. A missing day gives a
    row with zero; what to do about it is the caller's decision."""
    return _union(
        [
            on_day(df, day)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(
                F.lit(name).alias("name"),
                F.lit(as_date(day)).alias("part_day"),
                "n_rows",
                (F.col("n_rows") > more_than).alias("ready"),
            )
            for name, df in tables.items()
        ]
    )


def has_rows(df: DataFrame) -> bool:
    """Existence probe; stops at the first row."""
    return not df.isEmpty()


def empty_output_alarm(output: DataFrame, name: str, day: date | str) -> DataFrame:
    """One row that says whether a day's output is empty, with the message to send if so."""
    counted = readiness({name: output}, day)
    text = F.concat(F.lit(f"{name} has no rows for "), F.col("part_day").cast("string"))
    return counted.withColumn("message", F.when(~F.col("ready"), text))


def audit_counts(tables: dict[str, DataFrame], alerts: DataFrame, day: date | str) -> DataFrame:
    """Row counts of all tables for one day, and the number of distinct alert recipients. Tables
    without rows on that day have no row here."""
    today = F.lit(as_date(day)).alias("part_day")

    def counted(df: DataFrame, name: str, count) -> DataFrame:
        return (
            on_day(df, day).groupBy("part_day").agg(count.alias("n_rows"))
            .select(F.lit(name).alias("name"), today, "n_rows")
        )

    rows = F.count(F.lit(1))
    parts = [counted(df, name, rows) for name, df in tables.items()]
    parts.append(counted(alerts, "velocity alerts", rows))
    parts.append(counted(alerts, "velocity emails", F.count_distinct("email")))
    return _union(parts).orderBy("name", "part_day")


def tie_profile(
    trends: DataFrame, country_code: str, region_dma_code: str | None = None
) -> DataFrame:
    """Groups of items in one market that share last week's rank and streams."""
    market = trends.filter(F.col("country_code") == country_code)
    if region_dma_code is not None:
        market = market.filter(F.col("region_dma_code") == region_dma_code)
    return (
        market.groupBy("rank_lw", "streams_lw")
        .agg(F.count(F.lit(1)).alias("n_items"))
        .filter(F.col("n_items") > 1)
    )


def build_diff(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose rows differ between two builds, including keys that only one of them has.

    Rows are counted per keys and value on both sides, NULL being a value like others. A key is
    reported with the (largest) value that the left has more often than the right, the one that the
    right has more often, and how many rows each side has too many.
    """
    sides = [
        df.select(*keys, F.col(value).alias("value"), F.lit(n).alias("n"))
        for df, n in ((left, 1), (right, -1))
    ]
    surplus = _union(sides).groupBy(*keys, "value").agg(F.sum("n").alias("n")).filter("n <> 0")
    more_left, more_right = F.col("n") > 0, F.col("n") < 0
    return surplus.groupBy(*keys).agg(
        F.max(F.when(more_left, F.col("value"))).alias(f"{value}_left"),
        F.max(F.when(more_right, F.col("value"))).alias(f"{value}_right"),
        F.coalesce(F.sum(F.when(more_left, F.col("n"))), F.lit(0)).alias("rows_left"),
        F.coalesce(F.sum(F.when(more_right, -F.col("n"))), F.lit(0)).alias("rows_right"),
    )


def duplicate_keys(dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a lookup table lists more than once and that would multiply rows in a join."""
    return (
        dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
    )
