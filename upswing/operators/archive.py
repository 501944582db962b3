"""Cohort archive: streams by the number of days since a track's first stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cohort days kept by default, and the pattern of their partition codes.
COHORT_DAYS = 365
PARTITION_CODE = "1%03d0101"


def cohort_archive(
    streams: DataFrame, release_dates: DataFrame, cohort_days: int = COHORT_DAYS
) -> DataFrame:
    """Streams per track and day since first stream, 0 up to, not including, `cohort_days`, with the
    partition code of the day (which has room for 1000).

    Streams are counted per track and day before the dates are joined, so a hit track meets its
    date once per day and not once per stream.
    """
    daily = streams.groupBy("isrc", "part_day").agg(F.count(F.lit(1)).alias("streams"))
    age = F.datediff("part_day", "first_stream_date")
    return (
        daily.join(release_dates, "isrc")
        .withColumn("days_since_first_stream", age)
        .filter(F.col("days_since_first_stream").between(0, cohort_days - 1))
        .select(
            "isrc", "part_day", "days_since_first_stream",
            F.format_string(PARTITION_CODE, "days_since_first_stream").alias("partition_code"),
            "streams",
        )
    )


def write_cohorts(archive: DataFrame, path: str) -> None:
    """One partition per cohort day; cohorts present in the input are replaced."""
    (
        archive.hint("rebalance", "days_since_first_stream")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("days_since_first_stream")
        .parquet(path)
    )
