"""Rebuilding the day-partitioned tables: one day, a range of days, or a list from a query."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.functions.scalar import as_date
from upswing.operators.alerts import alerts
from upswing.operators.fingerprints import changed_groups, fingerprints, report_days_of
from upswing.partners import Partner
from upswing.plans.velocity import DAYS_AT_ONCE, RANK_CAP, TOP_N, trending, velocity_base
from upswing.schemas import PARTITION_COLUMN, base_schema, trend_schema
from upswing.sources.tables import on_day, staged, write_days, write_table


@dataclass(frozen=True)
class Sources:
    """Input tables of one partner. The postcode tables are only needed where regions come from
    postcodes."""

    streams: DataFrame
    resources: DataFrame
    names: DataFrame
    subdivisions: DataFrame | None = None
    zips: DataFrame | None = None


@dataclass(frozen=True)
class Paths:
    """Output folders of one partner."""

    base: str
    countries: str
    regions: str


def days_between(start: date | str, end: date | str) -> list[date]:
    """Days from `start` up to, not including, `end`."""
    first = as_date(start)
    return [first + timedelta(i) for i in range((as_date(end) - first).days)]


def days_listed(partitions: DataFrame, column: str = "partner_load_date") -> list[date]:
    """Distinct days out of a query result; there is at most one per calendar day."""
    days = partitions.select(F.to_date(column).alias("day")).distinct().dropna()
    return sorted(row["day"] for row in days.collect())


def written_days(spark: SparkSession, path: str, days: list[date]) -> DataFrame:
    return spark.read.parquet(path).filter(F.col(PARTITION_COLUMN).isin(days))


def rebuild(
    spark: SparkSession,
    sources: Sources,
    partner: Partner,
    days: list[date],
    paths: Paths,
    rank_cap: int = RANK_CAP,
    top_n: int = TOP_N,
) -> None:
    """Build base, country and region tables for all given days together and replace exactly those
    day partitions. No days, no work. Running it again gives the same rows, scores to the last bit.
    Countries and regions need nothing of each other, so each has a thread that submits its jobs, and the
    cluster is not idle while one of them has few tasks."""
    if not days:
        return
    base = velocity_base(
        sources.streams, sources.resources, sources.names, partner,
        subdivisions=sources.subdivisions, zips=sources.zips, days=days,
    )
    few = len(set(days)) <= DAYS_AT_ONCE
    write_days(base, paths.base, base_schema(partner), days, gathered=few)
    written = written_days(spark, paths.base, days).drop(PARTITION_COLUMN)

    def rank(path: str, regional: bool) -> None:
        table = trending(written, partner, regional, rank_cap, top_n)
        write_days(table, path, trend_schema(partner, regional), days)

    in_thread = inheritable_thread_target(spark)(rank)
    with ThreadPoolExecutor(2) as pool:
        running = [pool.submit(in_thread, paths.countries, False), pool.submit(in_thread, paths.regions, True)]
    for job in running:
        job.result()


def stored_fingerprints(spark: SparkSession, marks: str, like: DataFrame) -> DataFrame:
    """Fingerprints of the last build, none if the folder does not exist yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(marks)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(marks)


def rebuild_changed(
    spark: SparkSession,
    sources: Sources,
    partner: Partner,
    first: date | str,
    last: date | str,
    paths: Paths,
    marks: str,
    **limits: int,
) -> list[date]:
    """Rebuild the report days from `first` to `last` (included) that look at stream days which are new,
    gone or changed since the last call, and store their fingerprints in `marks`. Returns the report days;
    none if nothing changed.

    Fingerprints are taken before the build and stored after it: rows that arrive in between, or a build
    that fails, make the next call do the days again.
    """
    groups = [PARTITION_COLUMN]
    now = staged(fingerprints(sources.streams, groups), "fingerprints")
    before = stored_fingerprints(spark, marks, now)
    changed = changed_groups(before, now, groups)
    days = days_listed(report_days_of(changed, first, last), "report_date")
    rebuild(spark, sources, partner, days, paths, **limits)
    write_table(now, marks)
    return days


def rebuild_alerts(
    spark: SparkSession,
    countries: dict[str, str],
    subscriptions: DataFrame,
    products: DataFrame,
    release_dates: DataFrame,
    images: DataFrame,
    day: date | str,
    path: str,
) -> None:
    """Build the alerts of one day from the written country tables (partner name to folder) and
    replace that day's partition."""
    trends = {
        name: on_day(spark.read.parquet(folder), day).drop(PARTITION_COLUMN)
        for name, folder in countries.items()
    }
    table = alerts(trends, subscriptions, products, release_dates, images, day)
    write_days(table, path, days=[as_date(day)])
