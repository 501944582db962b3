"""Day-partitioned tables, plain tables and intermediate results."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upswing.functions.scalar import as_date, in_window
from upswing.schemas import PARTITION_COLUMN, conform

ROWS_PER_TASK = 500_000
BROADCAST_ROWS = 100_000


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def on_day(df: DataFrame, day: date | str) -> DataFrame:
    return df.filter(F.col(PARTITION_COLUMN) == F.lit(as_date(day)))


def since_day(df: DataFrame, day: date | str) -> DataFrame:
    return df.filter(F.col(PARTITION_COLUMN) >= F.lit(as_date(day)))


def in_days(df: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Partitions from `first` to `last`, both included."""
    return df.filter(F.col(PARTITION_COLUMN).between(F.lit(as_date(first)), F.lit(as_date(last))))


def stream_window(streams: DataFrame, day: date | str) -> DataFrame:
    """The 14 stream days that one report day looks at."""
    return streams.filter(in_window(F.col(PARTITION_COLUMN), day))


def _by_day(
    df: DataFrame, schema: StructType | None, days: list[date] | None
) -> DataFrame:
    """Rows ready to be written by day; one of a day that is not listed fails the write."""
    if PARTITION_COLUMN not in df.columns:
        df = df.withColumn(PARTITION_COLUMN, F.col("report_date"))
    if schema is not None:
        with_day = StructType([*(f for f in schema if f.name != PARTITION_COLUMN)])
        df = conform(df, with_day.add(PARTITION_COLUMN, "date"))
    if days is not None:
        day = F.col(PARTITION_COLUMN)
        stray = F.raise_error(F.concat(F.lit("row of a day that is not listed: "), day.cast("string")))
        df = df.withColumn(
            PARTITION_COLUMN, F.when(day.isin(days), day).otherwise(stray.cast("date"))
        )
    return df


def write_days(
    df: DataFrame,
    path: str,
    schema: StructType | None = None,
    days: list[date] | None = None,
    table: str | None = None,
    gathered: bool = False,
) -> None:
    """Replace day partitions, leaving the others as they are.

    The day comes from `part_day`, or else from `report_date`. If `days` are listed, exactly those are
    replaced: a row of another day fails the write before anything is replaced, and days that turn out
    to have no rows are emptied; which days have rows is observed during the write itself. The catalog
    table `table` over this path, if named, gets to know the written days.
    The rebalance hint gathers a day into a few files of advisory size instead of one per task, and
    splits days too large for one task. Rows that are `gathered` in tasks of bounded size already, each
    with many rows of a few days, are written from there and not moved again.
    """
    df = _by_day(df, schema, days)
    seen = Observation()
    (
        (df if gathered else df.hint("rebalance", PARTITION_COLUMN))
        .observe(seen, F.collect_set(PARTITION_COLUMN).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )
    for day in sorted(set(days or []) - set(seen.get["days"])):
        empty = df.drop(PARTITION_COLUMN).limit(0)
        empty.write.mode("overwrite").parquet(f"{path}/{PARTITION_COLUMN}={day.isoformat()}")
    if table is not None:
        for day in sorted(set(seen.get["days"])):
            partition = f"PARTITION ({PARTITION_COLUMN} = DATE '{day.isoformat()}')"
            df.sparkSession.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition}")
        df.sparkSession.catalog.refreshTable(table)


def swap_days(
    df: DataFrame,
    table: str,
    path: str,
    days: list[date] | None = None,
    schema: StructType | None = None,
) -> str:
    """Replace days of the catalog table `table`, each as a whole at one moment; the others stay.

    Rows go to a new build folder beside `path` first. Only when it is complete do the written days
    change over to it in the catalog, and listed days without rows leave the table: a failure before that
    leaves the old days, and one in between leaves each day either old or new, never mixed. Only the
    written days are touched; nothing is listed and empty days cost no job. Read the table by its name.
    The former files stay for readers that are at work; whoever knows that there are none discards them.
    Returns the build folder.
    """
    df = _by_day(df, schema, days)
    build = f"{path.rstrip('/')}-builds/{uuid4().hex}"
    seen = Observation()
    (
        df.hint("rebalance", PARTITION_COLUMN)
        .observe(seen, F.collect_set(PARTITION_COLUMN).alias("days"))
        .write.partitionBy(PARTITION_COLUMN)
        .parquet(build)
    )
    written = set(seen.get["days"])
    _change_over(
        df.sparkSession,
        table,
        {
            day: f"{build}/{PARTITION_COLUMN}={day.isoformat()}" if day in written else None
            for day in sorted({*written, *(days or [])})
        },
    )
    return build


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _change_over(spark: SparkSession, table: str, places: dict[date, str | None]) -> None:
    """Point partitions of a catalog table to their new folders; None takes a day out of it."""
    for day, place in places.items():
        partition = f"PARTITION ({PARTITION_COLUMN} = DATE '{day.isoformat()}')"
        if place is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partition}")
            continue
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition} LOCATION {_text(place)}")
        spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION {_text(place)}")


def write_table(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Truncate and load a whole table."""
    (df if schema is None else conform(df, schema)).write.mode("overwrite").parquet(path)


def create_day_table(spark: SparkSession, name: str, schema: StructType, path: str) -> bool:
    """Create a day-partitioned table with the declared columns over a path, and make days that are
    already there known; False if the table exists. Give its name to `write_days`, which makes the days
    it writes known."""
    if spark.catalog.tableExists(name):
        return False
    fields = [field for field in schema if field.name != PARTITION_COLUMN]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {PARTITION_COLUMN} DATE) USING parquet "
        f"PARTITIONED BY ({PARTITION_COLUMN}) LOCATION {_text(path)}"
    )
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.catalog.recoverPartitions(name)
    return True


def work_dir(spark: SparkSession) -> str:
    """Folder of this application for intermediate tables, under the shared folder that
    `spark.checkpoint.dir` (or else the context's checkpoint folder) names."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/upswing-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    For results that several later steps read: the work is done once, the lineage is cut, and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """`df` dealt by `columns` into tasks of about `ROWS_PER_TASK` rows, `rows` being their number or how
    many will be made of them. Shuffles are else sized by compressed bytes, which say little about the
    memory that a task's hash tables take."""
    return df.repartition(max(1, -(-rows // ROWS_PER_TASK)), *columns)


def sent_if_small(df: DataFrame) -> DataFrame:
    """`df` marked to be sent to whatever it is joined to, if it has up to `BROADCAST_ROWS` short rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_work(spark: SparkSession) -> None:
    """Delete everything this application has staged; for the end of a run."""
    discard(spark, work_dir(spark))
