"""Run registered queries and their SQL next to each other and compare whole results.

    python -m verification.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.queries import QUERIES, SQL

# Spark settings that go with a local run.
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
}


def local_session(cpus: str = "8") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("upswing")
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> None:
    """Give a local check session a folder for intermediate tables if it has none. Anywhere else the
    setting has to be made by whoever starts the session."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="upswing-check-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    return None if value != value else value + 0.0 if isinstance(value, float) else value


def spark_rows(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(columns), rows


def differences(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None if both sides agree, else a short account."""
    df = QUERIES[name](spark, sf_dir)
    mine = spark_rows(df)
    if name not in SQL:
        return None if mine else "no rows"
    columns, theirs = sql_rows(connection, SQL[name])
    if columns != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    if mine != theirs:
        only_mine, only_theirs = mine - theirs, theirs - mine
        return (
            f"{mine.total()} and {theirs.total()} rows; only Spark {only_mine.total()}: "
            f"{list(only_mine)[:2]}; only SQL {only_theirs.total()}: {list(only_theirs)[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, connection, failed = local_session(), duckdb_tables(sf_dir), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            found = differences(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:800]}"
        failed += found is not None
        print(f"{name:34s} {time.time() - start:6.1f}s {found or 'ok'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
