"""Small hand-written tables."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing import SPOTIFY
from upswing.schemas import STREAMS, base_schema

DAY = date(2024, 1, 28)


def base_table(spark, rows, partner=SPOTIFY) -> DataFrame:
    """Base rows out of (country_code, country_name, isrc, week, streams); all streams count as
    `collection`. Optional further fields: region_dma_code, dma_name."""
    schema = base_schema(partner)
    full = []
    for row in rows:
        code, name, isrc, week, streams, *region = row
        values = {
            "report_date": DAY, "canopus_id": 1, "resource_rollup_id": 1, "track_artist": "A",
            "track_title": "T", "country_code": code, "country_name": name,
            "region_dma_code": region[0] if region else "", "dma_name": "", "isrc": isrc,
            "week": week, "streams": streams, "streams_collection": streams,
        }
        full.append(tuple(values.get(f.name, 0) for f in schema))
    return spark.createDataFrame(full, schema)


def stream_table(spark, rows) -> DataFrame:
    """Streams out of dictionaries; absent text fields are empty."""
    full = []
    for row in rows:
        full.append(tuple(row.get(f.name, "" if f.name != "isrc" else "I1") for f in STREAMS))
    return spark.createDataFrame(full, STREAMS)


def collected(df: DataFrame, *columns: str) -> set[tuple]:
    return {tuple(row) for row in df.select(*columns).collect()}


def by_isrc(df: DataFrame) -> dict[str, dict]:
    return {row["isrc"]: row.asDict() for row in df.collect()}


def executed_plan(df: DataFrame) -> str:
    """Final physical plan after running the query."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def planned(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df: DataFrame) -> list[str]:
    rounded = df.select(
        *(
            F.round(c, 9).alias(c) if t == "double" else F.col(c)
            for c, t in sorted(df.dtypes)
        )
    )
    return sorted(map(repr, rounded.collect()))
