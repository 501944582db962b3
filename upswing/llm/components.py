"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.llm.hot import join_by_key
from upswing.sources.tables import discard, staged


def _lowest(links: DataFrame) -> DataFrame:
    """Smallest neighbour of every node and its number of links; pre-aggregated."""
    return links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))


def _large_star(links: DataFrame, count: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = _lowest(both).select("u", F.least("m", "u").alias("m"), "n")
    joined = join_by_key(both, lowest, "u", "n", 2 * count).filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, count: int) -> DataFrame:
    lowest = _lowest(links)
    joined = join_by_key(links, lowest, "u", "n", count).filter("v > m")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        lowest.select("u", F.col("m").alias("v"))
    )


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    table = staged(links, "links")
    return table, tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """`id` and `component` (the smallest id reachable) of every node of `links` (`a`, `b`).

    Every step replaces links by links to smaller ids; the number of steps is logarithmic, and each
    is written to the shared folder. Nodes with a large part of all links are sent to their links. Nothing
    is collected but a count and a checksum. Links with a
    null end and links of a node to itself say nothing; without links the result is empty.
    """
    start = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    table, sum_before = _written(start.distinct())
    while True:
        count = sum_before[0]
        turned, _ = _written(_large_star(table, count).distinct())
        stepped, checksum = _written(_small_star(turned, count).distinct())
        discard(table.sparkSession, table.inputFiles()[0].rsplit("/", 1)[0])
        table = stepped
        if checksum == sum_before:
            break
        sum_before = checksum
    roots = table.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return table.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
