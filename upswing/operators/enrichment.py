"""Catalogue and postcode lookups. Dimensions are reduced before they meet the counts; how they are
joined is left to Spark, which broadcasts a side only when its measured size allows it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.functions.scalar import postcode_region_code
from upswing.sources.tables import sent_if_small


def one_title(resources: DataFrame) -> DataFrame:
    """One title per (isrc, canopus_id, resource_rollup_id): the smallest, NULL only if all are."""
    return resources.groupBy("isrc", "canopus_id", "resource_rollup_id").agg(
        F.min("formatted_title").alias("formatted_title")
    )


def artist_names(names: DataFrame) -> DataFrame:
    return names.select("canopus_id", "default_name").distinct()


def catalogue(resources: DataFrame, names: DataFrame) -> DataFrame:
    """Items that have both a title and an artist, ready for a single join to the counts."""
    titled = one_title(resources).filter(F.col("formatted_title").isNotNull())
    named = artist_names(names).filter(F.col("default_name").isNotNull())
    return titled.join(named, "canopus_id").select(
        "isrc",
        "canopus_id",
        "resource_rollup_id",
        F.col("default_name").alias("track_artist"),
        F.col("formatted_title").alias("track_title"),
    )


def with_metadata(counts: DataFrame, resources: DataFrame, names: DataFrame) -> DataFrame:
    """Every count row with title and artist where known. An item registered several times gives a
    row per registration."""
    titles = one_title(resources)
    return (
        counts.join(titles, "isrc", "left")
        .join(artist_names(names), "canopus_id", "left")
        .withColumnsRenamed({"default_name": "track_artist", "formatted_title": "track_title"})
    )


def with_known_metadata(
    counts: DataFrame, resources: DataFrame, names: DataFrame, dealt: bool = False
) -> DataFrame:
    """Only count rows whose artist and title are both known. Where counts are `dealt` by track into tasks
    of bounded size already, items are hashed there, and counts need not be sorted."""
    items = catalogue(resources, names)
    return counts.join(items.hint("shuffle_hash") if dealt else items, "isrc")


def one_subdivision(subdivisions: DataFrame) -> DataFrame:
    """One region code per (iso, postcode), out of rows that have both a postcode and a code."""
    return (
        subdivisions.filter((F.col("postcode") != "") & (F.col("iso2") != ""))
        .groupBy("iso", "postcode")
        .agg(F.min("iso2").alias("iso2"))
    )


def postcode_regions(subdivisions: DataFrame, zips: DataFrame) -> DataFrame:
    """Region code and DMA name per (country, postcode). Postcodes listed with several DMAs keep
    one row for each."""
    areas = one_subdivision(subdivisions).withColumnsRenamed(
        {"iso": "country_code", "postcode": "user_postal_code"}
    )
    dmas = zips.withColumnRenamed("zip_code", "user_postal_code")
    return areas.join(dmas, ["country_code", "user_postal_code"], "full").select(
        "country_code",
        "user_postal_code",
        postcode_region_code(F.col("dma_id"), F.col("iso2")).alias("region_dma_code"),
        F.coalesce("dma_name", F.lit("")).alias("dma_name"),
    )


def with_postcode_region(counts: DataFrame, subdivisions: DataFrame, zips: DataFrame) -> DataFrame:
    """Counts per postcode with the region it lies in, '' where none is known."""
    regions = sent_if_small(postcode_regions(subdivisions, zips))
    return (
        counts.join(regions, ["country_code", "user_postal_code"], "left")
        .fillna("", subset=["region_dma_code", "dma_name"])
        .drop("user_postal_code")
    )
