"""Input tables of the domain, derived by Spark from the generated TPC-H-like tables.

Every row of the source tables is used; special cases (missing titles, unknown markets, double
registrations) come from values computed out of the keys, see FIXTURES.md.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing import schemas
from upswing.schemas import conform
from upswing.sources.tables import spread

REPORT_DAY = date(2024, 1, 28)
APP, SUBSCRIPTION = "trendwatch", "risingMail"
# A document is as much work as so many plain rows; customers come in one file, of which a task may get all.
DOCUMENT_ROWS = 25

COUNTRIES = (
    "US SE AR AU BE BR DE DK NO ES FI FR GB IT MX NL JP CA KR PL IN CN ZA NZ TR"
).split()
SOURCES = "collection other artist album search others_playlist playlist radio".split()


# Declared types of the columns in use, so that opening a table does not read its files.
TABLES = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), index)


def _pad(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _isrc(item: Column) -> Column:
    return F.concat(F.lit("ISRC"), _pad(item, 8))


def streams(spark: SparkSession, sf_dir: str, item: str = "l_partkey div 4") -> DataFrame:
    """A line item is a stream: its part is the track, its supplier the market and the source, its
    order the listener. `item` says where the track's number comes from instead."""
    rows = table(spark, sf_dir, "lineitem")
    k, cc = F.col("l_orderkey"), _pick(COUNTRIES, (F.col("l_suppkey") % 25).cast("int"))
    us = cc == "US"
    dma = (F.lit(500) + k % 10).cast("string")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit(date(1995, 1, 1))) % 28
    region = (
        F.when(k % 89 == 0, F.lit(None).cast("string"))
        .when(us | (k % 13 == 0), "")
        .when(k % 11 == 0, "ZZ-1")
        .otherwise(F.concat(cc, F.lit("-"), (k % 4 + 1).cast("string")))
    )
    return rows.select(
        F.date_add(F.lit(date(2024, 1, 1)), day.cast("int")).alias("part_day"),
        _isrc(F.expr(item)).alias("isrc"),
        F.when(k % 97 != 0, cc).alias("user_country_code"),
        F.concat(F.lit("Country "), cc).alias("user_country_name"),
        F.when(us, dma).otherwise("").alias("user_dma_number"),
        region.alias("user_region_code"),
        F.when(us, F.concat(F.lit("DMA "), dma)).otherwise("").alias("user_dma_name"),
        _pad(k % 40, 5).alias("user_postal_code"),
        _pick(SOURCES, ((F.col("l_linenumber") + F.col("l_suppkey")) % 8).cast("int")).alias(
            "stream_source"
        ),
        F.when(F.col("l_suppkey") % 2 == 0, "")
        .otherwise(F.concat(F.lit("uri:"), F.col("l_suppkey").cast("string")))
        .alias("source_uri"),
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.expr("p_partkey div 4").alias("m")
    )


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, m = F.col("p_partkey"), F.col("m")
    second = (m % 25 == 0) & (p % 4 >= 2)
    return _parts(spark, sf_dir).select(
        F.when(m % 50 != 13, _isrc(m)).alias("isrc"),
        (F.expr("m div 5") + F.when(second, 1).otherwise(0)).alias("canopus_id"),
        F.when(m % 50 != 7, F.col("p_name")).alias("formatted_title"),
        (m + 1000).alias("resource_rollup_id"),
    )


def order_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a track of its own: so many tracks that a market's default limits bind."""
    k = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(k).distinct().select(
        _isrc(k).alias("isrc"), k.alias("canopus_id"),
        F.concat(F.lit("Track "), k.cast("string")).alias("formatted_title"),
        (k + 1000).alias("resource_rollup_id"),
    )


def order_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(k).distinct().select(
        k.alias("canopus_id"), F.concat(F.lit("Artist "), k.cast("string")).alias("default_name")
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    artist = F.expr("p_partkey div 20")
    alias = F.when((artist % 37 == 5) & (F.col("p_partkey") % 2 == 1), " (alias)").otherwise("")
    name = F.when(
        artist % 41 != 39, F.concat(F.lit("Artist "), artist.cast("string"), alias)
    )
    return table(spark, sf_dir, "part").select(
        artist.alias("canopus_id"), name.alias("default_name")
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), _pick(COUNTRIES, F.col("c_nationkey")).alias("cc")
    )


def subdivisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, cc = F.col("k"), F.col("cc")
    iso2 = F.when(k % 40 == 5, "").otherwise(
        F.concat(cc, F.lit("-"), (k % 3 + 1).cast("string"))
    )
    return _customers(spark, sf_dir).filter(cc != "US").select(
        cc.alias("iso"),
        F.when(k % 41 == 0, "").otherwise(_pad(k % 40, 5)).alias("postcode"),
        iso2.alias("iso2"),
    )


def zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    dma = (F.lit(500) + (k % 40) % 10).cast("string")
    second = F.when((k % 40 < 10) & (k % 80 >= 40), " alt").otherwise("")
    return (
        _customers(spark, sf_dir)
        .filter(F.col("cc") == "US")
        .select(
            F.col("cc").alias("country_code"),
            F.when(k % 40 == 39, "99999").otherwise(_pad(k % 40, 5)).alias("zip_code"),
            dma.alias("dma_id"),
            F.concat(F.lit("DMA "), dma, second).alias("dma_name"),
        )
        .distinct()
    )


def release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.col("m") % 200) * 5
    return _parts(spark, sf_dir).select(
        _isrc(F.col("m")).alias("isrc"),
        F.date_sub(F.lit(REPORT_DAY), age.cast("int")).alias("first_stream_date"),
    ).distinct()


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("https://img.example.com/"), F.col("p_partkey").cast("string"))
    return _parts(spark, sf_dir).select(
        _isrc(F.col("m")).alias("isrc"), F.when(F.col("m") % 3 != 0, url).alias("track_image")
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select(
        _isrc(F.col("m")).alias("isrc"),
        F.concat(F.lit("LBL"), F.expr("m div 100").cast("string")).alias("sap_segment_code"),
    )


def user_docs(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """`dealt` moves customers into tasks of bounded size first; else tasks are those of the file."""
    k = F.col("c_custkey")
    no_text = F.lit(None).cast("string")

    def text(prefix: str, number: Column = k) -> Column:
        return F.concat(F.lit(prefix), number.cast("string"))

    def followed(*ids: Column) -> Column:
        return F.array(*(F.struct(i.cast("bigint").alias("_id")) for i in ids))

    def territory(code: Column, name: Column) -> Column:
        return F.struct(code.alias("id"), name.alias("name"))

    def partners(spotify: Column, apple: Column) -> Column:
        return F.array(
            F.struct(F.lit("Spotify").alias("name"), spotify.alias("value")),
            F.struct(F.lit("Apple").alias("name"), apple.alias("value")),
        )

    def subscription(
        name: str, artists: Column, labels: Column, first: Column, second: Column, to: Column
    ) -> Column:
        return F.struct(
            F.lit(name).alias("name"), artists.alias("yourArtists"), labels.alias("yourLabels"),
            first.alias("primaryTerritory"), second.alias("secondaryTerritory"),
            to.alias("partners"),
        )

    def application(
        name: str, active: bool, artists: Column, labels: Column, subscriptions: Column
    ) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.lit(active).alias("active"),
            artists.alias("followedArtists"), labels.alias("followedLabels"),
            subscriptions.alias("subscriptions"),
        )

    yes, no = F.lit(True), F.lit(False)
    nowhere = territory(no_text, no_text)
    cc = _pick(COUNTRIES, (k % 25).cast("int"))
    home = F.when(k % 10 == 0, territory(F.lit("XX"), F.lit("Global"))).otherwise(
        territory(cc, F.concat(F.lit("Country "), cc))
    )
    second = F.when(
        k % 4 == 0, territory(F.lit("US"), F.lit("Country US, home"))
    ).otherwise(nowhere)
    artist, label = F.expr("c_custkey div 15"), F.expr("c_custkey div 300")
    main_subscription = subscription(
        SUBSCRIPTION, k % 2 == 0, F.when(k % 29 != 0, k % 3 == 0), home, second,
        partners((k % 2 == 0) | (k % 3 == 0), k % 3 != 0),
    )
    digest = subscription("weeklyDigest", yes, yes, nowhere, nowhere, partners(yes, yes))
    extra = subscription(
        SUBSCRIPTION, no, yes,
        territory(F.lit("NO"), F.lit("Country NO")), territory(F.lit("DK"), F.lit("Country DK")),
        partners(yes, no),
    )
    labels = F.array(
        F.struct(text("LBL", label).alias("_id"), text("Label, no. ", label).alias("name"))
    )
    main = application(
        APP, True,
        F.when(k % 23 == 0, F.array().cast("array<struct<_id:bigint>>"))
        .otherwise(followed(artist, artist + 7)),
        labels,
        F.when(k % 31 == 0, F.array(main_subscription, digest, extra))
        .otherwise(F.array(main_subscription, digest)),
    )
    other = application("catalog", True, followed(artist), labels, F.array(digest))
    beta = application(
        f"{APP}-beta", False, followed(artist + 1), labels,
        F.array(
            subscription(
                SUBSCRIPTION, yes, yes, territory(F.lit("SE"), F.lit("Country SE")), nowhere,
                partners(no, yes),
            )
        ),
    )
    nothing = F.array().cast(schemas.USER_DOCS["applications"].dataType)
    applications = F.concat(
        F.array(main),
        F.when(k % 5 == 0, F.array(other)).otherwise(nothing),
        F.when(k % 19 == 0, F.array(beta)).otherwise(nothing),
    )
    customers = table(spark, sf_dir, "customer").select(k)
    if dealt:
        customers = spread(customers, DOCUMENT_ROWS * customers.count(), "c_custkey")
    docs = customers.select(
        text("u").alias("_id"), text("First").alias("firstName"), text("Last").alias("lastName"),
        F.when(k % 17 != 0, F.concat(text("user"), F.lit("@example.com"))).alias("email"),
        (k % 7 != 0).alias("active"), applications.alias("applications"),
    )
    return conform(docs, schemas.USER_DOCS)
