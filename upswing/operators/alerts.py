"""Joining trends to the subscriptions that follow them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upswing.functions.exact import exact_mean, exact_parts, exact_sum
from upswing.functions.scalar import released_in_window
from upswing.partners import APPLE, SPOTIFY, Partner
from upswing.schemas import SUBSCRIPTIONS, trend_schema, trend_sources
from upswing.sources.tables import staged

ALERT_EXTRAS = ["avg_velocity", "track_image", "first_stream_date"]


def alert_columns() -> list[str]:
    return [*SUBSCRIPTIONS.names, *trend_schema(SPOTIFY).names, *ALERT_EXTRAS]


MARKET_DAY = ["report_date", "country_code"]


def average_velocity(trends: DataFrame) -> DataFrame:
    """Mean of the positive scores per day and country. The sum is exact, so the mean does not depend on
    the order of a shuffle, and where all scores are equal each of them is at the average."""
    score = F.col("rank_adj_score")
    return (
        trends.filter(score > 0)
        .withColumn("parts", exact_parts(score))
        .groupBy(*MARKET_DAY)
        .agg(exact_sum("parts").alias("total"), F.count(score).alias("n"))
        .select(*MARKET_DAY, exact_mean(F.col("total"), F.col("n")).alias("avg_velocity"))
    )


def one_image(images: DataFrame) -> DataFrame:
    return images.groupBy("isrc").agg(F.max("track_image").alias("track_image"))


def above_average(trends: DataFrame) -> DataFrame:
    return trends.join(average_velocity(trends), MARKET_DAY).filter(
        F.col("rank_adj_score") >= F.col("avg_velocity")
    )


def in_alert_slots(trends: DataFrame, partner: Partner) -> DataFrame:
    """The alert table names its columns after one partner; the other's differing source goes into
    the column in the same position."""
    own, target = trend_sources(partner), trend_sources(SPOTIFY)
    renames = {
        f"streams_{a}_{part}": f"streams_{b}_{part}"
        for a, b in zip(own, target)
        if a != b
        for part in ("tw", "lw", "change", "change_perc")
    }
    return trends.withColumnsRenamed(renames)


def eligible_trends(
    trends: dict[str, DataFrame], release_dates: DataFrame, images: DataFrame, day: date | str
) -> DataFrame:
    """Trends worth an alert, of all partners together: at or above their market's average, and of
    the right age. Subscribers meet this reduced table, and dates and images are looked up once."""
    candidates = reduce(
        DataFrame.unionByName,
        [
            in_alert_slots(above_average(trends[partner.name]), partner).withColumn(
                "trend_partner", F.lit(partner.name)
            )
            for partner in (SPOTIFY, APPLE)
            if partner.name in trends
        ],
    )
    released = release_dates.filter(released_in_window(F.col("first_stream_date"), day))
    return candidates.join(released, "isrc").join(one_image(images), "isrc", "left")


def by_territory(subscriptions: DataFrame) -> DataFrame:
    """A row per subscription and distinct territory. Turns "primary or secondary matches" into a
    plain equality, so that the join compares only rows that belong together."""
    codes = F.array_distinct(
        F.array_compact(F.array("primaryTerritoryCode", "secondaryTerritoryCode"))
    )
    return subscriptions.withColumn("territory", F.explode(codes))


def _followed(followers: DataFrame, trends: DataFrame, item: Column) -> DataFrame:
    follows = (
        item
        & (followers["territory"] == trends["country_code"])
        & (followers["partner"] == trends["trend_partner"])
    )
    return followers.join(trends, follows).select(*alert_columns())


def artist_alerts(subscriptions: DataFrame, eligible: DataFrame) -> DataFrame:
    followers = by_territory(subscriptions.filter(F.col("category") == "artist"))
    return _followed(followers, eligible, followers["artist"] == eligible["canopus_id"])


def label_alerts(
    subscriptions: DataFrame, products: DataFrame, eligible: DataFrame
) -> DataFrame:
    """Products are cut to eligible tracks before subscribers meet them. A track listed twice for a
    label alerts twice; the digest removes copies."""
    listed = eligible.join(products.select("isrc", "sap_segment_code"), "isrc")
    followers = by_territory(subscriptions.filter(F.col("category") == "label"))
    return _followed(followers, listed, followers["label"] == listed["sap_segment_code"])


def alerts(
    trends: dict[str, DataFrame],
    subscriptions: DataFrame,
    products: DataFrame,
    release_dates: DataFrame,
    images: DataFrame,
    day: date | str,
) -> DataFrame:
    """All alerts of one day. `trends` maps partner names to their country trends of that day. The
    eligible trends serve both branches, so they are written out in between."""
    eligible = staged(eligible_trends(trends, release_dates, images, day), "eligible")
    return artist_alerts(subscriptions, eligible).unionByName(
        label_alerts(subscriptions, products, eligible)
    )
