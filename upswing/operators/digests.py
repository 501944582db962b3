"""Alerts to one JSON document and one message per subscriber, partner and country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.functions.scalar import image_or_default, strip_newlines
from upswing.operators.alerts import alert_columns

DIGEST_KEYS = ["email", "partner", "country_code"]

# Size of a digest and subject of its message.
DIGEST_SIZE = 10
SUBJECT = "Velocity Alerts"

_TEXT = ["isrc", "track_artist", "track_title", "country_code", "country_name"]
_NOT_PER_TRACK = {
    "userId", "firstname", "lastname", "email", "category", "artist", "label", "partner",
    "primaryTerritoryCode", "primaryTerritoryName",
    "secondaryTerritoryCode", "secondaryTerritoryName", "report_date",
}
_TIE_BREAKS = [
    "isrc", "canopus_id", "resource_rollup_id", "artist", "label", "userId", "firstname",
    "lastname", "labelname", "track_artist", "track_title", "primaryTerritoryCode",
    "secondaryTerritoryCode", "primaryTerritoryName", "secondaryTerritoryName",
    "first_stream_date",
]


def digest_columns() -> list[str]:
    """The columns a digest is made of: all alert columns but the category."""
    return [name for name in alert_columns() if name != "category"]


def distinct_alerts(alerts: DataFrame) -> DataFrame:
    """Drop copies. A track that reaches a subscriber both through an artist and through a label
    keeps both rows."""
    return alerts.select(*digest_columns()).distinct()


def top_alerts(distinct: DataFrame, n: int = DIGEST_SIZE) -> DataFrame:
    """The n best alerts per digest with their position `rn`. Spark cuts every partition to n per
    digest before the shuffle, so a subscriber with very many alerts does not fill one task."""
    order = [F.col("rank_adj_score").desc_nulls_last()]
    order += [F.col(name).asc_nulls_last() for name in _TIE_BREAKS]
    position = F.row_number().over(Window.partitionBy(*DIGEST_KEYS).orderBy(*order))
    return distinct.withColumn("rn", position).filter(F.col("rn") <= n)


def _track() -> Column:
    special = {
        **{name: strip_newlines(F.col(name)) for name in _TEXT},
        "track_image": image_or_default(F.col("track_image")),
    }
    fields = [name for name in digest_columns() if name not in _NOT_PER_TRACK]
    return F.struct(*(special.get(name, F.col(name)).alias(name) for name in fields))


def digests(alerts: DataFrame, n: int = DIGEST_SIZE) -> DataFrame:
    """Nested digest documents; at most `n` tracks each, so the collected lists stay small."""
    top = top_alerts(distinct_alerts(alerts), n).select(
        *DIGEST_KEYS, "rn", "report_date", "firstname", "lastname", "country_name",
        _track().alias("track"),
    )
    header = F.struct("report_date", "firstname", "lastname", "country_name")
    grouped = top.groupBy(*DIGEST_KEYS).agg(
        F.min_by(header, "rn").alias("header"),
        F.sort_array(F.collect_list(F.struct("rn", "track"))).alias("ranked"),
    )
    return grouped.select(
        F.col("header.report_date").alias("report_date"),
        F.struct("header.firstname", "header.lastname", "email").alias("user"),
        F.struct("country_code", "header.country_name").alias("territory"),
        "partner",
        F.transform("ranked", lambda r: r["track"]).alias("isrcs"),
    )


def message_id(report_date: Column, *parts: Column) -> Column:
    """The same for every publishing of a digest: a checksum over its day and key, NULL being a value
    of its own."""
    marked = [
        F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c.cast("string")))
        for c in (report_date, *parts)
    ]
    lengths = F.concat_ws(",", *(F.length(c).cast("string") for c in marked))
    return F.sha2(F.concat_ws("|", lengths, *marked), 256)


def messages(digest_documents: DataFrame) -> DataFrame:
    """JSON payload and string attributes per digest. NULL fields are left out of the payload."""
    user, country = F.col("user"), F.col("territory.country_code")
    digest = message_id(F.col("report_date"), user["email"], F.col("partner"), country)
    return digest_documents.select(
        F.to_json(F.struct("report_date", "user", "territory", "partner", "isrcs")).alias("value"),
        F.create_map(
            F.lit("email"), user["email"],
            F.lit("firstname"), user["firstname"],
            F.lit("lastname"), user["lastname"],
            F.lit("subject"), F.lit(SUBJECT),
            F.lit("message_id"), digest,
        ).alias("attributes"),
    )
