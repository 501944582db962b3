"""Subscriber documents to flat subscription rows: narrow work only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.functions.nested import (
    application_matches,
    enabled_partners,
    followed_items,
    qualifying_subscriptions,
    territories,
    user_passes_gate,
)
from upswing.schemas import SUBSCRIPTIONS, conform


def gated_users(docs: DataFrame, app: str, subscription: str) -> DataFrame:
    return docs.filter(user_passes_gate(app, subscription))


def matching_applications(docs: DataFrame, app: str, subscription: str) -> DataFrame:
    """One row per user and application of that name with what the subscription says. Once a user
    is through the gate, inactive applications of the name count too."""
    applications = docs.select(
        F.col("_id").alias("userId"),
        F.col("firstName").alias("firstname"),
        F.col("lastName").alias("lastname"),
        "email",
        F.explode("applications").alias("application"),
    ).filter(application_matches(F.col("application"), app))
    chosen = applications.withColumn(
        "chosen", qualifying_subscriptions(F.col("application"), subscription)
    )
    return chosen.select(
        "userId", "firstname", "lastname", "email",
        followed_items(F.col("application"), F.col("chosen")).alias("items"),
        territories(F.col("chosen")).alias("territories"),
        enabled_partners(F.col("chosen")).alias("partners"),
    )


def flatten_subscriptions(docs: DataFrame, app: str, subscription: str) -> DataFrame:
    """Followed item x enabled partner for every user who passes the gate. `app` is a part of the
    application's name, `subscription` the exact name of the alert subscription."""
    wide = matching_applications(gated_users(docs, app, subscription), app, subscription)
    primary, secondary = F.get("territories", F.lit(0)), F.get("territories", F.lit(1))
    rows = wide.select(
        "userId", "firstname", "lastname", "email",
        primary["id"].alias("primaryTerritoryCode"),
        primary["name"].alias("primaryTerritoryName"),
        secondary["id"].alias("secondaryTerritoryCode"),
        secondary["name"].alias("secondaryTerritoryName"),
        "partners",
        F.inline("items"),
    ).select("*", F.explode("partners").alias("partner")).drop("partners")
    return conform(rows, SUBSCRIPTIONS)
