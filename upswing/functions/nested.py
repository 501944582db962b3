"""Expressions over the nested subscriber documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def _items(array: Column, ddl: str) -> Column:
    """The array, or an empty one where it is missing."""
    return F.coalesce(array, F.array().cast(ddl))


_ITEM = "struct<category:string,artist:bigint,label:string,labelname:string>"


def qualifies(subscription: Column, name: str) -> Column:
    """The alert subscription with at least one of its two topics switched on."""
    return (subscription["name"] == name) & (
        _true(subscription["yourArtists"]) | _true(subscription["yourLabels"])
    )


def qualifying_subscriptions(application: Column, name: str) -> Column:
    return F.filter(application["subscriptions"], lambda s: qualifies(s, name))


def application_matches(application: Column, app: str) -> Column:
    return F.coalesce(application["name"].contains(app), F.lit(False))


def application_opens_gate(application: Column, app: str, subscription: str) -> Column:
    return (
        application_matches(application, app)
        & _true(application["active"])
        & (F.size(application["followedArtists"]) > 0)
        & _true(F.exists(application["subscriptions"], lambda s: qualifies(s, subscription)))
    )


def user_passes_gate(app: str, subscription: str) -> Column:
    """Names, email and an active account, plus one active application that qualifies."""
    named = F.col("firstName").isNotNull() & F.col("lastName").isNotNull()
    reachable = F.col("email").isNotNull() & _true(F.col("active"))
    qualified = F.exists("applications", lambda a: application_opens_gate(a, app, subscription))
    return named & reachable & _true(qualified)


def followed_items(application: Column, subscriptions: Column) -> Column:
    """Followed artists and labels as one tagged list, per qualifying subscription and topic."""
    artists = F.transform(
        _items(application["followedArtists"], "array<struct<_id:bigint>>"),
        lambda a: F.struct(
            F.lit("artist").alias("category"),
            a["_id"].alias("artist"),
            F.lit(None).cast("string").alias("label"),
            F.lit(None).cast("string").alias("labelname"),
        ),
    )
    labels = F.transform(
        _items(application["followedLabels"], "array<struct<_id:string,name:string>>"),
        lambda x: F.struct(
            F.lit("label").alias("category"),
            F.lit(None).cast("bigint").alias("artist"),
            x["_id"].alias("label"),
            x["name"].alias("labelname"),
        ),
    )
    nothing = F.array().cast(f"array<{_ITEM}>")
    return F.flatten(
        F.transform(
            subscriptions,
            lambda s: F.concat(
                F.when(_true(s["yourArtists"]), artists).otherwise(nothing),
                F.when(_true(s["yourLabels"]), labels).otherwise(nothing),
            ),
        )
    )


def label_names(application: Column) -> Column:
    return F.transform(application["followedLabels"], lambda x: x["name"])


def territories(subscriptions: Column) -> Column:
    """Primary territory, then the secondary one if it has an id, over all subscriptions."""
    return F.flatten(
        F.transform(
            subscriptions,
            lambda s: F.when(
                s["secondaryTerritory"]["id"].isNotNull(),
                F.array(s["primaryTerritory"], s["secondaryTerritory"]),
            ).otherwise(F.array(s["primaryTerritory"])),
        )
    )


def enabled_partners(subscriptions: Column) -> Column:
    return F.flatten(
        F.transform(
            subscriptions,
            lambda s: F.transform(
                F.filter(
                    _items(s["partners"], "array<struct<name:string,value:boolean>>"),
                    lambda p: _true(p["value"]),
                ),
                lambda p: p["name"],
            ),
        )
    )
