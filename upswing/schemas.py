"""Declared table schemas, built from the partner's counters where they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upswing.partners import Partner

PARTITION_COLUMN = "part_day"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_S, _L, _D, _DATE, _B = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.BooleanType()

STREAMS = _struct(
    (PARTITION_COLUMN, _DATE), ("isrc", _S), ("user_country_code", _S), ("user_country_name", _S),
    ("user_dma_number", _S), ("user_region_code", _S), ("user_dma_name", _S),
    ("user_postal_code", _S), ("stream_source", _S), ("source_uri", _S),
)

RESOURCES = _struct(
    ("isrc", _S), ("canopus_id", _L), ("formatted_title", _S), ("resource_rollup_id", _L)
)
NAMES = _struct(("canopus_id", _L), ("default_name", _S))
SUBDIVISIONS = _struct(("iso", _S), ("postcode", _S), ("iso2", _S))
ZIP_TO_DMA = _struct(("country_code", _S), ("zip_code", _S), ("dma_id", _S), ("dma_name", _S))
RELEASE_DATES = _struct(("isrc", _S), ("first_stream_date", _DATE))
IMAGES = _struct(("isrc", _S), ("track_image", _S))
PRODUCTS = _struct(("isrc", _S), ("sap_segment_code", _S))

_TERRITORY = _struct(("id", _S), ("name", _S))
_SUBSCRIPTION = _struct(
    ("name", _S), ("yourArtists", _B), ("yourLabels", _B),
    ("primaryTerritory", _TERRITORY), ("secondaryTerritory", _TERRITORY),
    ("partners", T.ArrayType(_struct(("name", _S), ("value", _B)))),
)
_APPLICATION = _struct(
    ("name", _S), ("active", _B),
    ("followedArtists", T.ArrayType(_struct(("_id", _L)))),
    ("followedLabels", T.ArrayType(_struct(("_id", _S), ("name", _S)))),
    ("subscriptions", T.ArrayType(_SUBSCRIPTION)),
)
USER_DOCS = _struct(
    ("_id", _S), ("firstName", _S), ("lastName", _S), ("email", _S), ("active", _B),
    ("applications", T.ArrayType(_APPLICATION)),
)

SUBSCRIPTIONS = _struct(
    ("userId", _S), ("firstname", _S), ("lastname", _S), ("email", _S), ("category", _S),
    ("artist", _L), ("label", _S), ("labelname", _S),
    ("primaryTerritoryCode", _S), ("primaryTerritoryName", _S),
    ("secondaryTerritoryCode", _S), ("secondaryTerritoryName", _S), ("partner", _S),
)

MESSAGES = _struct(("value", _S), ("attributes", T.MapType(_S, _S)))
OUTBOX = _struct(("to", _S), ("subject", _S), ("html", _S))


def base_schema(partner: Partner) -> T.StructType:
    return _struct(
        ("report_date", _DATE), ("canopus_id", _L), ("resource_rollup_id", _L),
        ("track_artist", _S), ("track_title", _S), ("country_code", _S), ("country_name", _S),
        ("region_dma_code", _S), ("dma_name", _S), ("isrc", _S), ("week", _S),
        *((counter, _L) for counter in partner.counters),
    )


# Order of the per-source blocks in the trending tables; `slot` is the one
# position that holds `artist` for one partner and `radio` for the other.
_BLOCK_ORDER = ("collection", "other", "slot", "album", "search", "playlist", "undeveloped_playlist")


def trend_sources(partner: Partner) -> list[str]:
    names = {rule.name for rule in partner.sources}
    slot = (names - set(_BLOCK_ORDER)).pop()
    return [slot if name == "slot" else name for name in _BLOCK_ORDER]


def trend_schema(partner: Partner, regional: bool = False) -> T.StructType:
    region = [("region_dma_code", _S), ("dma_name", _S)] if regional else []
    blocks = []
    for name in trend_sources(partner):
        prefix = f"streams_{name}"
        blocks += [(f"{prefix}_tw", _L), (f"{prefix}_lw", _L), (f"{prefix}_change", _L)]
        blocks += [(f"{prefix}_change_perc", _D)]
    return _struct(
        ("report_date", _DATE), ("isrc", _S), ("canopus_id", _L), ("resource_rollup_id", _L),
        ("track_artist", _S), ("track_title", _S), ("country_code", _S), ("country_name", _S),
        *region,
        ("streams_tw", _L), ("streams_lw", _L), ("streams_change", _L),
        *blocks,
        ("collection_perc", _D), ("playlist_perc", _D),
        ("rank_tw", _L), ("rank_lw", _L), ("rank_change", _L), ("rank_adj_score", _D),
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring `df` into the declared column order and types; unknown or missing columns fail."""
    expected, actual = set(schema.names), set(df.columns)
    if expected != actual:
        raise ValueError(
            f"columns differ: missing {sorted(expected - actual)}, "
            f"unexpected {sorted(actual - expected)}"
        )
    return df.select(*(F.col(field.name).cast(field.dataType) for field in schema))
