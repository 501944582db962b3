"""What differs between the two streaming partners, as data."""

from __future__ import annotations

from dataclasses import dataclass

# The two synthetic markets and the home market left out of the second one.
GLOBAL_CODE, GLOBAL_NAME = "XX", "Global"
EX_HOME_CODE, EX_HOME_NAME = "EX-US", "Global Ex-U.S."
HOME_MARKET = "US"

# Markets whose region code has to start with the market's own code.
PREFIXED_MARKETS = (
    "SE", "AR", "AU", "BE", "BR", "DE", "DK", "NO",
    "ES", "FI", "FR", "GB", "IT", "MX", "NL",
)


@dataclass(frozen=True)
class SourceRule:
    """One `streams_<name>` counter: rows with this stream_source (and, if given, an empty or
    non-empty source_uri)."""

    name: str
    stream_source: str
    uri_empty: bool | None = None

    @property
    def column(self) -> str:
        return f"streams_{self.name}"


@dataclass(frozen=True)
class Partner:
    name: str
    sources: tuple[SourceRule, ...]
    region_from_postcode: bool
    prefixed_regions_only: bool
    country_rank_change_is_tw_minus_lw: bool

    @property
    def counters(self) -> list[str]:
        return ["streams", *(rule.column for rule in self.sources)]


# Stream sources per partner, in the column order of the base table.
SPOTIFY = Partner(
    name="Spotify",
    sources=(
        SourceRule("collection", "collection"),
        SourceRule("playlist", "others_playlist", uri_empty=False),
        SourceRule("undeveloped_playlist", "others_playlist", uri_empty=True),
        SourceRule("other", "other"),
        SourceRule("artist", "artist"),
        SourceRule("album", "album"),
        SourceRule("search", "search"),
    ),
    region_from_postcode=False,
    prefixed_regions_only=True,
    country_rank_change_is_tw_minus_lw=False,
)

APPLE = Partner(
    name="Apple",
    sources=(
        SourceRule("collection", "collection"),
        SourceRule("playlist", "playlist"),
        SourceRule("undeveloped_playlist", "others_playlist"),
        SourceRule("other", "other"),
        SourceRule("album", "album"),
        SourceRule("search", "search"),
        SourceRule("radio", "radio"),
    ),
    region_from_postcode=True,
    prefixed_regions_only=False,
    country_rank_change_is_tw_minus_lw=True,
)
