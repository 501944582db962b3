"""Base table and trending tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upswing.operators.counting import (
    count_days,
    count_window,
    dealt_by_track,
    global_rollups,
    on_report_days,
    on_seen_days,
    seen_weeks,
    sliding_weeks,
)
from upswing.operators.enrichment import with_known_metadata, with_postcode_region
from upswing.operators.joins import null_safe_join
from upswing.operators.trends import (
    change_shares,
    guarded_scores,
    ranked_pairs,
    regional_rows,
    scored,
    total_shares,
    week_deltas,
    week_pivot,
)
from upswing.partners import Partner
from upswing.schemas import base_schema, conform, trend_schema
from upswing.sources.tables import sent_if_small, spread, staged, stream_window

# Defaults of the trending tables.
RANK_CAP = 5000
TOP_N = 2000
# A count is seen by so many report days at most, where sliding sums make three changes of it.
DAYS_AT_ONCE = 3


def market_rows(
    counted: DataFrame,
    partner: Partner,
    subdivisions: DataFrame | None = None,
    zips: DataFrame | None = None,
) -> DataFrame:
    """Counts per country and region, and for the two synthetic markets."""
    if partner.region_from_postcode:
        local = with_postcode_region(counted, subdivisions, zips)
    else:
        local = counted
    return local.unionByName(global_rollups(counted, partner))


def market_weeks(
    streams: DataFrame,
    partner: Partner,
    days: list[date],
    subdivisions: DataFrame | None = None,
    zips: DataFrame | None = None,
) -> DataFrame:
    """Sums of both weeks per country and region, and for the two synthetic markets, which add up daily
    counts first: of up to `DAYS_AT_ONCE` report days side by side, of more as sums that slide. Daily
    counts are written, so that they can be dealt by track into tasks of bounded size: a track has a row
    per market and day at most, and its sums, its synthetic markets and its metadata meet where it is."""
    daily = staged(count_days(streams, partner, days), "daily-counts")
    by_track = dealt_by_track(daily, DAYS_AT_ONCE * daily.count(), partner, per=("part_day",))
    rollups = global_rollups(by_track, partner, per=("part_day",))

    def weeks(counted: DataFrame) -> DataFrame:
        if len(days) <= DAYS_AT_ONCE:
            return seen_weeks(counted, partner.counters, days)
        return sliding_weeks(counted, partner.counters, days, ["isrc"])

    local = weeks(by_track)
    if partner.region_from_postcode:
        local = with_postcode_region(local, subdivisions, zips)
    return local.unionByName(weeks(rollups))


def velocity_base(
    streams: DataFrame,
    resources: DataFrame,
    names: DataFrame,
    partner: Partner,
    day: date | str | None = None,
    days: list[date] | None = None,
    subdivisions: DataFrame | None = None,
    zips: DataFrame | None = None,
) -> DataFrame:
    """Streams per item, market and week for one report day, or for several in one job.

    The raw table is scanned and counted once; the synthetic markets add up those counts, and
    metadata is joined to counts, never to raw streams. For one day counts move once, to where their
    track is, and synthetic markets and metadata meet them there; there are at most as many as streams.
    For several days metadata is joined to sums that slide from day to day, and rows per report day are
    made last, as rows of the result.
    """
    if (day is None) == (days is None):
        raise ValueError("give either day or days")
    streams = streams.filter(F.col("isrc").isNotNull())  # without metadata, and all in one task
    if day is not None:
        counted = count_window(streams, partner, day)
        by_track = dealt_by_track(counted, stream_window(streams, day).count(), partner)
        rows = market_rows(by_track, partner, subdivisions, zips)
        known = with_known_metadata(rows, resources, names, dealt=True)
    else:
        days = sorted(set(days))
        few = len(days) <= DAYS_AT_ONCE
        weeks = market_weeks(streams, partner, days, subdivisions, zips)
        known = with_known_metadata(weeks, resources, names)
        # Sorted by a hash of the track, alike rows stay together in what is written.
        together = known.sortWithinPartitions(F.xxhash64("isrc")) if few else known
        known = (on_seen_days if few else on_report_days)(together, days)
    return conform(known, base_schema(partner))


def above_cut(rows: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with at least the streams that the lowest top rank of their market has.

    Ranks fall with this week's streams, NULL last, so no row of a top rank is lost. The cut has one
    row per market and day; unless they are many they go to the rows, which then need no shuffle.
    """
    cut = top.groupBy(*keys).agg(
        F.min("streams_tw").alias("cut_tw"),
        F.max(F.col("streams_tw").isNull()).alias("cut_takes_null"),
    )
    kept = null_safe_join(rows, sent_if_small(cut), keys).filter(
        (F.col("streams_tw") >= F.col("cut_tw"))
        | (F.col("streams_tw").isNull() & F.col("cut_takes_null"))
    )
    return kept.drop("cut_tw", "cut_takes_null")


def trending(
    base: DataFrame,
    partner: Partner,
    regional: bool = False,
    rank_cap: int = RANK_CAP,
    top_n: int = TOP_N,
) -> DataFrame:
    """Top items per market with velocity score, by country or by region/DMA.

    Mean and deviation cover all items of a market; the cut to the top ranks comes after. Items below
    their market's cut are dropped before the wide rows are shuffled a second time. Items are pivoted
    once, in tasks of bounded size, and written: pairs, cut and candidates read them from there. `base`
    is read twice (once for its number of rows), so pass a written table.
    """
    if regional:
        base = regional_rows(base, partner)
        keys = ["report_date", "country_code", "region_dma_code"]
        stat_keys = keys
    else:
        keys = ["report_date", "country_code"]
        stat_keys = ["report_date", "country_name"]
    items_by_key = spread(base, base.count(), "report_date", "isrc")
    rows = staged(week_pivot(items_by_key, partner.counters, regional), "pivot")
    ranked = staged(ranked_pairs(rows, keys, stat_keys), "ranked-pairs")
    best = guarded_scores(
        scored(ranked, stat_keys, rank_cap).filter(F.col("rank_tw") <= top_n),
        partner.country_rank_change_is_tw_minus_lw and not regional,
    ).drop("n", "transformed_diff", "mean_transformed_diff", "std_transformed_diff", "raw_score")
    # Written, its size is known before items are read: they move only if it is too large to be sent.
    top = staged(best, "top-pairs")
    pair_keys = list(dict.fromkeys([*keys, *stat_keys]))
    candidates = above_cut(rows, ranked.filter(F.col("rank_tw") <= top_n), keys)
    items = null_safe_join(candidates, top, [*pair_keys, "streams_tw", "streams_lw"])
    full = total_shares(change_shares(week_deltas(items, partner.counters), partner))
    return conform(full, trend_schema(partner, regional))
