"""Week pivot, ranks and velocity score.

Ranks and scores depend only on the pair (this week's streams, last week's streams) within a market.
So they are computed on a table with one row per distinct pair and its number of items, never on the
items: a market that holds a third of all items costs no more than its distinct stream counts, of
which there can be about sqrt(2 * streams) at most, and items meet the result in one equi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.functions.exact import exact_mean, exact_parts, exact_sum, exact_total
from upswing.functions.scalar import (
    capped_rank,
    guarded_ratio,
    has_region,
    momentum_guard,
    one_key,
    prefixed_region,
    signed_asinh,
)
from upswing.operators.joins import null_safe_join
from upswing.partners import Partner
from upswing.sources.tables import staged

ITEM_KEYS = [
    "report_date", "isrc", "canopus_id", "resource_rollup_id",
    "track_artist", "track_title", "country_code", "country_name",
]
REGION_KEYS = ["region_dma_code", "dma_name"]


def regional_rows(base: DataFrame, partner: Partner) -> DataFrame:
    """Base rows that take part in the regional ranking."""
    region = F.col("region_dma_code")
    rows = base.filter(has_region(region))
    if partner.prefixed_regions_only:
        rows = rows.filter(prefixed_region(F.col("country_code"), region))
    return rows


def week_pivot(base: DataFrame, counters: list[str], regional: bool = False) -> DataFrame:
    """One row per item and market with `<counter>_tw` and `<counter>_lw`; a week without rows is
    NULL, not zero."""
    dealt_by = ["report_date", "isrc"]
    keys = ITEM_KEYS + (REGION_KEYS if regional else [])
    item = one_key([c for c in keys if c not in dealt_by]).alias("item")
    sums = [
        F.sum(F.when(F.col("week") == week.upper(), F.col(counter))).alias(f"{counter}_{week}")
        for counter in counters
        for week in ("tw", "lw")
    ]
    pivoted = base.groupBy(*dealt_by, item).agg(*sums)
    return pivoted.select("report_date", "isrc", "item.*", *pivoted.columns[3:])


def week_deltas(pivoted: DataFrame, counters: list[str]) -> DataFrame:
    return pivoted.withColumns(
        {f"{c}_change": F.col(f"{c}_tw") - F.col(f"{c}_lw") for c in counters}
    )


def change_shares(deltas: DataFrame, partner: Partner) -> DataFrame:
    """Each source's share of the total change."""
    return deltas.withColumns(
        {
            f"{rule.column}_change_perc": guarded_ratio(
                F.col(f"{rule.column}_change"), F.col("streams_change")
            )
            for rule in partner.sources
        }
    )


def total_shares(pivoted: DataFrame) -> DataFrame:
    """Share of collection and playlist streams in this week's total."""
    total = F.col("streams_tw")
    return pivoted.withColumns(
        {
            "collection_perc": guarded_ratio(F.col("streams_collection_tw"), total),
            "playlist_perc": guarded_ratio(F.col("streams_playlist_tw"), total),
        }
    )


def rank_values(counted: DataFrame, keys: list[str], value: str, rank: str) -> DataFrame:
    """Competition rank of every distinct value, largest first, NULL last.

    `counted` has the keys, the value and `n`, the number of rows that share them. The window runs
    over distinct values only.
    """
    values = counted.groupBy(*keys, value).agg(F.sum("n").alias("n"))
    larger = (
        Window.partitionBy(*keys)
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return values.select(
        *keys, value, (F.coalesce(F.sum("n").over(larger), F.lit(0)) + 1).alias(rank)
    )


def ranked_by(rows: DataFrame, keys: list[str], value: str, rank: str) -> DataFrame:
    """Rows with the rank of `value` within `keys`."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return null_safe_join(rows, rank_values(counted, keys, value, rank), [*keys, value])


def ranked_pairs(rows: DataFrame, keys: list[str], stat_keys: list[str]) -> DataFrame:
    """Distinct (streams_tw, streams_lw) per market with both ranks and their number of items `n`."""
    pair_keys = list(dict.fromkeys([*keys, *stat_keys]))
    pairs = rows.groupBy(*pair_keys, "streams_tw", "streams_lw").agg(F.count(F.lit(1)).alias("n"))
    ranked = pairs
    for week in ("tw", "lw"):
        ranks = rank_values(pairs, keys, f"streams_{week}", f"rank_{week}")
        ranked = null_safe_join(ranked, ranks, [*keys, f"streams_{week}"])
    return ranked


def with_rank_difference(ranked: DataFrame, rank_cap: int) -> DataFrame:
    """How far the item moved between the capped ranks, on a log-like scale that keeps the sign."""
    moved = capped_rank(F.col("rank_lw"), rank_cap) - capped_rank(F.col("rank_tw"), rank_cap)
    return ranked.withColumn("transformed_diff", signed_asinh(moved.cast("double")))


def difference_stats(ranked: DataFrame, stat_keys: list[str]) -> DataFrame:
    """Mean and sample standard deviation of the rank difference over a market's items.

    Two passes over the weighted pairs instead of sums of squares, which lose digits. Sums are exact,
    so they do not depend on the order of a shuffle, and equal differences have their value as mean and
    zero deviation. A single item gives NULL.
    """
    diff, n = F.col("transformed_diff"), F.col("n")
    means = (
        ranked.withColumn("parts", exact_parts(diff, n))
        .groupBy(*stat_keys)
        .agg(F.sum("n").alias("items"), exact_sum("parts").alias("total"))
        .withColumn("mean_transformed_diff", exact_mean(F.col("total"), F.col("items")))
        .drop("total")
    )
    deviation = diff - F.col("mean_transformed_diff")
    spread = (
        null_safe_join(ranked, means, stat_keys)
        .withColumn("parts", exact_parts(deviation * deviation, n))
        .groupBy(*stat_keys, "items", "mean_transformed_diff")
        .agg(exact_sum("parts").alias("squares"))
    )
    variance = exact_total(F.col("squares")) / (F.col("items") - 1)
    return spread.select(
        *stat_keys,
        "mean_transformed_diff",
        F.when(F.col("items") > 1, F.sqrt(variance)).alias("std_transformed_diff"),
    )


def velocity_score() -> Column:
    """z-score of the rank difference, damped for items far down both rankings."""
    divider = F.asinh(F.least("rank_tw", "rank_lw").cast("double"))
    z = guarded_ratio(
        F.col("transformed_diff") - F.col("mean_transformed_diff"), F.col("std_transformed_diff")
    )
    return guarded_ratio(z, divider)


def scored(ranked: DataFrame, stat_keys: list[str], rank_cap: int) -> DataFrame:
    """Ranked pairs with `raw_score`, the score before the momentum guard. `ranked` is read three
    times, so pass a written table."""
    moved = with_rank_difference(ranked, rank_cap)
    stats = difference_stats(moved, stat_keys)
    return null_safe_join(moved, stats, stat_keys).withColumn("raw_score", velocity_score())


def scored_pairs(
    rows: DataFrame, keys: list[str], stat_keys: list[str], rank_cap: int
) -> DataFrame:
    """Pairs of `rows` with ranks and `raw_score`; the ranked pairs are written out in between."""
    return scored(staged(ranked_pairs(rows, keys, stat_keys), "ranked-pairs"), stat_keys, rank_cap)


def guarded_scores(scored: DataFrame, rank_change_is_tw_minus_lw: bool) -> DataFrame:
    """Final score, then rank and rank change blanked for items without last-week streams."""
    tw, lw = F.col("streams_tw"), F.col("streams_lw")
    rank_tw, rank_lw = F.col("rank_tw"), F.col("rank_lw")
    moved = rank_tw - rank_lw if rank_change_is_tw_minus_lw else rank_lw - rank_tw
    return scored.withColumns(
        {
            "rank_adj_score": momentum_guard(F.col("raw_score"), tw, lw, rank_tw, rank_lw),
            "rank_change": F.when(lw.isNotNull(), moved),
            "rank_lw": F.when(lw.isNotNull(), rank_lw),
        }
    )
