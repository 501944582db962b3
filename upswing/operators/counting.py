"""Counting streams per source, week and market."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upswing.functions.scalar import (
    WEEK_DAYS,
    WINDOW_DAYS,
    as_date,
    field_region_code,
    one_key,
    week_label,
)
from upswing.partners import (
    EX_HOME_CODE,
    EX_HOME_NAME,
    GLOBAL_CODE,
    GLOBAL_NAME,
    HOME_MARKET,
    Partner,
    SourceRule,
)
from upswing.sources.tables import spread, stream_window

MARKET_KEYS = ["country_code", "country_name", "region_dma_code", "dma_name"]


def _source_test(rule: SourceRule) -> Column:
    test = F.col("stream_source") == rule.stream_source
    if rule.uri_empty is None:
        return test
    return test & ((F.col("source_uri") == "") if rule.uri_empty else (F.col("source_uri") != ""))


def source_counters(partner: Partner) -> list[Column]:
    """`streams` and one counter per source, as aggregates over raw streams."""
    by_source = [
        F.count(F.when(_source_test(rule), 1)).alias(rule.column) for rule in partner.sources
    ]
    return [F.count(F.lit(1)).alias("streams"), *by_source]


def market_columns(streams: DataFrame, partner: Partner) -> tuple[DataFrame, list[str]]:
    """Streams with market columns under their output names, and the keys to count by. Postcodes
    stay in the key where the region is looked up after the counting."""
    renamed = streams.withColumnsRenamed(
        {"user_country_code": "country_code", "user_country_name": "country_name"}
    )
    if partner.region_from_postcode:
        return renamed, ["country_code", "country_name", "user_postal_code"]
    located = renamed.withColumn(
        "region_dma_code", field_region_code(F.col("user_dma_number"), F.col("user_region_code"))
    ).withColumnRenamed("user_dma_name", "dma_name")
    return located, MARKET_KEYS


def count_window(streams: DataFrame, partner: Partner, day: date | str) -> DataFrame:
    """Counts per market, item and week for one report day: one scan, one shuffle on the full key,
    with partial counts before it, so neither a large market nor a hit fills one task."""
    located, keys = market_columns(stream_window(streams, day), partner)
    report_day = F.lit(as_date(day))
    labelled = located.withColumn("report_date", report_day).withColumn(
        "week", week_label(F.col("part_day"), report_day)
    )
    return labelled.groupBy("report_date", *keys, "isrc", "week").agg(*source_counters(partner))


def dealt_by_track(
    counted: DataFrame, rows: int, partner: Partner, per: tuple[str, ...] = ("report_date", "week")
) -> DataFrame:
    """Counts out of `count_window` or, `per` day, `count_days`, at most `rows` of them, in tasks of bounded
    size by track. They move with their market as one list: else steps that need different columns of it
    would have Spark finish the counting and deal anew for each of them."""
    own = ["isrc", *per]
    market = [c for c in counted.columns if c not in (*own, *partner.counters)]
    packed = counted.select(*own, F.array(*market).alias("market"), *partner.counters)
    return spread(packed, rows, "isrc").select(
        *own, *(F.get("market", F.lit(i)).alias(c) for i, c in enumerate(market)), *partner.counters
    )


def needed_days(days: list[date]) -> list[date]:
    """Stream days that some report day looks at."""
    return sorted({day - timedelta(back) for day in days for back in range(WINDOW_DAYS)})


def count_days(streams: DataFrame, partner: Partner, days: list[date]) -> DataFrame:
    """Counts per stream day, market and item, of the stream days that the report days look at. The
    day filter is literal, so partitions are pruned."""
    located, keys = market_columns(
        streams.filter(F.col("part_day").isin(needed_days(days))), partner
    )
    return located.groupBy("part_day", *keys, "isrc").agg(*source_counters(partner))


def first_report_day(day: Column, days: list[date]) -> Column:
    """The first of the sorted report days that is not before `day`, which is not after the last: `day`
    itself where they follow each other."""
    seen = F.greatest(day, F.lit(days[0]))
    for before, after in zip(days, days[1:]):
        if (after - before).days > 1:
            between = seen.between(F.lit(before + timedelta(1)), F.lit(after))
            seen = F.when(between, F.lit(after)).otherwise(seen)
    return seen


def sliding_weeks(
    daily: DataFrame, counters: list[str], days: list[date], dealt_by: list[str] | None = None
) -> DataFrame:
    """Sums of both weeks per key as they change from day to day: `since` and `until` (not included)
    with the counters of each week as `tw` and `lw`. Keys are all columns but the day and the counters.

    A day's counts enter this week on that day, pass to last week seven days later and leave seven days
    after that. These three changes, whatever the window's length, are added up per key and day, and
    their running sum holds until the key changes again. Only the report days `days` are looked at: a
    change is seen on the first of them that is not before it, so those between two of them fall together,
    and one after the last is not made. Daily counts move once, to where their key is, unless they are
    dealt by some of the keys (`dealt_by`) already; a key has one row per report day at most. Spans in
    which both weeks are empty are left out.
    """
    days = sorted(set(days))
    keys = [c for c in daily.columns if c not in ("part_day", *counters)]

    def change(after: int, this_week: int, last_week: int) -> Column:
        moved = [
            (F.col(c) * sign).alias(f"{c}_{week}")
            for week, sign in (("tw", this_week), ("lw", last_week))
            for c in counters
        ]
        return F.struct(F.date_add("part_day", after).alias("since"), *moved)

    changes = F.array(change(0, 1, 0), change(WEEK_DAYS, -1, 1), change(WINDOW_DAYS, 0, -1))
    names = [f"{c}_{week}" for week in ("tw", "lw") for c in counters]
    # Sorted by what they are dealt by first, rows are ready for a join on it, and alike ones stay together.
    by_key = Window.partitionBy(*dict.fromkeys([*(dealt_by or []), *keys])).orderBy("since")
    running = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    moved = daily if dealt_by else daily.repartition(*keys)
    summed = (
        moved.select(*keys, F.inline(F.filter(changes, lambda c: c["since"] <= F.lit(days[-1]))))
        .withColumn("since", first_report_day(F.col("since"), days))
        .groupBy(*keys, "since")
        .agg(*(F.sum(name).alias(name) for name in names))
        .select(
            *keys, "since",
            F.lead("since", 1, days[-1] + timedelta(1)).over(by_key).alias("until"),
            *(F.sum(name).over(running).alias(name) for name in names),
        )
    )

    def week(suffix: str) -> Column:
        return F.struct(*(F.col(f"{c}_{suffix}").alias(c) for c in counters)).alias(suffix)

    filled = summed.filter((F.col("streams_tw") > 0) | (F.col("streams_lw") > 0))
    return filled.select(*keys, "since", "until", week("tw"), week("lw"))


def seen_weeks(daily: DataFrame, counters: list[str], days: list[date]) -> DataFrame:
    """Sums of both weeks of every report day, side by side in one row per key, as `tw0`, `lw0`, `tw1` and
    so on. Keys are `isrc` and all other columns but the day and the counters. For few report days this
    hashes a count once, where `sliding_weeks` adds up three changes of it and sorts them."""
    market = [c for c in daily.columns if c not in ("part_day", "isrc", *counters)]
    labels = {f"week{i}": week_label(F.col("part_day"), F.lit(day)) for i, day in enumerate(days)}
    weeks = [(f"{w}{i}", F.col(f"week{i}") == w.upper()) for i in range(len(days)) for w in ("tw", "lw")]
    sums = daily.withColumns(labels).groupBy("isrc", one_key(market).alias("market")).agg(
        *(F.sum(F.when(seen, F.col(c))).alias(f"{c}_{week}") for week, seen in weeks for c in counters)
    )
    return sums.select(
        "isrc", "market.*",
        *(F.struct(*(F.col(f"{c}_{week}").alias(c) for c in counters)).alias(week) for week, _ in weeks),
    )


def on_seen_days(weeks: DataFrame, days: list[date]) -> DataFrame:
    """`report_date`, `week` and the counters out of `seen_weeks`: a row per week that has streams."""
    made = [
        F.struct(F.lit(day).alias("report_date"), F.lit(w.upper()).alias("week"), F.col(f"{w}{i}.*"))
        for i, day in enumerate(days)
        for w in ("tw", "lw")
    ]
    seen = {f"{w}{i}" for i in range(len(days)) for w in ("tw", "lw")}
    rest = [c for c in weeks.columns if c not in seen]
    return weeks.select(*rest, F.inline(F.array(*made))).filter(F.col("streams") > 0)


def on_report_days(weeks: DataFrame, days: list[date]) -> DataFrame:
    """`report_date`, `week` and the counters out of `sliding_weeks`, for the given days: each row made
    here is a row of the result, but for days between two listed ones that a span runs over."""
    both = F.array(
        *(F.struct(F.lit(w.upper()).alias("week"), F.col(f"{w}.*")) for w in ("tw", "lw"))
    )
    seen = F.sequence(F.col("since"), F.date_sub("until", 1))
    rest = [c for c in weeks.columns if c not in ("since", "until", "tw", "lw")]
    dated = weeks.select(*rest, "tw", "lw", F.explode(seen).alias("report_date"))
    return (
        dated.filter(F.col("report_date").isin(days))
        .select("report_date", *rest, F.inline(both))
        .filter(F.col("streams") > 0)
    )


def count_windows(streams: DataFrame, partner: Partner, days: list[date]) -> DataFrame:
    """`count_window` for many report days at once."""
    daily = count_days(streams, partner, days)
    return on_report_days(sliding_weeks(daily, partner.counters, days), days)


def abroad(country: Column) -> Column:
    """Outside the home market; NULL, so not taken, without a country."""
    return country != HOME_MARKET


def global_rollups(
    counted: DataFrame, partner: Partner, per: tuple[str, ...] = ("report_date", "week")
) -> DataFrame:
    """The two synthetic markets out of the per-market counts: everything, and everything outside
    the home market. Streams without a country count only for the first."""
    outside = abroad(F.col("country_code"))
    sums = counted.groupBy("isrc", *per).agg(
        *(F.sum(c).alias(c) for c in partner.counters),
        *(F.sum(F.when(outside, F.col(c))).alias(f"abroad_{c}") for c in partner.counters),
    )

    def market(code: str, name: str, prefix: str) -> Column:
        return F.struct(
            F.lit(code).alias("country_code"),
            F.lit(name).alias("country_name"),
            F.lit("").alias("region_dma_code"),
            F.lit("").alias("dma_name"),
            *(F.col(f"{prefix}{c}").alias(c) for c in partner.counters),
        )

    markets = F.array(
        market(GLOBAL_CODE, GLOBAL_NAME, ""), market(EX_HOME_CODE, EX_HOME_NAME, "abroad_")
    )
    return (
        sums.select("isrc", *per, F.inline(markets))
        .filter(F.col("streams").isNotNull())
    )
