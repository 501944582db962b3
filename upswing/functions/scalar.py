"""Column expressions shared by the operators. All are built-in functions, no Python UDFs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from upswing.partners import HOME_MARKET, PREFIXED_MARKETS

# Lengths of the comparison window and of the release-age window.
WINDOW_DAYS = 14
WEEK_DAYS = 7
MAX_RELEASE_MONTHS = 24
MIN_RELEASE_DAYS = 14

# Defaults shown to subscribers.
NO_IMAGE = "No image"
UNPARSABLE_COUNT = "0,000"


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def day_before(day: date | str, days: int = 1) -> date:
    return as_date(day) - timedelta(days=days)


def window_start(day: date | str) -> date:
    """First day of the 14-day window that ends on `day`."""
    return day_before(day, WINDOW_DAYS - 1)


def in_window(part_day: Column, day: date | str) -> Column:
    return part_day.between(F.lit(window_start(day)), F.lit(as_date(day)))


def week_label(part_day: Column, report_day: Column) -> Column:
    """'TW' for the seven days ending on the report day, 'LW' for the seven before, else NULL."""
    age = F.datediff(report_day, part_day)
    return F.when(age.between(0, WEEK_DAYS - 1), "TW").when(
        age.between(WEEK_DAYS, WINDOW_DAYS - 1), "LW"
    )


def one_key(columns: list[str]) -> Column:
    """Grouping columns as one. Beside keys of plain types only, Spark keeps a small table of the first
    65,536 groups, which it asks in vain for each row of the many others."""
    return F.struct(*columns)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, NULL where the denominator is zero or NULL."""
    return F.when(denominator != 0, numerator / denominator)


def signed_asinh(value: Column) -> Column:
    """asinh through the magnitude: the plain form loses digits for large negative input."""
    return F.signum(value) * F.asinh(F.abs(value))


def capped_rank(rank: Column, cap: int) -> Column:
    return F.least(rank, F.lit(cap).cast("long"))


def momentum_guard(score: Column, tw: Column, lw: Column, rank_tw: Column, rank_lw: Column) -> Column:
    """Zero a positive score whose streams fell or whose rank got worse. `rank_lw` must be the raw
    rank, not the one blanked for items without last-week streams."""
    return F.when((score > 0) & ((tw < lw) | (rank_tw > rank_lw)), F.lit(0.0)).otherwise(score)


def field_region_code(dma_number: Column, region_code: Column) -> Column:
    """Region code out of the stream's own fields; NULL as soon as one of them is NULL."""
    return F.concat(dma_number, region_code)


def postcode_region_code(dma_id: Column, iso2: Column) -> Column:
    return F.concat(F.coalesce(dma_id, F.lit("")), F.coalesce(iso2, F.lit("")))


def has_region(region: Column) -> Column:
    return region != ""


def prefixed_region(country: Column, region: Column) -> Column:
    """Region belongs to a listed market and carries its code; home-market codes are numeric."""
    own_prefix = country.isin(*PREFIXED_MARKETS) & (F.substring(region, 1, 2) == country)
    home = (country == HOME_MARKET) & region.rlike("^[0-9]")
    return own_prefix | home


def released_in_window(first_stream_date: Column, day: date | str) -> Column:
    """At most two years old, and out for more than two weeks."""
    today = F.lit(as_date(day))
    return (first_stream_date >= F.add_months(today, -MAX_RELEASE_MONTHS)) & (
        first_stream_date < F.date_sub(today, MIN_RELEASE_DAYS)
    )


def strip_newlines(text: Column) -> Column:
    return F.translate(text, "\n", "")


def image_or_default(image: Column) -> Column:
    return F.coalesce(strip_newlines(image), F.lit(NO_IMAGE))


def grouped_thousands(number: Column) -> Column:
    """Text number with thousands separators, or a fixed text if it is not a 32-bit integer; blanks
    around it count as not one."""
    parsed = F.when(number.rlike("^[+-]?[0-9]+$"), number.try_cast("int"))
    return F.coalesce(F.format_number(parsed, 0), F.lit(UNPARSABLE_COUNT))
