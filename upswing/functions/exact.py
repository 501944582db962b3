"""Sums of doubles that do not depend on the order of addition.

A double is cut into three whole numbers of 32 bits each (the first with sign), which decimals add up
exactly. Partial sums merge in any order, so a rebuild gives the same bits however rows were dealt.
Bits below 2^-96 are cut off; magnitudes from 2^30 on fail instead of losing digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMBS = 3
_BASE = 1 << 32
_WHOLE = "decimal(38,0)"


def _limbs(value: Column) -> list[Column]:
    """Whole numbers a, b, c with value = a / 2^32 + b / 2^64 + c / 2^96 and b, c below 2^32; every
    step is exact, as powers of two only move the exponent."""
    out = []
    for _ in range(LIMBS):
        scaled = value * float(_BASE)
        whole = F.floor(scaled)
        out.append(whole)
        value = scaled - whole.cast("double")
    return out


def exact_parts(value: Column, weight: Column | None = None) -> Column:
    """What `exact_sum` adds up: the parts of a double, times a whole number `weight`; NULL for NULL."""
    parts = [limb.cast("decimal(18,0)") for limb in _limbs(value)]
    if weight is not None:
        parts = [part * weight.cast("decimal(19,0)") for part in parts]
    named = [part.cast(_WHOLE).alias(f"p{i}") for i, part in enumerate(parts)]
    return F.when(value.isNotNull(), F.struct(*named))


def exact_sum(parts: str) -> Column:
    """Aggregate of a column made by `exact_parts`."""
    return F.struct(*(F.sum(f"{parts}.p{i}").alias(f"p{i}") for i in range(LIMBS)))


def _value(limbs: list[Column]) -> Column:
    """The double next to the parts, smallest first."""
    total = F.lit(0.0)
    for limb in reversed(limbs):
        total = (total + limb.cast("double")) / float(_BASE)
    return total


def exact_mean(total: Column, count: Column) -> Column:
    """An exact sum divided by a count: a long division by digits of 32 bits, so equal values have that
    value as their mean and a mean is never above the largest value."""
    n = count.cast("decimal(20,0)")
    rest, digits = F.lit(0).cast(_WHOLE), []
    for i in range(LIMBS):
        here = (rest * F.lit(_BASE).cast("decimal(10,0)")).cast(_WHOLE) + total[f"p{i}"]
        rest = F.pmod(here.cast(_WHOLE), n.cast(_WHOLE))
        digits.append(((here.cast(_WHOLE) - rest) / n).cast(_WHOLE))
    return F.when(count > 0, _value(digits))


def exact_total(total: Column) -> Column:
    """An exact sum as a double."""
    return _value([total[f"p{i}"] for i in range(LIMBS)])
