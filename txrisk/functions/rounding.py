"""Ratios rounded half-up to two decimals, computed from whole numbers.

Counts and cents are added as BIGINT and divided once, as decimals, at the end. The result does not
depend on the order in which partitions are merged, as a sum of doubles would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` for whole numbers; NULL when the denominator is 0 or NULL."""
    whole = "decimal(20,0)"
    den = F.nullif(den.cast(whole), F.lit(0).cast(whole))
    return F.round(num.cast(whole) / den, scale).cast("double")


def percent(num: Column, den: Column) -> Column:
    return ratio(num * 100, den)


def mean_amount(total_cents: Column, n: Column) -> Column:
    return ratio(total_cents, n * 100)


def amount(total_cents: Column, n: Column | None = None) -> Column:
    """Cents as currency units. With ``n``, NULL when no value went into the sum."""
    units = total_cents / F.lit(100)
    return units if n is None else F.when(n > 0, units)
