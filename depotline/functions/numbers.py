"""Money and scores. Amounts stay decimals, so sums are exact in any order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def money(value: Column) -> Column:
    """A two-place amount as a decimal."""
    return value.cast(MONEY)


def line_total(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Quantity times price less discount, to two places."""
    return F.round(quantity.cast("decimal(10,0)") * unit_price - discount, 2)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient, NULL where the whole is zero."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))
