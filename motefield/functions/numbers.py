"""Rounding and ratios with results that do not depend on binary noise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Half-up rounding on the decimal form (1.005 -> 1.01), returned as a double; NULL beyond 18 digits."""
    return F.round(value.try_cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` with NULL for a zero divisor."""
    return part / F.nullif(whole.cast("double"), F.lit(0.0))


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; NULL conditions do not count."""
    return F.count(F.when(condition, 1))


def floor_at(value: Column, low: float) -> Column:
    """``greatest`` that keeps NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), value))
