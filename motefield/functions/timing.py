"""Calendar helpers on TIMESTAMP_NTZ columns (the session runs in UTC)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_ts(value: Column | dt.datetime | str) -> Column:
    """An ``as_of`` argument as a TIMESTAMP_NTZ column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc(unit: str, ts: Column | str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def boundary_diff(unit: str, start: Column | str, end: Column | str) -> Column:
    """Number of ``unit`` boundaries between two times (not the number of whole elapsed units)."""
    return F.timestamp_diff(unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end))


def shift(ts: Column, unit: str, amount: int) -> Column:
    return F.timestamp_add(unit.upper(), F.lit(amount), ts).cast("timestamp_ntz")


def day_name(ts: Column | str) -> Column:
    return F.dayname(ts)


def day_number(ts: Column | str) -> Column:
    """0 = Sunday."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def is_business_hours(ts: Column | str) -> Column:
    return F.hour(ts).between(8, 17)


def part_of_day(ts: Column | str) -> Column:
    hour = F.hour(ts)
    return (
        F.when(hour.between(6, 9), "morning")
        .when(hour.between(10, 13), "midday")
        .when(hour.between(14, 17), "afternoon")
        .when(hour.between(18, 21), "evening")
        .otherwise("night")
    )
