"""Mergeable moments: what is kept of a group so that more rows, or other groups, can be added later.

Per measure the state holds the number of values, their mean, the sum of squared deviations from it, the least and the largest. Parts are
merged by Chan's formula: the deviations of the parts plus those of their means, which loses no digits where sums of squares would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.timing import trunc

MEASURES = ("temperature", "humidity", "pressure", "co2_level", "battery_pct")
HOUR_KEYS = ("device_id", "reading_hour", "cluster_id", "device_type")


def moments(df: DataFrame, keys: Sequence[str | Column], measures: Sequence[str] = MEASURES, counts: dict[str, Column] | None = None) -> DataFrame:
    """The state of each group: ``keys``, ``<m>_n, <m>_mean, <m>_m2, <m>_min, <m>_max`` per measure, and sums of ``counts``.

    All of it combines on the map side. NULL measures are left out; a group without values has a NULL mean and no deviations.
    """
    parts = []
    for m in measures:
        n = F.count(m)
        parts += [n.alias(f"{m}_n"), F.avg(m).alias(f"{m}_mean"), F.coalesce(F.var_pop(m) * n, F.lit(0.0)).alias(f"{m}_m2"),
                  F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    sums = [F.sum(c.cast("long")).alias(name) for name, c in (counts or {}).items()]
    return df.groupBy(*keys).agg(*parts, *sums)


def merged(parts: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES, counts: Sequence[str] = ()) -> DataFrame:
    """One state per group from any number of states, in one shuffle. Parts that are empty change nothing."""
    whole = Window.partitionBy(*keys)
    joint = parts.withColumns({
        f"_{m}": F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")).over(whole) / F.nullif(F.sum(f"{m}_n").over(whole), F.lit(0)) for m in measures})
    out = []
    for m in measures:
        n, between = F.col(f"{m}_n"), F.col(f"{m}_mean") - F.col(f"_{m}")
        out += [F.sum(n).alias(f"{m}_n"), F.max(f"_{m}").alias(f"{m}_mean"),
                F.sum(F.col(f"{m}_m2") + F.coalesce(n * between * between, F.lit(0.0))).alias(f"{m}_m2"),
                F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    return joint.groupBy(*keys).agg(*out, *[F.sum(c).alias(c) for c in counts])


def stddev_samp(measure: str) -> Column:
    """The sample standard deviation behind a state; NULL below two values, as the aggregate has it."""
    n = F.col(f"{measure}_n")
    return F.when(n > 1, F.sqrt(F.col(f"{measure}_m2") / (n - 1)))


HOUR_COUNTS = ("reading_count", "anomaly_count")


def hourly_moments(enriched: DataFrame) -> DataFrame:
    """The state per device and hour."""
    dated = enriched.withColumn("reading_hour", trunc("hour", "reading_ts"))
    wide = F.coalesce(F.abs(F.col("temperature_zscore")) > 3, F.lit(False))
    return moments(dated, HOUR_KEYS, counts={"reading_count": F.lit(1), "anomaly_count": wide})


def merge_hours(parts: DataFrame) -> DataFrame:
    return merged(parts, HOUR_KEYS, counts=HOUR_COUNTS)


def hourly_facts(state: DataFrame) -> DataFrame:
    """The hourly facts behind a merged state, with the columns of :func:`marts.hourly_readings`."""
    shown = {
        "avg_temperature": "temperature_mean", "min_temperature": "temperature_min", "max_temperature": "temperature_max",
        "stddev_temperature": stddev_samp("temperature"), "avg_humidity": "humidity_mean", "min_humidity": "humidity_min",
        "max_humidity": "humidity_max", "avg_pressure": "pressure_mean", "avg_co2_level": "co2_level_mean", "min_co2_level": "co2_level_min",
        "max_co2_level": "co2_level_max", "avg_battery_pct": "battery_pct_mean", "min_battery_pct": "battery_pct_min",
        "reading_count": "reading_count", "anomaly_count": "anomaly_count",
    }
    return state.select(
        surrogate_key(state, "device_id", "reading_hour").alias("hourly_reading_id"), "device_id", "reading_hour",
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in shown.items()], "cluster_id", "device_type")


def rollup(state: DataFrame, keys: Sequence[str | Column], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Statistics at a coarser grain from states at a finer one: mean, spread, bounds and rows of each group of ``keys``."""
    named = [k if isinstance(k, Column) else F.col(k) for k in keys]
    kept = state.select(*named, *[f"{m}_{part}" for m in measures for part in ("n", "mean", "m2", "min", "max")], *HOUR_COUNTS)
    names = kept.columns[:len(named)]
    whole = merged(kept, names, measures, HOUR_COUNTS)
    shown = [c for m in measures for c in (
        F.col(f"{m}_mean").alias(f"avg_{m}"), stddev_samp(m).alias(f"stddev_{m}"), F.col(f"{m}_min").alias(f"min_{m}"), F.col(f"{m}_max").alias(f"max_{m}"))]
    return whole.select(*names, *shown, *HOUR_COUNTS)
