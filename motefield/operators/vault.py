"""Hubs, links and satellites. Loads are insert-only: see :func:`enrich.insert_new`."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.numbers import round_to
from ..functions.timing import as_ts, shift
from .dedup import first_per
from .validation import last

RECORD_SOURCE = "sensor_feed"


def _stamp(df: DataFrame, as_of: Column | dt.datetime, source: str) -> DataFrame:
    return df.withColumns({"load_ts": as_ts(as_of), "record_source": F.lit(source)})


def hub(staged: DataFrame, key: str, hash_key: str, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    """Every business key once."""
    keys = staged.filter(F.col(key).isNotNull()).select(key).distinct()
    return _stamp(keys.select(surrogate_key(keys, key).alias(hash_key), key), as_of, source)


def hub_device(staged: DataFrame, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    return hub(staged, "device_id", "hub_device_hk", as_of, source)


def hub_sensor_reading(staged: DataFrame, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    return hub(staged, "reading_id", "hub_reading_hk", as_of, source)


def link_device_reading(staged: DataFrame, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    """Which device produced which reading."""
    pairs = (
        staged.filter(F.col("device_id").isNotNull() & F.col("reading_id").isNotNull())
        .select("device_id", "reading_id", "reading_ts")
        .distinct()
    )
    keyed = pairs.select(
        surrogate_key(pairs, "device_id", "reading_id").alias("link_device_reading_hk"),
        surrogate_key(pairs, "device_id").alias("hub_device_hk"),
        surrogate_key(pairs, "reading_id").alias("hub_reading_hk"),
        "device_id", "reading_id", "reading_ts",
    )
    return _stamp(keyed, as_of, source)


def sat_device_details(staged: DataFrame, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    """First sighting of every attribute combination of a device.

    Only the key columns and the earliest time are kept, so this is a hash aggregate, not a window.
    """
    first = (
        staged.filter(F.col("device_id").isNotNull())
        .groupBy("device_id", "firmware_version", "error_profile")
        .agg(F.min("reading_ts").alias("effective_from"))
    )
    keyed = first.select(
        surrogate_key(first, "device_id", "effective_from").alias("sat_device_details_hk"),
        surrogate_key(first, "device_id").alias("hub_device_hk"),
        "device_id", "firmware_version", "error_profile",
        surrogate_key(first, "firmware_version", "error_profile").alias("hashdiff"),
        "effective_from",
    )
    return _stamp(keyed, as_of, source)


def sat_reading_metrics(staged: DataFrame, as_of, source: str = RECORD_SOURCE) -> DataFrame:
    """The measurements of each reading, first copy by reading time, then load time."""
    metrics = ("temperature", "humidity", "pressure", "battery_pct", "latitude", "longitude")
    named = staged.filter(F.col("reading_id").isNotNull()).select(
        "reading_id", "device_id", "reading_ts", *metrics, "loaded_at", "source_file"
    )
    order = [F.col(c).asc_nulls_last() for c in ("reading_ts", "loaded_at", "source_file")]
    one = first_per(named, ["reading_id"], order)
    hub_key = surrogate_key(one, "reading_id")
    keyed = one.select(
        hub_key.alias("sat_reading_metrics_hk"), hub_key.alias("hub_reading_hk"),
        "reading_id", "device_id", "reading_ts", *metrics,
        surrogate_key(one, *metrics).alias("hashdiff"),
    )
    return _stamp(keyed, as_of, source)


def dv_avg_temp(sat_reading: DataFrame, link: DataFrame, hub_dev: DataFrame, registry: DataFrame, as_of,
                hours: int = 24, day: str | None = None) -> DataFrame:
    """Average temperature per cluster from the vault tables.

    The time filter comes first; small sides are left to Catalyst and AQE. ``day`` names the column by which satellite and link are
    partitioned: both are then read for the days of the span only, and a reading meets its link on its own day.
    """
    keys = ["hub_reading_hk"]
    if day is not None:
        keys.append(day)
        first = F.to_date(shift(as_ts(as_of), "hour", -hours))
        sat_reading, link = (df.filter(F.col(day) >= first) for df in (sat_reading, link))
    recent = last(sat_reading, "reading_ts", hours, "hour", as_of).select(*keys, "temperature")
    return (
        recent.join(link.select(*keys, "hub_device_hk"), keys)
        .join(hub_dev.select("hub_device_hk", "device_id"), "hub_device_hk")
        .join(registry.select("device_id", "cluster_id"), "device_id")
        .groupBy("cluster_id")
        .agg(round_to(F.avg("temperature"), 2).alias("avg_temperature"), F.count(F.lit(1)).alias("reading_count"))
    )
