"""The same facts as one wide table and as a normalised schema, and one question asked of all models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import distance_km
from ..functions.keys import surrogate_key
from ..functions.numbers import ratio, round_to
from ..functions.rules import (
    CLUSTER_CITY, CLUSTER_TIMEZONE, DEVICE_TYPE_ATTRIBUTES, battery_band, cluster_category, device_status, lookup,
    outside, zscore_band,
)
from ..functions.timing import (
    as_ts, day_name, day_number, is_business_hours, is_weekend, part_of_day, trunc,
)
from .validation import last, threshold_bounds


def obt(enriched: DataFrame, registry: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every enriched reading with device, threshold, calendar, battery and position columns."""
    bounds = threshold_bounds(thresholds)
    low, high = bounds["temperature_min_valid"], bounds["temperature_max_valid"]
    devices = registry.select("device_id", "base_latitude", "base_longitude", "install_date")
    rows = enriched.join(devices, "device_id", "left")
    drift = distance_km(F.col("latitude"), F.col("longitude"), F.col("base_latitude"), F.col("base_longitude"))
    return rows.select(
        "reading_id", "device_id", "reading_ts", "loaded_at", "source_file",
        "temperature", "humidity", "pressure", "battery_pct", "latitude", "longitude",
        "firmware_version", "error_profile", "temperature_zscore",
        zscore_band(F.col("temperature_zscore")).alias("anomaly_severity"),
        "device_name", "device_type", "cluster_id", "base_latitude", "base_longitude", "install_date",
        low.alias("threshold_min"),
        high.alias("threshold_max"),
        F.coalesce(outside(F.col("temperature"), low, high), F.lit(False)).alias("is_out_of_range"),
        "hour_of_day", "day_of_week", "is_weekend", "is_business_hours",
        *[trunc(unit, "reading_ts").alias(name) for unit, name in (
            ("hour", "reading_hour"), ("day", "reading_date"), ("week", "reading_week"), ("month", "reading_month"))],
        battery_band(F.col("battery_pct")).alias("battery_status"),
        round_to(drift, 2).alias("gps_drift_km"),
    )


def dim_cluster(registry: DataFrame) -> DataFrame:
    cluster = F.col("cluster_id")
    rows = registry.select(
        "cluster_id",
        F.col("base_latitude").alias("cluster_latitude"),
        F.col("base_longitude").alias("cluster_longitude"),
    ).distinct()
    return rows.select(
        surrogate_key(rows, "cluster_id").alias("cluster_sk"), "*",
        lookup(cluster, CLUSTER_CITY).alias("cluster_city"),
        lookup(cluster, CLUSTER_TIMEZONE).alias("cluster_timezone"),
        cluster_category(cluster).alias("cluster_category"),
    )


def dim_device_type(registry: DataFrame) -> DataFrame:
    rows = registry.select("device_type").distinct()
    names = ("type_description", "accuracy_tier", "calibration_interval_days", "unit_cost_usd")
    attributes = [
        lookup(F.col("device_type"), {code: row[i] for code, row in DEVICE_TYPE_ATTRIBUTES.items()}).alias(name)
        for i, name in enumerate(names)
    ]
    return rows.select(surrogate_key(rows, "device_type").alias("device_type_sk"), "device_type", *attributes)


def dim_device_normalized(
    registry: DataFrame,
    metadata: DataFrame,
    clusters: DataFrame,
    device_types: DataFrame,
    as_of: Column | dt.datetime,
    default: str = "unknown",
) -> DataFrame:
    rows = (
        registry.join(metadata.select("device_id", "firmware_version", "last_seen_at"), "device_id", "left")
        .join(clusters.select("cluster_id", "cluster_sk"), "cluster_id", "left")
        .join(device_types.select("device_type", "device_type_sk"), "device_type", "left")
    )
    return rows.select(
        surrogate_key(rows, "device_id").alias("device_sk"),
        "device_id", "device_name", "device_type_sk", "cluster_sk", "install_date",
        F.coalesce("firmware_version", F.lit(default)).alias("firmware_version"),
        "last_seen_at",
        device_status(F.col("last_seen_at"), as_ts(as_of)).alias("device_status"),
    )


def dim_time_of(hours: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``hour_ts`` per row."""
    ts = F.col("hour_ts")
    truncated = [trunc(unit, ts).alias(f"date_{unit}") for unit in ("day", "week", "month", "quarter")]
    return hours.select(
        surrogate_key(hours, "hour_ts").alias("time_sk"),
        "hour_ts",
        *truncated,
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day_of_month"),
        F.hour(ts).alias("hour_of_day"),
        day_name(ts).alias("day_name"),
        day_number(ts).alias("day_of_week_num"),
        is_weekend(ts).alias("is_weekend"),
        is_business_hours(ts).alias("is_business_hours"),
        part_of_day(ts).alias("time_of_day_category"),
    )


def dim_time(spark: SparkSession, start: str = "2025-01-01 00:00:00", hours: int = 24 * 365 * 2) -> DataFrame:
    """An hour spine of fixed length."""
    spine = spark.range(hours).select(
        F.timestamp_add("HOUR", F.col("id"), F.lit(start).cast("timestamp")).cast("timestamp_ntz").alias("hour_ts")
    )
    return dim_time_of(spine)


def dim_time_spanning(facts: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """The hour spine from the first to the last fact.

    The two ends are read first; the hours between come from a range that Spark deals over tasks, so that one clock
    in a far year makes more rows, not one large row.
    """
    hours = [F.floor(F.unix_seconds(end(F.col(ts)).cast("timestamp")) / 3600) for end in (F.min, F.max)]
    first, last = facts.agg(*hours).first()
    numbers = facts.sparkSession.range(0 if first is None else first, 0 if first is None else last + 1)
    return dim_time_of(numbers.select(F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("hour_ts")))


def fct_readings_normalized(enriched: DataFrame, devices: DataFrame, times: DataFrame) -> DataFrame:
    """Facts with surrogate keys; unknown devices and hours outside the spine keep a NULL key."""
    hours = times.select("time_sk", F.col("hour_ts").alias("_hour"))
    return (
        enriched.join(devices.select("device_id", "device_sk"), "device_id", "left")
        .join(hours, trunc("hour", "reading_ts") == F.col("_hour"), "left")
        .select("reading_id", "device_sk", "time_sk", "temperature", "humidity", "pressure", "battery_pct",
                "latitude", "longitude", "temperature_zscore", "firmware_version", "error_profile", "reading_ts",
                "loaded_at", "source_file")
    )


def avg_temp_star(hourly: DataFrame, devices: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """One hop. Averages of hourly averages, weighted by their readings so that the models agree."""
    recent = last(hourly, "reading_hour", hours, "hour", as_of)
    recent = recent.select("device_id", "avg_temperature", "reading_count")
    weighted = F.sum(F.col("avg_temperature") * F.col("reading_count"))
    return (
        recent.join(devices.select("device_id", "cluster_id"), "device_id")
        .groupBy("cluster_id")
        .agg(
            ratio(weighted, F.sum("reading_count")).alias("avg_temperature"),
            F.avg("avg_temperature").alias("avg_temp"),
            F.sum("reading_count").alias("reading_count"),
        )
    )


def avg_temp_snowflake(facts: DataFrame, devices: DataFrame, clusters: DataFrame, times: DataFrame, as_of,
                       hours: int = 24) -> DataFrame:
    """Three hops; the time filter sits on the spine."""
    recent_hours = last(times, "hour_ts", hours, "hour", as_of).select("time_sk")
    return (
        facts.select("device_sk", "time_sk", "temperature")
        .join(recent_hours, "time_sk")
        .join(devices.select("device_sk", "cluster_sk"), "device_sk")
        .join(clusters.select("cluster_sk", "cluster_id", "cluster_city"), "cluster_sk")
        .groupBy("cluster_id", "cluster_city")
        .agg(F.avg("temperature").alias("avg_temperature"), F.count(F.lit(1)).alias("reading_count"))
    )


def avg_temp_obt(wide: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """No hop."""
    return (
        last(wide, "reading_ts", hours, "hour", as_of)
        .groupBy("cluster_id")
        .agg(F.avg("temperature").alias("avg_temperature"), F.count(F.lit(1)).alias("reading_count"))
    )


def compare_models(answers: dict[str, DataFrame]) -> DataFrame:
    """The answers side by side, one row per model and cluster."""
    parts = [
        df.select(F.lit(name).alias("model"), "cluster_id", round_to(F.col("avg_temperature"), 2)
                  .alias("avg_temperature"), "reading_count")
        for name, df in answers.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
