"""Range checks, error counts, quarantine, late arrivals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import classify
from ..functions.timing import as_ts, boundary_diff, shift
from ..schemas import SENSORS
from .ordered import flag_anomaly, rolling_zscore

_LIMITS = ("min_valid", "max_valid", "warning_low", "warning_high", "critical_low", "critical_high")
FLAGS = {sensor: f"is_{sensor}_valid" for sensor in SENSORS}
# fixed values: rejection reasons, in their order inside the array
REASONS = {
    "is_temperature_valid": "TEMPERATURE_OUT_OF_RANGE",
    "is_humidity_valid": "HUMIDITY_OUT_OF_RANGE",
    "is_pressure_valid": "PRESSURE_OUT_OF_RANGE",
    "is_battery_valid": "BATTERY_OUT_OF_RANGE",
    "is_co2_valid": "CO2_OUT_OF_RANGE",
}
ANOMALY_REASON = "ZSCORE_ANOMALY"


def threshold_bounds(thresholds: DataFrame) -> Column:
    """All limits as one struct ``<sensor>_<limit>``, read once per query as a scalar subquery.

    A sensor without a threshold row has NULL limits.
    """
    cells = [
        F.max(F.when(F.col("sensor_type") == sensor, F.col(limit))).alias(f"{sensor}_{limit}")
        for sensor in SENSORS
        for limit in _LIMITS
    ]
    return thresholds.agg(*cells).select(F.struct("*")).scalar()


def attach_threshold(df: DataFrame, thresholds: DataFrame, sensor: str, low: str, high: str) -> DataFrame:
    """The valid range of one sensor on every row."""
    bounds = threshold_bounds(thresholds)
    return df.withColumns({low: bounds[f"{sensor}_min_valid"], high: bounds[f"{sensor}_max_valid"]})


def flag_ranges(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One boolean per sensor. A missing value is invalid, except co2: no sensor is not an error."""
    bounds = threshold_bounds(thresholds)
    flags = {}
    for sensor, column in SENSORS.items():
        inside = F.col(column).between(bounds[f"{sensor}_min_valid"], bounds[f"{sensor}_max_valid"])
        missing = F.col(column).isNull()
        known = F.coalesce(inside, F.lit(False))
        flags[FLAGS[sensor]] = (missing | known) if sensor == "co2" else (~missing & known)
    return df.withColumns(flags)


def error_count() -> Column:
    failed = [(~F.col(flag)).cast("int") for flag in FLAGS.values()]
    total = F.col("is_anomaly").cast("int")
    for one in failed:
        total = total + one
    return total


def validate(deduped: DataFrame, thresholds: DataFrame, **split) -> DataFrame:
    """Range flags, rolling z-score, anomaly flag and the number of failed checks."""
    scored = rolling_zscore(deduped, **split)
    flagged = flag_ranges(scored, thresholds).withColumn("is_anomaly", flag_anomaly())
    ordered = [*deduped.columns, *FLAGS.values(), "temperature_zscore", "is_anomaly"]
    return flagged.select(*ordered, error_count().alias("validation_error_count"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        validated.filter(F.col("validation_error_count") == 0),
        validated.filter(F.col("validation_error_count") > 0),
    )


def rejection_reasons() -> Column:
    named = [F.when(~F.col(flag), F.lit(text)) for flag, text in REASONS.items()]
    return F.array_compact(F.array(*named, F.when(F.col("is_anomaly"), F.lit(ANOMALY_REASON))))


def quarantine(validated: DataFrame, as_of: Column | dt.datetime) -> DataFrame:
    """Rows with at least one failed check and why they failed."""
    _, bad = split_valid(validated)
    return bad.select(
        "reading_id", "device_id", "reading_ts", "temperature", "humidity", "pressure", "battery_pct", "co2_level",
        "latitude", "longitude", "firmware_version", "error_profile", "loaded_at", "source_file",
        rejection_reasons().alias("rejection_reasons"),
        "validation_error_count",
        as_ts(as_of).alias("quarantined_at"),
    )


def late_arrivals(deduped: DataFrame, minutes: int = 60) -> DataFrame:
    """Readings loaded more than ``minutes`` minute boundaries after they were taken."""
    delay = boundary_diff("minute", "reading_ts", "loaded_at")
    return (
        deduped.filter(F.col("reading_ts").isNotNull())
        .withColumn("arrival_delay_minutes", delay)
        .filter(F.col("arrival_delay_minutes") > minutes)
        .select("reading_id", "device_id", "reading_ts", "loaded_at", "arrival_delay_minutes", "temperature",
                "humidity", "pressure", "battery_pct", "firmware_version", "error_profile", "source_file")
    )


def future_rows(df: DataFrame, as_of: Column | dt.datetime, days: int = 1) -> DataFrame:
    now = as_ts(as_of)
    return df.filter(F.col("reading_ts") > shift(now, "day", days)).select(
        "reading_id", "device_id", "reading_ts", now.alias("check_time")
    )


def last(df: DataFrame, ts: str, n: int, unit: str, as_of: Column | dt.datetime) -> DataFrame:
    """Rows of the last ``n`` units up to ``as_of``."""
    return df.filter(F.col(ts) >= shift(as_ts(as_of), unit, -n))


def latest_day(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def newer_than(source: DataFrame, target: DataFrame, source_col: str, target_col: str) -> DataFrame:
    """Rows above the target's high-water mark; an empty target lets everything through."""
    mark = target.agg(F.max(target_col)).scalar()
    return source.filter(mark.isNull() | (F.col(source_col) > mark))


def with_severity(df: DataFrame, thresholds: DataFrame, sensor: str, name: str = "severity") -> DataFrame:
    return df.withColumn(name, classify(F.col(SENSORS[sensor]), threshold_bounds(thresholds), sensor))
