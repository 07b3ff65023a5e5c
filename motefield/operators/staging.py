"""Raw payload to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import json_field, strict_field, try_double, try_ts
from ..schemas import STAGED, columns
from .dedup import first_per

_TEXT = ("reading_id", "device_id", "firmware_version", "error_profile")
_NUMBERS = ("temperature", "humidity", "pressure", "battery_pct", "co2_level", "latitude", "longitude",
            "signal_strength")


def stage_readings(raw: DataFrame, payload: str = "raw_data") -> DataFrame:
    """The 16 staging columns; any payload shape is accepted, what does not fit is NULL."""
    parsed = {name: json_field(payload, name) for name in _TEXT}
    parsed |= {name: try_double(json_field(payload, name)) for name in _NUMBERS}
    parsed["reading_ts"] = try_ts(json_field(payload, "reading_ts"))
    parsed["temp_celsius_renamed"] = json_field(payload, "temp_celsius")
    return raw.select(
        *[parsed[c].alias(c) if c in parsed else F.col(c) for c in columns(STAGED)]
    )


def project_raw(raw: DataFrame, payload: str = "raw_data") -> DataFrame:
    """Typed ad-hoc read without tolerance: a value of the wrong type is an error."""
    text = ("reading_id", "device_id", "firmware_version")
    numbers = ("temperature", "humidity", "pressure", "battery_pct", "latitude", "longitude")
    return raw.select(
        *[strict_field(payload, n, "string").alias(n) for n in text],
        strict_field(payload, "reading_ts", "string").cast("timestamp").cast("timestamp_ntz").alias("reading_ts"),
        *[strict_field(payload, n, "double").alias(n) for n in numbers],
        "source_file",
        "loaded_at",
    )


def stage_device_metadata(staged: DataFrame) -> DataFrame:
    """Firmware of the latest load per device; on equal load times the higher version wins.

    Readings are first reduced per (device, firmware), which is a hash aggregate with map-side combine,
    so only that small result is ranked.
    """
    seen = (
        staged.filter(F.col("device_id").isNotNull())
        .groupBy("device_id", "firmware_version")
        .agg(F.max("loaded_at").alias("last_seen_at"))
    )
    order = [F.col("last_seen_at").desc_nulls_last(), F.col("firmware_version").desc_nulls_last()]
    return first_per(seen, ["device_id"], order)
