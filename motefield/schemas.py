"""Column contracts of the layers, as DDL strings."""

from __future__ import annotations

from pyspark.sql import types as T

READING_JSON = (
    "reading_id string, device_id string, reading_ts string, temperature double, humidity double, "
    "pressure double, battery_pct double, latitude double, longitude double, co2_level double, "
    "firmware_version string, error_profile string"
)

RAW = "raw_data variant, loaded_at timestamp_ntz, source_file string"

STREAM_RAW = (
    "raw_data variant, loaded_at timestamp_ntz, source_topic string, source_partition bigint, "
    "source_offset bigint, kafka_key string"
)

STAGED = (
    "reading_id string, device_id string, reading_ts timestamp_ntz, temperature double, humidity double, "
    "pressure double, battery_pct double, co2_level double, latitude double, longitude double, "
    "firmware_version string, error_profile string, signal_strength double, temp_celsius_renamed string, "
    "loaded_at timestamp_ntz, source_file string"
)

DEVICE_REGISTRY = (
    "device_id string, device_name string, device_type string, cluster_id string, "
    "base_latitude double, base_longitude double, install_date date"
)

SENSOR_THRESHOLDS = (
    "sensor_type string, min_valid double, max_valid double, warning_low double, warning_high double, "
    "critical_low double, critical_high double"
)

CLUSTER_METADATA = (
    "cluster_id string, cluster_city string, cluster_state string, cluster_timezone string, "
    "environment_type string, manager_name string, max_devices int"
)

# sensor name in the threshold table -> reading column
SENSORS = {
    "temperature": "temperature",
    "humidity": "humidity",
    "pressure": "pressure",
    "battery": "battery_pct",
    "co2": "co2_level",
}

# JSON field -> SQL type, the contract of the producer payload
PAYLOAD_FIELDS = {
    "reading_id": "string", "device_id": "string", "reading_ts": "string",
    "temperature": "double", "humidity": "double", "pressure": "double", "battery_pct": "double",
    "latitude": "double", "longitude": "double", "co2_level": "double",
    "firmware_version": "string", "error_profile": "string",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    """Column names; works without a session."""
    return [field.split()[0] for field in ddl.split(",")]
