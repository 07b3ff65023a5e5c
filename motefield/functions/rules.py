"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timing import boundary_diff


def outside(value: Column, low: Column, high: Column) -> Column:
    return (value < low) | (value > high)


def classify(value: Column, bounds: Column, sensor: str) -> Column:
    """critical / warning / normal against one sensor's limits."""
    return (
        F.when(outside(value, bounds[f"{sensor}_critical_low"], bounds[f"{sensor}_critical_high"]), "critical")
        .when(outside(value, bounds[f"{sensor}_warning_low"], bounds[f"{sensor}_warning_high"]), "warning")
        .otherwise("normal")
    )


def device_status(last_seen: Column, as_of: Column) -> Column:
    silent_hours = boundary_diff("hour", last_seen, as_of)
    return (
        F.when(last_seen.isNull(), "never_seen")
        .when(silent_hours > 24, "offline")
        .when(silent_hours > 6, "inactive")
        .otherwise("active")
    )


def health_status(uptime_pct: Column, min_battery: Column, anomaly_alerts: Column) -> Column:
    return (
        F.when((uptime_pct < 50) | (min_battery < 5), "critical")
        .when((uptime_pct < 80) | (min_battery < 15) | (anomaly_alerts > 5), "warning")
        .otherwise("healthy")
    )


def battery_band(battery_pct: Column) -> Column:
    return (
        F.when(battery_pct < 10, "critical")
        .when(battery_pct < 20, "low")
        .when(battery_pct < 50, "medium")
        .otherwise("good")
    )


def zscore_band(zscore: Column) -> Column:
    size = F.abs(zscore)
    return F.when(size > 3, "critical").when(size > 2, "warning").otherwise("normal")


# fixed values: cluster and device-type attributes of the normalised dimensions
CLUSTER_CITY = {
    "FACTORY_A": "New York", "FACTORY_B": "Los Angeles", "WAREHOUSE_A": "Chicago",
    "WAREHOUSE_B": "Houston", "OUTDOOR": "Seattle",
}
CLUSTER_TIMEZONE = {
    "FACTORY_A": "America/New_York", "FACTORY_B": "America/Los_Angeles", "WAREHOUSE_A": "America/Chicago",
    "WAREHOUSE_B": "America/Chicago", "OUTDOOR": "America/Los_Angeles",
}
DEVICE_TYPE_ATTRIBUTES = {
    "Type_A": ("Industrial Grade", "high", 90, 500),
    "Type_B": ("Standard", "medium", 180, 250),
    "Type_C": ("Economy", "low", 365, 100),
}


def lookup(code: Column, names: dict) -> Column:
    """Code to value through a literal map; unknown codes give NULL."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), code)


def cluster_category(cluster_id: Column) -> Column:
    return (
        F.when(cluster_id.like("FACTORY%"), "Manufacturing")
        .when(cluster_id.like("WAREHOUSE%"), "Storage")
        .otherwise("Field")
    )


def job_source(query_tag: Column, query_text: Column, user_name: Column) -> Column:
    """Which tool issued a logged statement."""
    return (
        F.when(query_tag.like("%dbt%"), "dbt")
        .when(query_text.ilike("%COPY INTO%"), "COPY INTO (Airflow)")
        .when(query_text.ilike("%TASK%"), "Scheduled Task")
        .when(query_text.ilike("%streamlit%") | (user_name == "STREAMLIT"), "Streamlit")
        .otherwise("Other")
    )
