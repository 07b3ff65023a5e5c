"""Windows and dedup (F), sorting and top-k (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timing import boundary_diff
from ..operators import dedup, marts, ordered
from ..plans import reports
from .base import MEASURES, query


@query("f1_dedup", "SELECT * FROM deduped", doubles=MEASURES)
def dedup_readings(d):
    return d.layers.deduped


@query("f2_dedup_by", """
    SELECT device_id, reading_ts, loaded_at, source_file FROM staged
    QUALIFY row_number() OVER (PARTITION BY device_id, reading_ts ORDER BY loaded_at DESC, source_file DESC) = 1""")
def dedup_by(d):
    order = [F.col("loaded_at").desc(), F.col("source_file").desc()]
    return dedup.dedup(d.staged, ["device_id", "reading_ts"], order).select(
        "device_id", "reading_ts", "loaded_at", "source_file")


@query("f3_latest_per_device", """
    SELECT m.*, s.reading_id AS last_reading FROM metadata m JOIN (
        SELECT device_id, reading_id FROM staged
        QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY reading_ts DESC, reading_id DESC, loaded_at DESC) = 1
    ) s USING (device_id)""")
def latest_per_device(d):
    last = dedup.latest_per_key(d.staged, "device_id", "reading_ts", ["reading_id", "loaded_at"])
    return d.layers.metadata.join(last.select("device_id", F.col("reading_id").alias("last_reading")), "device_id")


@query("f4_rolling_zscore", "SELECT reading_id, temperature_zscore FROM scored", doubles="temperature_zscore")
def rolling_zscore(d):
    return ordered.rolling_zscore(d.layers.deduped, profile=d.staged).select("reading_id", "temperature_zscore")


@query("f4_rolling_zscore_sliced", "SELECT reading_id, temperature_zscore FROM scored", doubles="temperature_zscore")
def rolling_zscore_sliced(d):
    """The hot-device plan: every device is cut into slices of about a hundred rows."""
    scored = ordered.rolling_zscore(d.layers.deduped, profile=d.staged, rows_per_slice=100)
    return scored.select("reading_id", "temperature_zscore")


@query("f5_flag_anomaly", "SELECT device_id, is_anomaly, count(*) AS n FROM checked GROUP BY ALL")
def flag_anomaly(d):
    scored = ordered.rolling_zscore(d.layers.deduped, profile=d.staged)
    return scored.withColumn("is_anomaly", ordered.flag_anomaly()).groupBy("device_id", "is_anomaly").agg(
        F.count(F.lit(1)).alias("n"))


@query("f6_first_per", """
    SELECT device_id, firmware_version, error_profile, reading_id, reading_ts FROM staged
    QUALIFY row_number() OVER (PARTITION BY device_id, firmware_version, error_profile
                               ORDER BY reading_ts, reading_id, loaded_at) = 1""")
def first_per(d):
    order = [F.col(c) for c in ("reading_ts", "reading_id", "loaded_at")]
    return dedup.first_per(d.staged, ["device_id", "firmware_version", "error_profile"], order).select(
        "device_id", "firmware_version", "error_profile", "reading_id", "reading_ts")


@query("f7_rolling_avg", """
    SELECT reading_id, avg(temperature) OVER (PARTITION BY device_id ORDER BY reading_ts, reading_id
                                              ROWS 11 PRECEDING) AS rolling_avg FROM deduped""", doubles="rolling_avg")
def rolling_avg(d):
    return ordered.rolling_avg(d.layers.deduped, profile=d.staged).select("reading_id", "rolling_avg")


@query("f8_rank_in", """
    SELECT hourly_reading_id, cluster_id, rank() OVER (PARTITION BY cluster_id ORDER BY avg_temperature DESC NULLS FIRST)
           AS temperature_rank
    FROM (SELECT hourly_reading_id, cluster_id, CAST(avg_temperature AS DECIMAL(28,6)) AS avg_temperature
          FROM hourly)""", longs="temperature_rank")
def rank_in(d):
    rounded = d.layers.hourly.select("hourly_reading_id", "cluster_id",
                                     F.col("avg_temperature").cast("decimal(28,6)").alias("avg_temperature"))
    return ordered.rank_in(rounded, ["cluster_id"], "avg_temperature", "temperature_rank").drop("avg_temperature")


@query("f9_reading_gaps", """
    SELECT reading_id, date_diff('minute', lag(reading_ts) OVER (PARTITION BY device_id ORDER BY reading_ts, reading_id),
                                 reading_ts) AS gap_minutes FROM deduped""", longs="gap_minutes")
def reading_gaps(d):
    rows = ordered.with_previous(d.layers.deduped, "device_id", "reading_ts", ["reading_id"],
                                 {"previous_ts": "reading_ts"}, profile=d.staged)
    return rows.select("reading_id", boundary_diff("minute", "previous_ts", "reading_ts").alias("gap_minutes"))


@query("g1_order_by", "SELECT device_id, error_profile, count(*) AS n FROM staged GROUP BY ALL ORDER BY n DESC, 1, 2")
def order_by(d):
    counts = d.staged.groupBy("device_id", "error_profile").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "device_id", "error_profile")


@query("g2_order_by_status", """
    SELECT device_id, report_date, health_status FROM health WHERE report_date = (SELECT max(report_date) FROM health)
    ORDER BY CASE health_status WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END, device_id""")
def order_by_status(d):
    return marts.order_by_status(reports.device_health_latest(d.layers.health)).select(
        "device_id", "report_date", "health_status")


@query("g3_top_devices", """
    SELECT device_id, count(*) AS anomaly_count, count(DISTINCT sensor_type) AS affected_sensors,
           max(detected_at) AS latest_anomaly FROM anomalies GROUP BY 1
    ORDER BY anomaly_count DESC, device_id LIMIT 10""")
def top_devices(d):
    return marts.top_devices(d.layers.anomalies, 10)


@query("g4_latest_n", """
    SELECT reading_id, device_id, reading_ts FROM deduped ORDER BY reading_ts DESC, reading_id LIMIT 50""")
def latest_n(d):
    return marts.latest_n(d.layers.deduped.select("reading_id", "device_id", "reading_ts"), "reading_ts", 50,
                          ["reading_id"])


@query("g5_distinct_values", "SELECT DISTINCT device_id FROM anomalies ORDER BY 1")
def distinct_values(d):
    return marts.distinct_values(d.layers.anomalies, "device_id")


@query("g6_anomaly_branches", """
    SELECT sensor_type, anomaly_type, severity, count(*) AS n, sum(observed_value) AS total FROM anomalies
    GROUP BY ALL""", doubles="total")
def anomaly_branches(d):
    return d.layers.anomalies.groupBy("sensor_type", "anomaly_type", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.sum("observed_value").alias("total"))


@query("g7_union_counts", f"""
    SELECT 'batch (COPY INTO)' AS path, count(*) AS n FROM staged
    UNION ALL SELECT 'streaming (Kafka)', count(*) FROM stream""")
def union_counts(d):
    return reports.compare_counts(d.staged, d.stream).select("path", F.col("rows").alias("n"))


