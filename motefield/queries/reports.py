"""Monitoring, dashboards, reviews and usage reports (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import json_field, try_ts
from ..plans import reports
from .base import joined, query
from .oracle import AS_OF, rd

WEEK = f"{AS_OF} - INTERVAL 7 DAY"
DAY = f"{AS_OF} - INTERVAL 24 HOUR"


@query("l1_freshness_log", f"""
    SELECT 'RAW.SENSOR_READINGS' AS table_name, max(loaded_at) AS latest_loaded_at, 75::BIGINT AS minutes_since_load,
           false AS is_fresh, 60::BIGINT AS threshold_minutes FROM staged""",
       longs="minutes_since_load threshold_minutes")
def freshness_log(d):
    return reports.freshness_log(d.staged, d.as_of + F.expr("interval 75 minutes"), "RAW.SENSOR_READINGS")


@query("l2_load_health", """
    SELECT max(loaded_at) AS last_load, 400::BIGINT AS minutes_since_last_load, count(*) AS total_raw_rows,
           'CRITICAL' AS status, 'Pipeline DOWN — Airflow has not loaded data for 6.7 hours. S3 data needs recovery load.'
           AS status_message, 6::BIGINT AS estimated_missed_batches FROM staged""",
       longs="minutes_since_last_load estimated_missed_batches")
def load_health(d):
    return reports.load_health(d.staged, d.as_of + F.expr("interval 400 minutes"))


@query("l2_load_health_alarm", """
    SELECT 'WARNING' AS status, 'Pipeline delayed — check Airflow. Data may be accumulating in S3.' AS status_message,
           120::BIGINT AS minutes_since_last_load, 1::BIGINT AS estimated_missed_batches FROM staged LIMIT 1""",
       longs="minutes_since_last_load estimated_missed_batches")
def load_health_alarm(d):
    late = reports.load_health(d.staged, d.as_of + F.expr("interval 120 minutes"))
    fine = reports.load_health(d.staged, d.as_of)
    return reports.unhealthy(late.unionByName(fine))


@query("l3_monitoring_report", f"""
    SELECT m AS latest_load, 0::BIGINT AS minutes_since_load, true AS is_fresh, s AS avg_quality_score, n AS record_count,
           coalesce(s >= 80, false) AS is_acceptable, a AS anomaly_count, a <= 50 AS is_normal,
           CASE WHEN s >= 80 AND a <= 50 THEN 'HEALTHY' ELSE 'DEGRADED' END AS overall_status
    FROM (SELECT max(loaded_at) AS m FROM staged),
         (SELECT avg(quality_score) AS s, count(*) AS n FROM quality WHERE batch_ts >= {AS_OF} - INTERVAL 1 HOUR),
         (SELECT count(*) AS a FROM anomalies WHERE detected_at >= {AS_OF} - INTERVAL 1 HOUR)""",
       doubles="avg_quality_score", longs="minutes_since_load")
def monitoring_report(d):
    return reports.monitoring_report(d.staged, d.settled.quality, d.settled.anomalies, d.as_of)


ALERT_TEXTS = ", ".join(f"('{metric}', '{warn}', '{critical}')" for metric, _, _, _, warn, critical in reports.ALERT_RULES)
ALERTS_SQL = f"""
    WITH texts(metric, warn_text, critical_text) AS (VALUES {ALERT_TEXTS}), m AS (
        SELECT 'data_freshness' AS metric, 0::DOUBLE AS value
        UNION ALL SELECT 'quality_score', avg(quality_score) FROM quality
        UNION ALL SELECT 'anomaly_rate', (SELECT count(*) FROM anomalies) * 100.0::DOUBLE / count(*) FROM staged
        UNION ALL SELECT 'battery_level', min(min_battery_pct) FROM health
        UNION ALL SELECT 'device_offline', count(*)::DOUBLE FROM devices WHERE device_status = 'offline'
        UNION ALL SELECT 'quarantine_rate', (SELECT count(*) FROM quarantined) * 100.0::DOUBLE / count(*) FROM staged)
    SELECT metric, value, level, CASE level WHEN 'warn' THEN warn_text WHEN 'critical' THEN critical_text END AS message FROM (
    SELECT metric, value, CASE metric
        WHEN 'data_freshness' THEN CASE WHEN value > 120 THEN 'critical' WHEN value > 60 THEN 'warn' ELSE 'ok' END
        WHEN 'quality_score' THEN CASE WHEN value < 60 THEN 'critical' WHEN value < 80 THEN 'warn' ELSE 'ok' END
        WHEN 'anomaly_rate' THEN CASE WHEN value > 15 THEN 'critical' WHEN value > 5 THEN 'warn' ELSE 'ok' END
        WHEN 'battery_level' THEN CASE WHEN value < 10 THEN 'critical' WHEN value < 20 THEN 'warn' ELSE 'ok' END
        WHEN 'device_offline' THEN CASE WHEN value > 10 THEN 'critical' WHEN value > 5 THEN 'warn' ELSE 'ok' END
        ELSE CASE WHEN value > 25 THEN 'critical' WHEN value > 10 THEN 'warn' ELSE 'ok' END END AS level
    FROM m) JOIN texts USING (metric)"""


@query("l4_alerts", ALERTS_SQL, doubles="value")
def alerts(d):
    x = d.settled
    metrics = reports.fleet_metrics(d.staged, x.quality, x.anomalies, x.health, x.dim_devices, d.as_of)
    return reports.alerts(metrics)


@query("l5_quality_trend", f"""
    SELECT CAST(batch_ts AS DATE) AS quality_date, {rd('avg(quality_score)', 2)} AS avg_quality_score,
           min(quality_score) AS min_quality_score, max(quality_score) AS max_quality_score
    FROM quality WHERE batch_ts >= {WEEK} GROUP BY 1""")
def quality_trend(d):
    return reports.quality_trend(d.layers.quality, d.as_of)


@query("l6_anomaly_summary", f"""
    SELECT severity, sensor_type, count(*) AS anomaly_count FROM anomalies WHERE detected_at >= {DAY} GROUP BY ALL""")
def anomaly_summary(d):
    return reports.anomaly_summary(d.layers.anomalies, d.as_of)


@query("l7_health_distribution", """
    SELECT health_status, count(DISTINCT device_id) AS device_count FROM health
    WHERE report_date = (SELECT max(report_date) FROM health) GROUP BY 1""")
def health_distribution(d):
    return reports.health_distribution_latest(d.layers.health)


@query("l8_battery_by_device", f"""
    SELECT device_id, {rd('avg(avg_battery_pct)', 1)} AS avg_battery_pct, min(min_battery_pct) AS min_battery_pct
    FROM health WHERE report_date >= CAST({AS_OF} AS DATE) - 3 GROUP BY 1""")
def battery_by_device(d):
    return reports.battery_by_device(d.layers.health, d.as_of)


@query("l9_hourly_volume", f"""
    SELECT reading_hour AS hour_bucket, sum(reading_count)::BIGINT AS total_readings FROM hourly
    WHERE reading_hour >= {DAY} GROUP BY 1""")
def hourly_volume(d):
    return reports.hourly_volume(d.layers.hourly, d.as_of)


@query("l10_latest_kpis", "SELECT * FROM overview ORDER BY report_date DESC LIMIT 1",
       doubles="avg_quality_score fleet_uptime_pct fleet_avg_battery")
def latest_kpis(d):
    return reports.latest_kpis(d.settled.overview)


@query("l10_kpi_trend", """
    SELECT report_date, active_devices, total_readings, avg_quality_score, critical_alerts, warning_alerts,
           fleet_uptime_pct, total_anomalies FROM overview""", doubles="avg_quality_score fleet_uptime_pct")
def kpi_trend(d):
    return reports.kpi_trend(d.settled.overview)


@query("l11_quarantine_rate", f"""
    SELECT CAST(batch_ts AS DATE) AS quality_date, sum(quarantined_count)::BIGINT AS total_quarantined,
           sum(total_records)::BIGINT AS total_records,
           {rd('100 * sum(quarantined_count) / sum(total_records)::DOUBLE', 2)} AS quarantine_rate_pct
    FROM quality WHERE batch_ts >= {WEEK} GROUP BY 1""")
def quarantine_rate(d):
    return reports.quarantine_rate(d.layers.quality, d.as_of)


@query("l12_noisiest_devices", f"""
    SELECT device_id, count(*) AS anomaly_count, count(DISTINCT sensor_type) AS affected_sensors,
           max(detected_at) AS latest_anomaly FROM anomalies WHERE detected_at >= {WEEK} GROUP BY 1
    ORDER BY anomaly_count DESC, device_id LIMIT 10""")
def noisiest_devices(d):
    return reports.noisiest_devices(d.layers.anomalies, d.as_of)


SCOPE = f"""SELECT * FROM anomalies WHERE detected_at >= {WEEK} AND severity IN ('critical', 'warning')
            AND sensor_type IN ('temperature', 'humidity', 'pressure', 'battery')"""


def _scope(d):
    return reports.explorer_scope(d.layers.anomalies, d.as_of, 7, ["critical", "warning"],
                                  ["temperature", "humidity", "pressure", "battery"])


@query("l13_explorer_summary", f"""
    SELECT severity, sensor_type, anomaly_type, count(*) AS anomaly_count FROM ({SCOPE}) GROUP BY ALL""")
def explorer_summary(d):
    return reports.explorer_summary(_scope(d))


@query("l13_explorer_trend", f"""
    SELECT CAST(detected_at AS DATE) AS date, severity, count(*) AS anomaly_count FROM ({SCOPE}) GROUP BY ALL""")
def explorer_trend(d):
    return reports.explorer_trend(_scope(d))


@query("l13_explorer_top", f"""
    SELECT device_id, count(*) AS anomaly_count, count(*) FILTER (WHERE severity = 'critical') AS critical_count,
           count(*) FILTER (WHERE severity = 'warning') AS warning_count FROM ({SCOPE}) GROUP BY 1
    ORDER BY anomaly_count DESC, device_id LIMIT 15""")
def explorer_top(d):
    return reports.explorer_top(_scope(d))


@query("l13_explorer_device", f"""
    SELECT * FROM anomalies WHERE device_id = 'DEV_007' AND detected_at >= {AS_OF} - INTERVAL 30 DAY
    ORDER BY detected_at DESC, anomaly_id LIMIT 100""", doubles="observed_value expected_min expected_max zscore")
def explorer_device(d):
    return reports.explorer_device(d.layers.anomalies, "DEV_007", d.as_of, 30)


@query("l13_recent_anomalies", """
    SELECT anomaly_id, device_id, detected_at, severity FROM anomalies WHERE severity IN ('critical', 'warning')
    ORDER BY detected_at DESC, anomaly_id LIMIT 50""")
def recent_anomalies(d):
    return reports.recent_anomalies(d.layers.anomalies).select("anomaly_id", "device_id", "detected_at", "severity")


@query("l14_freshness_state", """
    SELECT max(loaded_at) AS latest_load, 90::BIGINT AS minutes_ago, 'Stale' AS state FROM staged""",
       longs="minutes_ago")
def freshness_state(d):
    return reports.freshness_state(d.staged, d.as_of + F.expr("interval 90 minutes"))


@query("l14_latest_batches", "SELECT * FROM quality ORDER BY batch_ts DESC, source_file LIMIT 100")
def latest_batches(d):
    return reports.latest_batches(d.layers.quality)


@query("l14_quarantine_list", """
    SELECT device_id, reading_ts, reason_text AS rejection_reasons, loaded_at FROM quarantined
    ORDER BY loaded_at DESC, reading_id LIMIT 200""")
def quarantine_list(d):
    newest = reports.latest_n(d.layers.quarantined, "loaded_at", 200, ["reading_id"])
    return newest.select("device_id", "reading_ts", joined("rejection_reasons").alias("rejection_reasons"), "loaded_at")


@query("l14_late_list", """
    SELECT device_id, reading_ts, loaded_at, arrival_delay_minutes FROM late
    ORDER BY loaded_at DESC, reading_id LIMIT 100""", longs="arrival_delay_minutes")
def late_list(d):
    return reports.latest_n(d.layers.late, "loaded_at", 100, ["reading_id"]).select(
        "device_id", "reading_ts", "loaded_at", "arrival_delay_minutes")


@query("l14_delay_summary", """
    SELECT count(*) AS late_records, avg(arrival_delay_minutes) AS avg_delay_minutes FROM late""",
       doubles="avg_delay_minutes")
def delay_summary(d):
    return reports.delay_summary(d.layers.late)


@query("l14_delay_histogram", """
    SELECT least(30, 1 + ((m - lo) * 30) // (hi - lo)) AS bin, count(*) AS late_records
    FROM (SELECT arrival_delay_minutes AS m FROM late),
         (SELECT min(arrival_delay_minutes) AS lo, max(arrival_delay_minutes) AS hi FROM late) GROUP BY 1""", longs="bin")
def delay_histogram(d):
    return reports.delay_histogram(d.layers.late)


@query("l15_compare_counts", """
    SELECT 'batch (COPY INTO)' AS path, count(*) AS rows, min(loaded_at) AS first_load, max(loaded_at) AS last_load
    FROM staged UNION ALL SELECT 'streaming (Kafka)', count(*), min(stream_loaded), max(stream_loaded) FROM stream""")
def compare_counts(d):
    return reports.compare_counts(d.staged, d.stream)


def _latency_sql(label: str, source: str, loaded: str) -> str:
    seconds = f"date_diff('second', reading_ts, {loaded})"
    return f"""SELECT '{label}' AS path, avg({seconds}) AS avg_latency_seconds, max({seconds}) AS max_latency_seconds,
               min({seconds}) AS min_latency_seconds FROM {source} WHERE {loaded} >= {AS_OF} - INTERVAL 6 HOUR"""


def _timed(rows):
    return rows.select(try_ts(json_field("raw_data", "reading_ts")).alias("reading_ts"), "loaded_at")


@query("l16_compare_latency", f"""
    {_latency_sql('batch', 'staged', 'loaded_at')} UNION ALL {_latency_sql('streaming', 'stream', 'stream_loaded')}""",
       doubles="avg_latency_seconds", longs="max_latency_seconds min_latency_seconds")
def compare_latency(d):
    return reports.compare_latency(_timed(d.raw_plain), _timed(d.stream), d.as_of)


def _throughput_sql(label: str, source: str, loaded: str) -> str:
    return f"""SELECT '{label}' AS path, date_trunc('minute', {loaded})::TIMESTAMP AS minute, count(*) AS rows_per_minute
               FROM {source} WHERE {loaded} >= {AS_OF} - INTERVAL 48 HOUR GROUP BY ALL"""


@query("l17_compare_throughput", f"""
    {_throughput_sql('batch', 'staged', 'loaded_at')}
    UNION ALL {_throughput_sql('streaming', 'stream', 'stream_loaded')}""")
def compare_throughput(d):
    return reports.compare_throughput(d.staged, d.stream, d.as_of, hours=48)


@query("l18_offsets_per_partition", """
    SELECT source_partition, count(*) AS messages, min(source_offset) AS min_offset, max(source_offset) AS max_offset
    FROM stream GROUP BY 1""")
def offsets_per_partition(d):
    return reports.offsets_per_partition(d.stream)


@query("l19_consumer_lag", """
    SELECT source_partition, max(source_offset) + 1 AS latest_offset,
           coalesce(max(source_offset) FILTER (WHERE stream_loaded < TIMESTAMP '2024-01-25') + 1, 0) AS committed_offset,
           max(source_offset) - coalesce(max(source_offset) FILTER (WHERE stream_loaded < TIMESTAMP '2024-01-25'), -1)
           AS lag FROM stream GROUP BY 1""")
def consumer_lag(d):
    read = d.stream.filter(F.col("loaded_at") < F.lit("2024-01-25").cast("timestamp_ntz"))
    end = (F.max("source_offset") + 1)
    return reports.consumer_lag(d.stream.groupBy("source_partition").agg(end.alias("latest_offset")),
                                read.groupBy("source_partition").agg(end.alias("committed_offset")))


@query("l20_review_quality", f"""
    SELECT CAST(batch_ts AS DATE) AS run_date, count(*) AS batches, {rd('avg(quality_score)', 2)} AS avg_quality,
           min(quality_score) AS min_quality, sum(null_count)::BIGINT AS total_nulls,
           sum(duplicate_count)::BIGINT AS total_dupes, sum(quarantined_count)::BIGINT AS total_quarantined
    FROM quality GROUP BY 1""")
def review_quality(d):
    return reports.review_quality(d.layers.quality)


@query("l21_review_anomalies", """
    SELECT CAST(detected_at AS DATE) AS run_date, severity, sensor_type, count(*) AS anomaly_count FROM anomalies
    GROUP BY ALL""")
def review_anomalies(d):
    return reports.review_anomalies(d.layers.anomalies)


@query("l22_review_health", f"""
    SELECT report_date, health_status, count(*) AS device_count, {rd('avg(uptime_pct)', 2)} AS avg_uptime,
           {rd('avg(avg_battery_pct)', 2)} AS avg_battery FROM health GROUP BY 1, 2""")
def review_health(d):
    return reports.review_health(d.layers.health)


@query("l23_review_growth", """
    SELECT CAST(reading_hour AS DATE) AS run_date, count(*) AS hourly_buckets, sum(reading_count)::BIGINT AS total_readings,
           sum(anomaly_count)::BIGINT AS total_anomalies FROM hourly GROUP BY 1""")
def review_growth(d):
    return reports.review_growth(d.layers.hourly)


@query("l24_review_quarantine", """
    SELECT CAST(loaded_at AS DATE) AS run_date, reason_text AS rejection_reasons, count(*) AS record_count
    FROM quarantined GROUP BY ALL""")
def review_quarantine(d):
    return reports.review_quarantine(d.layers.quarantined).withColumn("rejection_reasons", joined("rejection_reasons"))


@query("l24_review_quarantine_reasons", """
    SELECT run_date, reason, count(*) AS record_count
    FROM (SELECT CAST(loaded_at AS DATE) AS run_date, unnest(rejection_reasons) AS reason FROM quarantined)
    GROUP BY ALL""")
def review_quarantine_reasons(d):
    return reports.review_quarantine(d.layers.quarantined, explode=True)


@query("l25_review_late", f"""
    SELECT CAST(loaded_at AS DATE) AS run_date, count(*) AS late_records,
           {rd('avg(arrival_delay_minutes)', 1)} AS avg_delay_minutes, max(arrival_delay_minutes) AS max_delay_minutes
    FROM late GROUP BY 1""", longs="max_delay_minutes")
def review_late(d):
    return reports.review_late(d.layers.late)


@query("l26_dedup_effectiveness", """
    SELECT CAST(loaded_at AS DATE) AS run_date, count(DISTINCT reading_id) AS raw_count,
           count(DISTINCT reading_id) AS deduped_count, 0::BIGINT AS dupes_removed FROM staged GROUP BY 1""")
def dedup_effectiveness(d):
    from ..operators.dedup import dedup_effect

    return dedup_effect(d.staged, d.layers.deduped).drop("rows_removed")


@query("l27_bad_batches", """
    SELECT batch_ts, source_file, quality_score, null_pct, duplicate_pct, quarantined_count FROM quality
    WHERE quality_score < 90 ORDER BY batch_ts DESC, source_file LIMIT 20""")
def bad_batches(d):
    return reports.bad_batches(d.layers.quality, below=90.0)


@query("l27_reasons_since", f"""
    SELECT reason_text AS rejection_reasons, count(*) AS cnt FROM quarantined WHERE loaded_at >= {DAY} GROUP BY 1""")
def reasons_since(d):
    return reports.reasons_since(d.layers.quarantined, d.as_of).withColumn(
        "rejection_reasons", joined("rejection_reasons"))


@query("l27_bad_readings_per_device", f"""
    SELECT device_id, count(*) AS bad_readings FROM quarantined WHERE loaded_at >= {DAY} GROUP BY 1""")
def bad_readings_per_device(d):
    return reports.bad_readings_per_device(d.layers.quarantined, d.as_of)


@query("l28_recent_loads", f"""
    SELECT source_file, count(*) AS rows_loaded, min(loaded_at) AS loaded_at FROM staged
    WHERE loaded_at > {AS_OF} - INTERVAL 48 HOUR GROUP BY 1""")
def recent_loads(d):
    return reports.recent_loads(d.staged, d.as_of, hours=48)


LAST_JOB = "(SELECT max(ts) FROM events)"


def _now(d):
    return d.events.agg(F.max("ts")).scalar()


@query("l29_usage_by_resource", f"""
    SELECT warehouse_name, sum(credits_used) AS total_credits, sum(credits_used_compute) AS compute_credits,
           sum(credits_used_cloud_services) AS cloud_credits, count(*) AS num_executions FROM usage
    WHERE start_time >= {LAST_JOB} - INTERVAL 30 DAY GROUP BY 1""",
       doubles="total_credits compute_credits cloud_credits")
def usage_by_resource(d):
    from ..fixture import usage_log

    return reports.usage_by_resource(usage_log(d.events), _now(d))


@query("l30_usage_by_day", f"""
    SELECT date_trunc('day', start_time)::TIMESTAMP AS usage_date, warehouse_name, sum(credits_used) AS credits FROM usage
    WHERE start_time >= {LAST_JOB} - INTERVAL 30 DAY GROUP BY ALL""", doubles="credits")
def usage_by_day(d):
    from ..fixture import usage_log

    return reports.usage_by_day(usage_log(d.events), _now(d))


@query("l31_slowest_jobs", f"""
    SELECT query_id, left(query_text, 100) AS query_preview, warehouse_name, execution_status,
           {rd('total_elapsed_time / 1000', 1)} AS seconds, {rd('credits_used_cloud_services', 4)} AS cloud_credits,
           start_time FROM jobs WHERE start_time >= {LAST_JOB} - INTERVAL 7 DAY
    ORDER BY total_elapsed_time DESC, query_id LIMIT 20""")
def slowest_jobs(d):
    from ..fixture import job_log

    return reports.slowest_jobs(job_log(d.events), _now(d))


@query("l32_jobs_by_source", f"""
    SELECT date_trunc('day', start_time)::TIMESTAMP AS query_date,
           CASE WHEN contains(query_tag, 'dbt') THEN 'dbt' WHEN query_text ILIKE '%copy into%' THEN 'COPY INTO (Airflow)'
                WHEN query_text ILIKE '%task%' THEN 'Scheduled Task'
                WHEN query_text ILIKE '%streamlit%' OR user_name = 'STREAMLIT' THEN 'Streamlit' ELSE 'Other' END AS source,
           count(*) AS query_count, {rd('sum(total_elapsed_time) / 1000', 1)} AS total_seconds
    FROM jobs WHERE start_time >= {LAST_JOB} - INTERVAL 7 DAY GROUP BY ALL""")
def jobs_by_source(d):
    from ..fixture import job_log

    return reports.jobs_by_source(job_log(d.events), _now(d))


@query("l33_run_durations", f"""
    SELECT source_file AS name, 'SUCCEEDED' AS state, min(reading_ts) AS scheduled_time, max(loaded_at) AS completed_time,
           date_diff('second', min(reading_ts), max(loaded_at)) AS runtime_seconds FROM staged GROUP BY 1
    ORDER BY scheduled_time DESC, name LIMIT 50""", longs="runtime_seconds")
def run_durations(d):
    """One run per source file, from its first reading to its load."""
    runs = d.staged.groupBy(F.col("source_file").alias("name")).agg(
        F.lit("SUCCEEDED").alias("state"), F.min("reading_ts").alias("scheduled_time"),
        F.max("loaded_at").alias("completed_time"))
    return reports.run_durations(runs, d.as_of, days=30)


@query("l34_table_sizes", f"""
    SELECT 'FLEET' AS database_name, cluster_id AS schema_name, device_id AS table_name,
           {rd('count(*) * 4096 / 1048576.0::DOUBLE', 2)} AS size_mb, {rd('count(*) * 1024 / 1048576.0::DOUBLE', 2)}
           AS time_travel_mb, {rd('count(*) * 512 / 1048576.0::DOUBLE', 2)} AS failsafe_mb, count(*) AS row_count
    FROM enriched GROUP BY ALL""")
def table_sizes(d):
    """A storage table with one entry per device, sized by its readings."""
    storage = d.layers.enriched.groupBy("cluster_id", "device_id").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("FLEET").alias("database_name"), F.col("cluster_id").alias("schema_name"),
        F.col("device_id").alias("table_name"), (F.col("row_count") * 4096).alias("bytes"),
        (F.col("row_count") * 1024).alias("time_travel_bytes"), (F.col("row_count") * 512).alias("failsafe_bytes"),
        "row_count")
    return reports.table_sizes(storage)


@query("l35_run_sql", """
    SELECT h.health_status, r.cluster_id, count(*) AS device_days, sum(h.readings_received)::BIGINT AS readings
    FROM health h JOIN registry r USING (device_id) GROUP BY ALL""")
def run_sql(d):
    tables = {"fct_device_health": d.layers.health, "device_registry": d.registry}
    return reports.run_sql(tables, """
        SELECT health_status, cluster_id, count(*) AS device_days, sum(readings_received) AS readings
        FROM fct_device_health JOIN device_registry USING (device_id) GROUP BY health_status, cluster_id""")
