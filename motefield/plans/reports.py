"""Dashboards, reviews and investigations as DataFrames over the layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import count_if, ratio, round_to
from ..functions.rules import job_source
from ..functions.timing import as_ts, boundary_diff, trunc
from ..operators.marts import latest_n, top_devices
from ..operators.validation import last, latest_day

Time = Column | dt.datetime | str


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


# ---- quality dashboard -------------------------------------------------------------------------------------


def quality_trend(quality: DataFrame, as_of: Time, days: int = 7) -> DataFrame:
    score = F.col("quality_score")
    return (
        last(quality, "batch_ts", days, "day", as_of)
        .groupBy(F.to_date("batch_ts").alias("quality_date"))
        .agg(round_to(F.avg(score), 2).alias("avg_quality_score"), F.min(score).alias("min_quality_score"),
             F.max(score).alias("max_quality_score"))
        .orderBy("quality_date")
    )


def anomaly_summary(anomalies: DataFrame, as_of: Time, hours: int = 24) -> DataFrame:
    recent = last(anomalies, "detected_at", hours, "hour", as_of)
    return recent.groupBy("severity", "sensor_type").agg(_count("anomaly_count")).orderBy(
        F.col("anomaly_count").desc(), "severity", "sensor_type"
    )


def health_distribution_latest(health: DataFrame) -> DataFrame:
    """Counted for every day first, so the facts are computed once; the latest day is then looked for among a few rows."""
    counts = health.groupBy("report_date", "health_status").agg(F.count_distinct("device_id").alias("device_count"))
    newest = counts.withColumn("_day", F.rank().over(Window.orderBy(F.col("report_date").desc_nulls_last())))
    return newest.filter(F.col("report_date").isNotNull() & (F.col("_day") == 1)).select("health_status", "device_count").orderBy(
        F.col("device_count").desc(), "health_status")


def battery_by_device(health: DataFrame, as_of: Time, days: int = 3) -> DataFrame:
    since = F.date_sub(F.to_date(as_ts(as_of)), days)
    return (
        health.filter(F.col("report_date") >= since)
        .groupBy("device_id")
        .agg(round_to(F.avg("avg_battery_pct"), 1).alias("avg_battery_pct"),
             F.min("min_battery_pct").alias("min_battery_pct"))
        .orderBy("avg_battery_pct", "device_id")
    )


def hourly_volume(hourly: DataFrame, as_of: Time, hours: int = 24) -> DataFrame:
    recent = last(hourly, "reading_hour", hours, "hour", as_of)
    return recent.groupBy(F.col("reading_hour").alias("hour_bucket")).agg(
        F.sum("reading_count").alias("total_readings")
    ).orderBy("hour_bucket")


def latest_kpis(overview: DataFrame) -> DataFrame:
    return latest_n(overview, "report_date", 1)


def kpi_trend(overview: DataFrame) -> DataFrame:
    return overview.select("report_date", "active_devices", "total_readings", "avg_quality_score", "critical_alerts",
                           "warning_alerts", "fleet_uptime_pct", "total_anomalies").orderBy("report_date")


def quarantine_rate(quality: DataFrame, as_of: Time, days: int = 7) -> DataFrame:
    bad, total = F.sum("quarantined_count"), F.sum("total_records")
    return (
        last(quality, "batch_ts", days, "day", as_of)
        .groupBy(F.to_date("batch_ts").alias("quality_date"))
        .agg(bad.alias("total_quarantined"), total.alias("total_records"),
             round_to(ratio(bad * 100.0, total), 2).alias("quarantine_rate_pct"))
        .orderBy("quality_date")
    )


def noisiest_devices(anomalies: DataFrame, as_of: Time, days: int = 7, k: int = 10) -> DataFrame:
    return top_devices(last(anomalies, "detected_at", days, "day", as_of), k)


def device_health_latest(health: DataFrame) -> DataFrame:
    return latest_day(health, "report_date").select(
        "device_id", "report_date", "health_status", "avg_battery_pct", "min_battery_pct", "uptime_pct",
        "readings_received", "alert_count",
    )


def recent_anomalies(anomalies: DataFrame, severities: Sequence[str] = ("critical", "warning"),
                     n: int = 50) -> DataFrame:
    shown = anomalies.filter(F.col("severity").isin(list(severities)))
    return latest_n(shown, "detected_at", n, ["anomaly_id"])


# ---- anomaly explorer --------------------------------------------------------------------------------------


def explorer_scope(anomalies: DataFrame, as_of: Time, days: int, severities: Sequence[str],
                   sensors: Sequence[str]) -> DataFrame:
    chosen = F.col("severity").isin(list(severities)) & F.col("sensor_type").isin(list(sensors))
    return last(anomalies, "detected_at", days, "day", as_of).filter(chosen)


def explorer_summary(scope: DataFrame) -> DataFrame:
    return scope.groupBy("severity", "sensor_type", "anomaly_type").agg(_count("anomaly_count")).orderBy(
        F.col("anomaly_count").desc(), "severity", "sensor_type", "anomaly_type"
    )


def explorer_trend(scope: DataFrame) -> DataFrame:
    return scope.groupBy(F.to_date("detected_at").alias("date"), "severity").agg(
        _count("anomaly_count")
    ).orderBy("date", "severity")


def explorer_top(scope: DataFrame, k: int = 15) -> DataFrame:
    return (
        scope.groupBy("device_id")
        .agg(_count("anomaly_count"), count_if(F.col("severity") == "critical").alias("critical_count"),
             count_if(F.col("severity") == "warning").alias("warning_count"))
        .orderBy(F.col("anomaly_count").desc(), "device_id")
        .limit(k)
    )


def explorer_device(anomalies: DataFrame, device_id: str, as_of: Time, days: int, n: int = 100) -> DataFrame:
    one = last(anomalies.filter(F.col("device_id") == device_id), "detected_at", days, "day", as_of)
    return latest_n(one, "detected_at", n, ["anomaly_id"])


# ---- quality page ------------------------------------------------------------------------------------------


def freshness_state(raw: DataFrame, as_of: Time, fresh: int = 60, stale: int = 120) -> DataFrame:
    latest = raw.agg(F.max("loaded_at").alias("latest_load"))
    minutes = F.col("minutes_ago")
    state = F.when(minutes <= fresh, "Fresh").when(minutes <= stale, "Stale").otherwise("CRITICAL")
    return latest.withColumn("minutes_ago", boundary_diff("minute", "latest_load", as_ts(as_of))).withColumn(
        "state", state
    )


def latest_batches(quality: DataFrame, n: int = 100) -> DataFrame:
    return latest_n(quality, "batch_ts", n, ["source_file"])


def delay_summary(late: DataFrame) -> DataFrame:
    return late.agg(_count("late_records"), F.avg("arrival_delay_minutes").alias("avg_delay_minutes"))


def delay_histogram(late: DataFrame, bins: int = 30, column: str = "arrival_delay_minutes") -> DataFrame:
    """Equal-width bins between the smallest and the largest delay; the largest value falls into the last bin."""
    low, high = late.agg(F.min(column)).scalar(), late.agg(F.max(column)).scalar()
    value = F.col(column).cast("double")
    wide = F.least(F.width_bucket(value, low.cast("double"), high.cast("double"), F.lit(bins).cast("int")),
                   F.lit(bins).cast("long"))
    return late.select(F.when(high > low, wide).otherwise(F.lit(1)).alias("bin")).groupBy("bin").agg(
        _count("late_records")
    )


# ---- health and alerts -------------------------------------------------------------------------------------


def freshness_log(raw: DataFrame, as_of: Time, table_name: str, threshold: int = 60) -> DataFrame:
    """One freshness row to append to a log."""
    minutes = F.col("minutes_since_load")
    return (
        raw.agg(F.max("loaded_at").alias("latest_loaded_at"))
        .withColumn("minutes_since_load", boundary_diff("minute", "latest_loaded_at", as_ts(as_of)))
        .select(F.lit(table_name).alias("table_name"), "latest_loaded_at", "minutes_since_load",
                (minutes <= threshold).alias("is_fresh"), F.lit(threshold).alias("threshold_minutes"))
    )


# fixed values: the texts of the load health report
HEALTHY_TEXT = "Pipeline running normally"
WARNING_TEXT = "Pipeline delayed — check Airflow. Data may be accumulating in S3."
CRITICAL_HEAD = "Pipeline DOWN — Airflow has not loaded data for "
CRITICAL_TAIL = " hours. S3 data needs recovery load."


def load_health(raw: DataFrame, as_of: Time, healthy: int = 90, warning: int = 180) -> DataFrame:
    """Age of the last load as a status with a message and the number of missed hourly batches."""
    minutes = F.col("minutes_since_last_load")
    hours = F.round(minutes.cast("decimal(18,4)") / 60, 1).cast("decimal(18,1)").cast("string")
    missed = F.round(minutes.cast("decimal(18,4)") / 60, 0).cast("long") - 1
    return (
        raw.agg(F.max("loaded_at").alias("last_load"), _count("total_raw_rows"))
        .withColumn("minutes_since_last_load", boundary_diff("minute", "last_load", as_ts(as_of)))
        .select(
            "last_load", "minutes_since_last_load", "total_raw_rows",
            F.when(minutes <= healthy, "HEALTHY").when(minutes <= warning, "WARNING").otherwise("CRITICAL")
            .alias("status"),
            F.when(minutes <= healthy, HEALTHY_TEXT).when(minutes <= warning, WARNING_TEXT)
            .otherwise(F.concat(F.lit(CRITICAL_HEAD), hours, F.lit(CRITICAL_TAIL))).alias("status_message"),
            F.greatest(F.lit(0), missed).alias("estimated_missed_batches"),
        )
    )


def unhealthy(health: DataFrame) -> DataFrame:
    return health.filter(F.col("status") != "HEALTHY").select(
        "status", "status_message", "minutes_since_last_load", "estimated_missed_batches"
    )


def monitoring_report(raw: DataFrame, quality: DataFrame, anomalies: DataFrame, as_of: Time, max_minutes: int = 120,
                      min_score: float = 80.0, max_anomalies: int = 50) -> DataFrame:
    """Freshness, last hour's quality and anomaly count in one row. Missing quality data is not acceptable."""
    now = as_ts(as_of)
    score = last(quality, "batch_ts", 1, "hour", now).agg(F.avg("quality_score")).scalar()
    batches = last(quality, "batch_ts", 1, "hour", now).agg(F.count(F.lit(1))).scalar()
    events = last(anomalies, "detected_at", 1, "hour", now).agg(F.count(F.lit(1))).scalar()
    minutes = boundary_diff("minute", "latest_load", now)
    base = raw.agg(F.max("loaded_at").alias("latest_load")).select(
        "latest_load",
        minutes.alias("minutes_since_load"),
        F.coalesce(minutes <= max_minutes, F.lit(False)).alias("is_fresh"),
        score.alias("avg_quality_score"),
        batches.alias("record_count"),
        F.coalesce(score >= min_score, F.lit(False)).alias("is_acceptable"),
        events.alias("anomaly_count"),
        (events <= max_anomalies).alias("is_normal"),
    )
    good = F.col("is_fresh") & F.col("is_acceptable") & F.col("is_normal")
    return base.withColumn("overall_status", F.when(good, "HEALTHY").otherwise("DEGRADED"))


# fixed values: metric, direction, warn and critical limits, texts
ALERT_RULES = [
    ("data_freshness", "above", 60.0, 120.0, "Data has not been refreshed in over 60 minutes",
     "Data is stale — no ingestion for over 120 minutes"),
    ("quality_score", "below", 80.0, 60.0, "Quality score dropped below 80 — review recent ingestion",
     "Quality score below 60 — quarantine and investigate immediately"),
    ("anomaly_rate", "above", 5.0, 15.0, "Anomaly rate above 5% — check sensor calibration",
     "Anomaly rate above 15% — possible sensor failure or data corruption"),
    ("battery_level", "below", 20.0, 10.0, "Devices detected with battery below 20%",
     "Devices with critically low battery (<10%) — schedule replacement"),
    ("device_offline", "above", 5.0, 10.0, "More than 5 devices offline — check connectivity",
     "More than 10 devices offline — potential network or gateway issue"),
    ("quarantine_rate", "above", 10.0, 25.0, "Quarantine rate above 10% — review validation rules",
     "Quarantine rate above 25% — upstream data source may be compromised"),
]


def alerts(metrics: DataFrame, rules: Sequence[tuple] = tuple(ALERT_RULES)) -> DataFrame:
    """Level and message for each ``(metric, value)`` row. Rules are a handful of rows joined by metric."""
    ddl = "metric string, direction string, warn double, critical double, warn_text string, critical_text string"
    table = F.broadcast(metrics.sparkSession.createDataFrame(list(rules), ddl))
    value = F.col("value")

    def beyond(limit: str) -> Column:
        return F.when(F.col("direction") == "below", value < F.col(limit)).otherwise(value > F.col(limit))

    return metrics.join(table, "metric").select(
        "metric", "value",
        F.when(beyond("critical"), "critical").when(beyond("warn"), "warn").otherwise("ok").alias("level"),
        F.when(beyond("critical"), F.col("critical_text")).when(beyond("warn"), F.col("warn_text")).alias("message"),
    )


def fleet_metrics(raw: DataFrame, quality: DataFrame, anomalies: DataFrame, health: DataFrame, dim_devices: DataFrame,
                  as_of: Time) -> DataFrame:
    """The (metric, value) rows the alert rules look at."""
    age = raw.agg(F.max("loaded_at").alias("m")).select(boundary_diff("minute", "m", as_ts(as_of)).alias("value"))
    totals = quality.agg(F.sum("total_records").alias("n"), F.sum("quarantined_count").alias("bad"))
    parts = {
        "data_freshness": age,
        "quality_score": quality.agg(F.avg("quality_score").alias("value")),
        "anomaly_rate": anomalies.agg(
            ratio(F.count(F.lit(1)) * 100.0, quality.agg(F.sum("total_records")).scalar()).alias("value")),
        "battery_level": health.agg(F.min("min_battery_pct").alias("value")),
        "device_offline": dim_devices.agg(count_if(F.col("device_status") == "offline").alias("value")),
        "quarantine_rate": totals.select(ratio(F.col("bad") * 100.0, F.col("n")).alias("value")),
    }
    out = None
    for name, part in parts.items():
        row = part.select(F.lit(name).alias("metric"), F.col("value").cast("double").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


# ---- batch against stream ----------------------------------------------------------------------------------

# fixed values: row labels of the comparison
BATCH_LABEL = "batch (COPY INTO)"
STREAM_LABEL = "streaming (Kafka)"


def compare_counts(batch: DataFrame, stream: DataFrame) -> DataFrame:
    def side(label: str, df: DataFrame) -> DataFrame:
        return df.agg(_count("rows"), F.min("loaded_at").alias("first_load"), F.max("loaded_at").alias("last_load")) \
            .select(F.lit(label).alias("path"), "*")

    return side(BATCH_LABEL, batch).unionByName(side(STREAM_LABEL, stream))


def compare_latency(batch: DataFrame, stream: DataFrame, as_of: Time, hours: int = 6) -> DataFrame:
    """Seconds from reading to load; both inputs need ``reading_ts`` and ``loaded_at``."""
    def side(label: str, df: DataFrame) -> DataFrame:
        seconds = boundary_diff("second", "reading_ts", "loaded_at")
        return last(df, "loaded_at", hours, "hour", as_of).select(seconds.alias("s")).agg(
            F.avg("s").alias("avg_latency_seconds"), F.max("s").alias("max_latency_seconds"),
            F.min("s").alias("min_latency_seconds"),
        ).select(F.lit(label).alias("path"), "*")

    return side("batch", batch).unionByName(side("streaming", stream))


def compare_throughput(batch: DataFrame, stream: DataFrame, as_of: Time, hours: int = 1) -> DataFrame:
    def side(label: str, df: DataFrame) -> DataFrame:
        minute = trunc("minute", "loaded_at").alias("minute")
        return last(df, "loaded_at", hours, "hour", as_of).groupBy(minute).agg(_count("rows_per_minute")).select(
            F.lit(label).alias("path"), "*"
        )

    return side("batch", batch).unionByName(side("streaming", stream)).orderBy(F.col("minute").desc(), "path")


def offsets_per_partition(stream: DataFrame) -> DataFrame:
    return stream.groupBy("source_partition").agg(
        _count("messages"), F.min("source_offset").alias("min_offset"), F.max("source_offset").alias("max_offset")
    ).orderBy("source_partition")


def consumer_lag(produced: DataFrame, consumed: DataFrame) -> DataFrame:
    """Per partition: next offset to produce minus next offset to consume; nothing consumed yet counts from 0."""
    return produced.join(consumed, "source_partition", "left").select(
        "source_partition", "latest_offset", F.coalesce("committed_offset", F.lit(0)).alias("committed_offset"),
        (F.col("latest_offset") - F.coalesce("committed_offset", F.lit(0))).alias("lag"),
    )


# ---- run review --------------------------------------------------------------------------------------------


def review_quality(quality: DataFrame) -> DataFrame:
    return quality.groupBy(F.to_date("batch_ts").alias("run_date")).agg(
        _count("batches"),
        round_to(F.avg("quality_score"), 2).alias("avg_quality"),
        round_to(F.min("quality_score"), 2).alias("min_quality"),
        F.sum("null_count").alias("total_nulls"),
        F.sum("duplicate_count").alias("total_dupes"),
        F.sum("quarantined_count").alias("total_quarantined"),
    ).orderBy("run_date")


def review_anomalies(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(F.to_date("detected_at").alias("run_date"), "severity", "sensor_type").agg(
        _count("anomaly_count")
    ).orderBy("run_date", "severity", "sensor_type")


def review_health(health: DataFrame) -> DataFrame:
    return health.groupBy("report_date", "health_status").agg(
        _count("device_count"), round_to(F.avg("uptime_pct"), 2).alias("avg_uptime"),
        round_to(F.avg("avg_battery_pct"), 2).alias("avg_battery"),
    ).orderBy("report_date", "health_status")


def review_growth(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy(F.to_date("reading_hour").alias("run_date")).agg(
        _count("hourly_buckets"), F.sum("reading_count").alias("total_readings"),
        F.sum("anomaly_count").alias("total_anomalies"),
    ).orderBy("run_date")


def review_quarantine(quarantined: DataFrame, explode: bool = False) -> DataFrame:
    """Rejected rows per load day and reason list, or per single reason."""
    reason = F.explode("rejection_reasons") if explode else F.col("rejection_reasons")
    name = "reason" if explode else "rejection_reasons"
    rows = quarantined.select(F.to_date("loaded_at").alias("run_date"), reason.alias(name))
    return rows.groupBy("run_date", name).agg(_count("record_count")).orderBy(
        "run_date", F.col("record_count").desc(), name
    )


def review_late(late: DataFrame) -> DataFrame:
    delay = F.col("arrival_delay_minutes")
    return late.groupBy(F.to_date("loaded_at").alias("run_date")).agg(
        _count("late_records"), round_to(F.avg(delay), 1).alias("avg_delay_minutes"),
        F.max(delay).alias("max_delay_minutes"),
    ).orderBy("run_date")


# ---- investigation -----------------------------------------------------------------------------------------


def bad_batches(quality: DataFrame, below: float = 70.0, n: int = 20) -> DataFrame:
    low = quality.filter(F.col("quality_score") < below).select(
        "batch_ts", "source_file", "quality_score", "null_pct", "duplicate_pct", "quarantined_count"
    )
    return latest_n(low, "batch_ts", n, ["source_file"])


def reasons_since(quarantined: DataFrame, as_of: Time, hours: int = 24) -> DataFrame:
    recent = last(quarantined, "loaded_at", hours, "hour", as_of)
    return recent.groupBy("rejection_reasons").agg(_count("cnt")).orderBy(F.col("cnt").desc(), "rejection_reasons")


def bad_readings_per_device(quarantined: DataFrame, as_of: Time, hours: int = 24) -> DataFrame:
    recent = last(quarantined, "loaded_at", hours, "hour", as_of)
    return recent.groupBy("device_id").agg(_count("bad_readings")).orderBy(F.col("bad_readings").desc(), "device_id")


def recent_loads(raw: DataFrame, as_of: Time, hours: int = 1) -> DataFrame:
    fresh = raw.filter(F.col("loaded_at") > as_ts(as_of) - F.expr(f"interval {hours} hour"))
    return fresh.groupBy("source_file").agg(_count("rows_loaded"), F.min("loaded_at").alias("loaded_at")).orderBy(
        "source_file"
    )


# ---- usage -------------------------------------------------------------------------------------------------


def usage_by_resource(usage: DataFrame, as_of: Time, days: int = 30) -> DataFrame:
    return last(usage, "start_time", days, "day", as_of).groupBy("warehouse_name").agg(
        F.sum("credits_used").alias("total_credits"), F.sum("credits_used_compute").alias("compute_credits"),
        F.sum("credits_used_cloud_services").alias("cloud_credits"), _count("num_executions"),
    ).orderBy(F.col("total_credits").desc())


def usage_by_day(usage: DataFrame, as_of: Time, days: int = 30) -> DataFrame:
    return last(usage, "start_time", days, "day", as_of).groupBy(
        trunc("day", "start_time").alias("usage_date"), "warehouse_name"
    ).agg(F.sum("credits_used").alias("credits")).orderBy(F.col("usage_date").desc(), F.col("credits").desc())


def slowest_jobs(jobs: DataFrame, as_of: Time, days: int = 7, n: int = 20) -> DataFrame:
    return (
        last(jobs, "start_time", days, "day", as_of)
        .orderBy(F.col("total_elapsed_time").desc(), "query_id")
        .limit(n)
        .select("query_id", F.left("query_text", F.lit(100)).alias("query_preview"), "warehouse_name",
                "execution_status", round_to(F.col("total_elapsed_time") / 1000, 1).alias("seconds"),
                round_to(F.col("credits_used_cloud_services"), 4).alias("cloud_credits"), "start_time")
    )


def jobs_by_source(jobs: DataFrame, as_of: Time, days: int = 7) -> DataFrame:
    source = job_source(F.col("query_tag"), F.col("query_text"), F.col("user_name"))
    return last(jobs, "start_time", days, "day", as_of).groupBy(
        trunc("day", "start_time").alias("query_date"), source.alias("source")
    ).agg(_count("query_count"), round_to(F.sum("total_elapsed_time") / 1000, 1).alias("total_seconds")).orderBy(
        F.col("query_date").desc(), F.col("total_seconds").desc()
    )


def run_durations(runs: DataFrame, as_of: Time, days: int = 7, n: int = 50) -> DataFrame:
    """Latest scheduled runs with their run time; input has name, state, scheduled_time, completed_time."""
    recent = last(runs, "scheduled_time", days, "day", as_of)
    timed = recent.withColumn("runtime_seconds", boundary_diff("second", "scheduled_time", "completed_time"))
    return latest_n(timed, "scheduled_time", n, ["name"])


def table_sizes(storage: DataFrame) -> DataFrame:
    """Sizes in MB; input has database_name, schema_name, table_name, bytes, time_travel_bytes, failsafe_bytes,
    row_count."""
    def mb(name: str) -> Column:
        return round_to(F.col(name) / (1024 * 1024), 2)

    return storage.orderBy(F.col("bytes").desc(), "table_name").select(
        "database_name", "schema_name", "table_name", mb("bytes").alias("size_mb"),
        mb("time_travel_bytes").alias("time_travel_mb"), mb("failsafe_bytes").alias("failsafe_mb"), "row_count",
    )


def register_layers(layers: dict[str, DataFrame]) -> list[str]:
    """Temp views for ad-hoc ``spark.sql`` over the datasets."""
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
    return sorted(layers)


def run_sql(layers: dict[str, DataFrame], text: str) -> DataFrame:
    register_layers(layers)
    return next(iter(layers.values())).sparkSession.sql(text)
