"""Joins (D) and aggregations (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import json_field
from ..operators import dedup, dimensional, enrich, history, marts, moments, sketches, validation, vault
from .base import query
from .oracle import AS_OF, key, rd, ts_text

DEVICE_SK = key("device_id")


@query("d2_threshold_per_sensor", """
    SELECT v.reading_id, t.min_valid AS temperature_min, t.max_valid AS temperature_max, c.min_valid AS co2_min,
           c.max_valid AS co2_max FROM deduped v
    LEFT JOIN thresholds t ON t.sensor_type = 'temperature' LEFT JOIN thresholds c ON c.sensor_type = 'co2'""")
def threshold_per_sensor(d):
    rows = validation.attach_threshold(d.layers.deduped, d.thresholds, "temperature", "temperature_min",
                                       "temperature_max")
    rows = validation.attach_threshold(rows, d.thresholds, "co2", "co2_min", "co2_max")
    return rows.select("reading_id", "temperature_min", "temperature_max", "co2_min", "co2_max")


@query("d3_attach_threshold", """
    SELECT reading_id, min_valid AS threshold_min, max_valid AS threshold_max, temperature > max_valid AS too_hot
    FROM deduped CROSS JOIN (SELECT * FROM thresholds WHERE sensor_type = 'temperature')""")
def attach_threshold(d):
    rows = validation.attach_threshold(d.layers.deduped, d.thresholds, "temperature", "threshold_min", "threshold_max")
    return rows.select("reading_id", "threshold_min", "threshold_max",
                       (F.col("temperature") > F.col("threshold_max")).alias("too_hot"))


@query("d4_quality_counts", """
    SELECT source_file, n AS total_records, dups AS duplicate_count, bad AS quarantined_count, late_n AS late_arrival_count
    FROM file_counts""")
def quality_counts(d):
    return d.layers.quality.select("source_file", "total_records", "duplicate_count", "quarantined_count",
                                   "late_arrival_count")


@query("d5_overview_join", "SELECT report_date, total_readings, total_quarantined, total_anomalies FROM overview")
def overview_join(d):
    return d.settled.overview.select("report_date", "total_readings", "total_quarantined", "total_anomalies")


DEVICE_NORMALIZED = f"""
    SELECT {DEVICE_SK} AS device_sk, device_id, device_name, {key('device_type')} AS device_type_sk,
           {key('cluster_id')} AS cluster_sk, install_date, coalesce(firmware_version, 'unknown') AS firmware_version,
           last_seen_at, device_status FROM devices"""


@query("d6_dim_device_normalized", DEVICE_NORMALIZED)
def dim_device_normalized(d):
    return d.layers.dim_device_normalized


@query("d7_fct_normalized", f"""
    SELECT reading_id, {DEVICE_SK} AS device_sk, {key(ts_text("date_trunc('hour', reading_ts)::TIMESTAMP"))} AS time_sk,
           temperature, temperature_zscore FROM enriched""", doubles="temperature temperature_zscore")
def fct_normalized(d):
    return d.layers.fct_normalized.select("reading_id", "device_sk", "time_sk", "temperature", "temperature_zscore")


VAULT_ANSWER = f"""
    SELECT r.cluster_id, {rd('avg(s.temperature)', 2)} AS avg_temperature, count(*) AS reading_count
    FROM deduped s JOIN registry r USING (device_id)
    WHERE s.reading_ts >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1"""


@query("d8_vault_chain", VAULT_ANSWER)
def vault_chain(d):
    x = d.layers
    return vault.dv_avg_temp(x.sat_reading, x.link, x.hub_device, d.registry, d.as_of)


@query("d9_insert_new", """
    SELECT reading_id, device_id FROM deduped
    WHERE reading_id NOT IN (SELECT reading_id FROM staged WHERE loaded_at < TIMESTAMP '2024-01-20')""")
def insert_new(d):
    target = d.staged.filter(F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return enrich.insert_new(d.layers.deduped, target, "reading_id").select("reading_id", "device_id")


@query("d10_dedup_effect", """
    SELECT CAST(s.loaded_at AS DATE) AS run_date, count(DISTINCT s.reading_id) AS raw_count,
           count(DISTINCT x.reading_id) AS deduped_count,
           count(DISTINCT s.reading_id) - count(DISTINCT x.reading_id) AS dupes_removed,
           count(*) - any_value(kept) AS rows_removed
    FROM staged s LEFT JOIN (SELECT reading_id FROM deduped) x USING (reading_id)
    LEFT JOIN (SELECT CAST(loaded_at AS DATE) AS day, count(*) AS kept FROM deduped GROUP BY 1) k
           ON k.day = CAST(s.loaded_at AS DATE)
    GROUP BY 1""")
def dedup_effect(d):
    return dedup.dedup_effect(d.staged, d.layers.deduped)


@query("d11_orphans", """
    SELECT reading_id, device_id, loaded_at FROM staged
    WHERE device_id NOT IN (SELECT device_id FROM registry WHERE cluster_id <> 'FACTORY_A')""")
def orphans(d):
    known = d.registry.filter(F.col("cluster_id") != "FACTORY_A")
    return enrich.orphans(d.staged, known, "device_id").select("reading_id", "device_id", "loaded_at")


@query("d12_as_of_version", """
    SELECT d.reading_id, d.device_id, v.firmware_version AS firmware_version_at_reading, v.valid_from, v.valid_to
    FROM deduped d LEFT JOIN versions v ON v.device_id = d.device_id AND d.reading_ts >= v.valid_from
         AND (v.valid_to IS NULL OR d.reading_ts < v.valid_to)""")
def as_of_version(d):
    versions = _versions(d)
    facts = d.layers.deduped.select("reading_id", "device_id", "reading_ts")
    return enrich.join_as_of_version(facts, versions, "device_id", "reading_ts", ["firmware_version"], profile=d.staged).drop("reading_ts")


@query("d12_as_of_version_sliced", """
    SELECT d.reading_id, d.device_id, v.firmware_version AS firmware_version_at_reading, v.valid_from, v.valid_to
    FROM deduped d LEFT JOIN versions v ON v.device_id = d.device_id AND d.reading_ts >= v.valid_from
         AND (v.valid_to IS NULL OR d.reading_ts < v.valid_to)""")
def as_of_version_sliced(d):
    """The plan of busy devices: each is cut into slices of about a hundred rows."""
    facts = d.layers.deduped.select("reading_id", "device_id", "reading_ts")
    return enrich.join_as_of_version(facts, _versions(d), "device_id", "reading_ts", ["firmware_version"], 100, d.staged).drop("reading_ts")


ATTRIBUTES = ["firmware_version", "cluster_id", "device_type", "base_latitude", "base_longitude"]


def _versions(d):
    log = d.layers.deduped.select("reading_id", "device_id", "reading_ts", "firmware_version").join(
        d.registry.select("device_id", "cluster_id", "device_type", "base_latitude", "base_longitude"),
        "device_id", "left")
    return history.scd2_from_log(log, "device_id", ATTRIBUTES, "reading_ts", ["reading_id"], profile=d.staged)


STAR_ANSWER = f"""
    SELECT r.cluster_id, avg(avg_temperature) AS avg_temp,
           sum(avg_temperature * reading_count) / sum(reading_count) AS avg_temperature,
           sum(reading_count)::BIGINT AS reading_count
    FROM (SELECT device_id, reading_hour, avg_temperature, reading_count FROM hourly)
    JOIN registry r USING (device_id) WHERE reading_hour >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1"""


@query("d13_star_join", STAR_ANSWER, doubles="avg_temp avg_temperature")
def star_join(d):
    return dimensional.avg_temp_star(d.layers.hourly, d.layers.dim_devices, d.as_of)


@query("d14_snowflake_join", f"""
    SELECT cluster_id, city AS cluster_city, avg(temperature) AS avg_temperature, count(*) AS reading_count
    FROM enriched JOIN (SELECT cluster_id, cluster_city AS city FROM cluster_seed) USING (cluster_id)
    WHERE date_trunc('hour', reading_ts) >= {AS_OF} - INTERVAL 24 HOUR GROUP BY ALL""", doubles="avg_temperature")
def snowflake_join(d):
    x = d.layers
    return dimensional.avg_temp_snowflake(x.fct_normalized, x.dim_device_normalized, x.dim_cluster, x.dim_time, d.as_of)


HOURLY_DOUBLES = ("avg_temperature min_temperature max_temperature stddev_temperature avg_humidity min_humidity "
                  "max_humidity avg_pressure avg_co2_level min_co2_level max_co2_level avg_battery_pct min_battery_pct")
HEALTH_DOUBLES = "avg_battery_pct min_battery_pct max_battery_pct battery_drain_rate uptime_pct"


@query("e1_hourly_readings", "SELECT * FROM hourly", doubles=HOURLY_DOUBLES)
def hourly_readings(d):
    return d.layers.hourly


@query("e2_device_health", "SELECT * FROM health", doubles=HEALTH_DOUBLES, longs="readings_expected")
def device_health(d):
    return d.layers.health


@query("e3_health_status", "SELECT health_status, count(*) AS n, min(uptime_pct) AS least FROM health GROUP BY 1",
       doubles="least")
def health_status(d):
    return d.layers.health.groupBy("health_status").agg(F.count(F.lit(1)).alias("n"), F.min("uptime_pct").alias("least"))


@query("e4_data_quality", "SELECT * FROM quality", doubles="null_pct duplicate_pct quality_score")
def data_quality(d):
    return d.layers.quality


@query("e4_data_quality_from_tables", "SELECT * FROM quality", doubles="null_pct duplicate_pct quality_score")
def data_quality_from_tables(d):
    """From the four datasets, as a user with existing tables has them."""
    x = d.settled
    return marts.data_quality(d.staged, x.deduped, x.quarantined, x.late)


NULLABLE = ("temperature", "humidity", "pressure", "battery_pct", "co2_level")


@query("e5_null_counts", "SELECT device_id, count(*) AS total_records, " + ", ".join(
    f"count(*) - count({c}) AS null_{c}" for c in NULLABLE) + " FROM staged GROUP BY 1")
def null_counts(d):
    return marts.null_counts(d.staged, NULLABLE, ["device_id"])


@query("e6_fleet_overview", "SELECT * FROM overview",
       doubles="avg_quality_score fleet_uptime_pct fleet_avg_battery")
def fleet_overview(d):
    return d.settled.overview


@query("e7_distinct_keys", "SELECT DISTINCT device_id, firmware_version, error_profile FROM staged")
def distinct_keys(d):
    return d.staged.select("device_id", "firmware_version", "error_profile").distinct()


@query("e8_raw_status", f"""
    SELECT count(*) AS total_rows, count(DISTINCT source_file) AS total_files, min(loaded_at) AS first_load,
           max(loaded_at) AS latest_load, date_diff('minute', max(loaded_at), {AS_OF} + INTERVAL 95 MINUTE)
           AS minutes_since_last FROM staged""", longs="minutes_since_last")
def raw_status(d):
    return marts.raw_status(d.staged, d.as_of + F.expr("interval 95 minutes"))


@query("e9_model_counts", """
    SELECT 'stg_sensor_readings' AS model, count(*) AS row_count FROM staged
    UNION ALL SELECT 'int_readings_deduped', count(*) FROM deduped
    UNION ALL SELECT 'int_quarantined_readings', count(*) FROM quarantined
    UNION ALL SELECT 'int_late_arriving_readings', count(*) FROM late
    UNION ALL SELECT 'fct_hourly_readings', count(*) FROM hourly
    UNION ALL SELECT 'fct_device_health', count(*) FROM health
    UNION ALL SELECT 'fct_anomalies', count(*) FROM anomalies
    UNION ALL SELECT 'fct_data_quality', count(*) FROM quality
    UNION ALL SELECT 'dim_devices', count(*) FROM devices""")
def model_counts(d):
    x = d.settled
    return marts.model_counts({
        "stg_sensor_readings": d.staged, "int_readings_deduped": x.deduped, "int_quarantined_readings": x.quarantined,
        "int_late_arriving_readings": x.late, "fct_hourly_readings": x.hourly, "fct_device_health": x.health,
        "fct_anomalies": x.anomalies, "fct_data_quality": x.quality, "dim_devices": x.dim_devices,
    })


@query("e10_duplicate_groups", """
    SELECT device_id, reading_ts, count(*) AS row_count FROM staged GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_groups(d):
    return marts.duplicate_groups(d.staged, ["device_id", "reading_ts"])


@query("e11_threshold_stats", """
    SELECT quantile_cont(quality_score, 0.05) AS p5, quantile_cont(quality_score, 0.5) AS p50,
           avg(quality_score) AS mean FROM quality""", doubles="p5 p50 mean")
def threshold_stats(d):
    return marts.threshold_stats(d.layers.quality, "quality_score", [0.05, 0.5])


@query("e11_exact_quantiles", """
    SELECT quantile_cont(temperature, 0.01) AS p1, quantile_cont(temperature, 0.5) AS p50, quantile_cont(temperature, 0.99) AS p99 FROM staged""",
       doubles="p1 p50 p99")
def exact_quantiles(d):
    """Quantiles of a raw measurement by ranks over slices of about a hundred values."""
    return sketches.exact_quantiles(d.staged, "temperature", [0.01, 0.5, 0.99], 100)


@query("e11_sketched_quantiles", """
    SELECT true AS p5_near, true AS p50_near, true AS p95_near, count(*) AS row_count FROM staged""")
def sketched_quantiles(d):
    """Sketches of days merged over the month: the true share of rows below each estimate is within the stated error."""
    merged = sketches.merge_sketches(sketches.sketch(d.staged, [F.to_date("loaded_at").alias("day")], "temperature", "device_id"))
    values, near = d.staged.filter("temperature IS NOT NULL"), []
    for p in (5, 50, 95):
        estimate = merged.select(sketches.quantile(p / 100)).scalar()
        near.append((F.abs(F.avg((F.col("temperature") < estimate).cast("double")) - p / 100) < 0.02).alias(f"p{p}_near"))
    return values.agg(*near, merged.select("rows").scalar().alias("row_count"))


@query("e13_sketched_devices", """
    SELECT CAST(loaded_at AS DATE) AS day, true AS near, count(*) AS row_count FROM staged GROUP BY 1
    UNION ALL SELECT NULL, true, count(*) FROM staged""")
def sketched_devices(d):
    """Distinct readings per day and, from the same sketches, over all days: within five standard errors of the exact counts."""
    day = F.to_date("loaded_at").alias("day")
    daily = sketches.sketch(d.staged, [day], "temperature", "reading_id")
    exact = d.staged.groupBy(day).agg(F.count_distinct("reading_id").alias("exact"))
    whole = sketches.merge_sketches(daily).withColumn("exact", d.staged.agg(F.count_distinct("reading_id")).scalar())
    both = daily.join(exact, "day").select("day", "rows", "identities", "exact").unionByName(
        whole.select(F.lit(None).cast("date").alias("day"), "rows", "identities", "exact"))
    near = F.abs(sketches.distinct() - F.col("exact")) <= F.greatest(F.col("exact") * 0.08, F.lit(1.0))
    return both.select("day", near.alias("near"), F.col("rows").alias("row_count"))


@query("e12_reaggregate", """
    SELECT cluster_id, CAST(reading_ts AS DATE) AS day, avg(temperature) AS avg_temperature, count(*) AS reading_count,
           0::BIGINT AS anomaly_count FROM enriched GROUP BY ALL""", doubles="avg_temperature")
def reaggregate(d):
    return marts.reaggregate(d.layers.hourly, ["cluster_id", F.to_date("reading_hour").alias("day")])


@query("e12_rollup_of_moments", """
    SELECT cluster_id, CAST(reading_ts AS DATE) AS day, avg(temperature) AS avg_temperature, stddev_samp(temperature) AS stddev_temperature,
           min(temperature) AS min_temperature, max(temperature) AS max_temperature, avg(pressure) AS avg_pressure,
           stddev_samp(pressure) AS stddev_pressure, min(pressure) AS min_pressure, max(pressure) AS max_pressure,
           count(*) AS reading_count, count(*) FILTER (abs(temperature_zscore) > 3) AS anomaly_count
    FROM enriched GROUP BY ALL""", doubles="avg_temperature stddev_temperature min_temperature max_temperature avg_pressure stddev_pressure min_pressure max_pressure")
def rollup_of_moments(d):
    """Days of clusters from the states of hours of devices, spreads included."""
    hours = moments.hourly_moments(d.layers.enriched)
    return moments.rollup(hours, ["cluster_id", F.to_date("reading_hour").alias("day")], ["temperature", "pressure"])


@query("e13_distinct_devices", "SELECT count(DISTINCT device_id) AS distinct_devices FROM staged")
def distinct_devices(d):
    return marts.distinct_devices(d.raw, json_field("raw_data", "device_id"))


@query("e14_null_rate_by_file", """
    SELECT source_file, count(*) AS row_count, avg((co2_level IS NULL)::INT) AS null_rate FROM staged GROUP BY 1""",
       doubles="null_rate")
def null_rate_by_file(d):
    return marts.null_rate_by_file(d.raw, json_field("raw_data", "co2_level", "double"))


@query("e15_profile_counts", "SELECT error_profile, count(*) AS row_count FROM staged GROUP BY 1")
def profile_counts(d):
    return marts.profile_counts(d.raw, json_field("raw_data", "error_profile"))


