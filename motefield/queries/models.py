"""Incremental loads, history and the modelling styles (J)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import dedup, dimensional, enrich, history, marts, vault
from ..plans.layers import run_models
from ..plans.vault_load import VaultTables
from ..sources import tables
from .base import query
from .joins import DEVICE_NORMALIZED, VAULT_ANSWER, _versions
from .oracle import AS_OF, key, limit_of, num_text, rd, ts_text
from .parsing import DRIFT_KM, HASHED

CUT = "2024-01-20"


def _before(d, df):
    return df.filter(F.col("loaded_at") < F.lit(CUT).cast("timestamp_ntz"))


def _after(d, df):
    return df.filter(F.col("loaded_at") >= F.lit(CUT).cast("timestamp_ntz"))


@query("j1_merge_upsert", f"""
    SELECT reading_id, loaded_at, source_file FROM staged
    QUALIFY row_number() OVER (PARTITION BY reading_id ORDER BY (loaded_at >= TIMESTAMP '{CUT}') DESC, loaded_at,
                               source_file) = 1""")
def merge_upsert(d):
    columns = ["reading_id", "loaded_at", "source_file"]
    target = dedup.dedup(_before(d, d.staged)).select(columns)
    new = dedup.dedup(_after(d, d.staged)).select(columns)
    return history.merge_upsert(target, new, "reading_id")


@query("j2_insert_new_hub", f"""
    SELECT reading_id, {key('reading_id')} AS hub_reading_hk FROM staged GROUP BY 1
    HAVING min(loaded_at) >= TIMESTAMP '{CUT}'""")
def insert_new_hub(d):
    hub = vault.hub_sensor_reading(d.staged, d.as_of)
    known = vault.hub_sensor_reading(_before(d, d.staged), d.as_of)
    return enrich.insert_new(hub, known, "hub_reading_hk").select("reading_id", "hub_reading_hk")


@query("j3_reprocess", "SELECT reading_id, temperature FROM deduped", doubles="temperature")
def reprocess(d):
    """A range that was stored wrongly is taken from the source again."""
    good = d.layers.deduped
    spoiled = good.withColumn("temperature", F.when(
        F.col("loaded_at").between("2024-01-05", "2024-01-07"), F.lit(-1.0)).otherwise(F.col("temperature")))
    fixed = history.reprocess(spoiled, good, "loaded_at", "2024-01-05", "2024-01-07")
    return fixed.select("reading_id", "temperature")


@query("j4_scd2_versions", "SELECT * FROM versions", doubles="base_latitude base_longitude")
def scd2_versions(d):
    return _versions(d)


@query("j4_scd2_apply", f"""
    WITH states AS (
        SELECT device_id, arg_max(firmware_version, (reading_ts, reading_id)) FILTER (WHERE reading_ts < TIMESTAMP '2024-01-12')
               AS before, arg_max(firmware_version, (reading_ts, reading_id)) AS after FROM deduped GROUP BY 1)
    SELECT device_id, before AS firmware_version, TIMESTAMP '2024-01-12' AS valid_from,
           CASE WHEN before <> after THEN TIMESTAMP '2024-01-31' END AS valid_to FROM states WHERE before IS NOT NULL
    UNION ALL
    SELECT device_id, after, TIMESTAMP '2024-01-31', NULL FROM states WHERE before IS DISTINCT FROM after""")
def scd2_apply(d):
    """Two snapshot runs over the latest firmware per device."""
    def state(rows):
        last = dedup.latest_per_key(rows, "device_id", "reading_ts", ["reading_id"])
        return last.select("device_id", "firmware_version")

    readings = d.layers.deduped
    first = state(readings.filter(F.col("reading_ts") < F.lit("2024-01-12").cast("timestamp_ntz")))
    empty = first.filter(F.lit(False)).withColumns({
        "valid_from": F.lit(None).cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz")})
    once = history.scd2_apply(empty, first, "device_id", ["firmware_version"], "2024-01-12 00:00:00")
    return history.scd2_apply(once, state(readings), "device_id", ["firmware_version"], "2024-01-31 00:00:00")


@query("j4_snapshot_table", f"""
    WITH states AS (
        SELECT device_id, arg_max(firmware_version, (reading_ts, reading_id)) FILTER (WHERE reading_ts < TIMESTAMP '2024-01-12')
               AS before, arg_max(firmware_version, (reading_ts, reading_id)) AS after FROM deduped GROUP BY 1)
    SELECT device_id, before AS firmware_version, TIMESTAMP '2024-01-12' AS valid_from,
           CASE WHEN before <> after THEN TIMESTAMP '2024-01-31' END AS valid_to FROM states WHERE before IS NOT NULL
    UNION ALL
    SELECT device_id, after, TIMESTAMP '2024-01-31', NULL FROM states WHERE before IS DISTINCT FROM after""")
def snapshot_table(d):
    """The same two runs over a stored history, in which closed versions stay in their files."""
    path, readings = d.scratch("history"), d.layers.deduped
    for day, rows in ((dt.datetime(2024, 1, 12), readings.filter(F.col("reading_ts") < F.lit("2024-01-12").cast("timestamp_ntz"))), (dt.datetime(2024, 1, 31), readings)):
        last = dedup.latest_per_key(rows, "device_id", "reading_ts", ["reading_id"]).select("device_id", "firmware_version")
        history_rows = tables.snapshot_table(last, path, "device_id", ["firmware_version"], day)
    return history_rows


@query("j5_scd2_changes", "SELECT * FROM versions WHERE valid_to IS NOT NULL", doubles="base_latitude base_longitude")
def scd2_changes(d):
    return history.scd2_changes(_versions(d), "device_id")


@query("j6_hub_device", f"""
    SELECT DISTINCT {key('device_id')} AS hub_device_hk, device_id, {AS_OF} AS load_ts, 'sensor_feed' AS record_source
    FROM staged""")
def hub_device(d):
    return d.layers.hub_device


@query("j6_hub_sensor_reading", f"""
    SELECT DISTINCT {key('reading_id')} AS hub_reading_hk, reading_id, {AS_OF} AS load_ts,
           'sensor_feed' AS record_source FROM staged""")
def hub_sensor_reading(d):
    return d.layers.hub_reading


def _loaded_vault(d, *names: str) -> VaultTables:
    """Tables of the vault after three batches in load order, the second of them given twice."""
    tables = VaultTables(d.spark, d.scratch("vault"), names)
    edges = ["2024-01-10", "2024-01-20"]
    loaded = F.col("loaded_at")
    low, high = (F.lit(e).cast("timestamp_ntz") for e in edges)
    for number, part in enumerate((loaded < low, (loaded >= low) & (loaded < high), loaded >= high)):
        for _ in range(2 if number == 1 else 1):
            tables.apply(d.staged.filter(part), number, d.as_of)
    return tables


@query("j6_hubs_in_batches", f"""
    SELECT DISTINCT 'device' AS hub, {key('device_id')} AS hash_key, device_id AS business_key FROM staged
    UNION ALL SELECT DISTINCT 'reading', {key('reading_id')}, reading_id FROM staged""")
def hubs_in_batches(d):
    tables = _loaded_vault(d, "hub_device", "hub_sensor_reading")
    devices = tables.read("hub_device").select(F.lit("device").alias("hub"), F.col("hub_device_hk").alias("hash_key"), F.col("device_id").alias("business_key"))
    return devices.unionByName(tables.read("hub_sensor_reading").select(
        F.lit("reading").alias("hub"), F.col("hub_reading_hk").alias("hash_key"), F.col("reading_id").alias("business_key")))


@query("j7_link_in_batches", f"""
    SELECT {key('device_id', 'reading_id')} AS link_device_reading_hk, hub_device_hk, hub_reading_hk, reading_ts FROM hubs""")
def link_in_batches(d):
    return _loaded_vault(d, "link_device_reading").read("link_device_reading").select("link_device_reading_hk", "hub_device_hk", "hub_reading_hk", "reading_ts")


@query("j8_sat_device_in_batches", """
    SELECT DISTINCT device_id, firmware_version, error_profile FROM staged""")
def sat_device_in_batches(d):
    return _loaded_vault(d, "sat_device_details").read("sat_device_details").select("device_id", "firmware_version", "error_profile")


@query("j9_sat_reading_in_batches", "SELECT reading_id, device_id, reading_ts, temperature, battery_pct FROM deduped", doubles="temperature battery_pct")
def sat_reading_in_batches(d):
    return _loaded_vault(d, "sat_reading_metrics").read("sat_reading_metrics").select("reading_id", "device_id", "reading_ts", "temperature", "battery_pct")


@query("j10_vault_by_days", VAULT_ANSWER)
def vault_by_days(d):
    """The vault's answer from tables laid out by reading day."""
    return _loaded_vault(d, "hub_device", "link_device_reading", "sat_reading_metrics").average_temperature(d.registry, d.as_of)


@query("j7_link_device_reading", f"""
    SELECT {key('device_id', 'reading_id')} AS link_device_reading_hk, hub_device_hk, hub_reading_hk, device_id,
           reading_id, reading_ts, {AS_OF} AS load_ts, 'sensor_feed' AS record_source FROM hubs""")
def link_device_reading(d):
    return d.layers.link


@query("j8_sat_device_details", f"""
    SELECT {key('device_id', ts_text('effective_from'))} AS sat_device_details_hk, {key('device_id')} AS hub_device_hk,
           device_id, firmware_version, error_profile, {key('firmware_version', 'error_profile')} AS hashdiff,
           effective_from, {AS_OF} AS load_ts, 'sensor_feed' AS record_source
    FROM (SELECT device_id, firmware_version, error_profile, reading_ts AS effective_from FROM staged
          QUALIFY row_number() OVER (PARTITION BY device_id, firmware_version, error_profile
                                     ORDER BY reading_ts, loaded_at) = 1)""")
def sat_device_details(d):
    return d.layers.sat_device


@query("j9_sat_reading_metrics", f"""
    SELECT {key('reading_id')} AS sat_reading_metrics_hk, {key('reading_id')} AS hub_reading_hk, reading_id, device_id,
           reading_ts, temperature, humidity, pressure, battery_pct, latitude, longitude,
           {key(*[num_text(c) for c in HASHED])} AS hashdiff, {AS_OF} AS load_ts, 'sensor_feed' AS record_source
    FROM deduped""", doubles="temperature humidity pressure battery_pct latitude longitude")
def sat_reading_metrics(d):
    return d.layers.sat_reading


@query("j10_vault_avg_temp", VAULT_ANSWER)
def vault_avg_temp(d):
    x = d.layers
    return vault.dv_avg_temp(x.sat_reading, x.link, x.hub_device, d.registry, d.as_of)


def _recent(model: str) -> str:
    return f"""SELECT '{model}' AS model, cluster_id, {rd('avg(temperature)', 2)} AS avg_temperature,
               count(*) AS reading_count FROM enriched WHERE reading_ts >= {AS_OF} - INTERVAL 24 HOUR GROUP BY cluster_id"""


@query("j11_compare_models", f"""
    {_recent('star')} UNION ALL {_recent('snowflake')} UNION ALL {_recent('obt')}
    UNION ALL SELECT 'data_vault', * FROM ({VAULT_ANSWER})""")
def compare_models(d):
    x = d.layers
    return dimensional.compare_models({
        "star": dimensional.avg_temp_star(x.hourly, x.dim_devices, d.as_of),
        "snowflake": dimensional.avg_temp_snowflake(x.fct_normalized, x.dim_device_normalized, x.dim_cluster,
                                                    x.dim_time, d.as_of),
        "obt": dimensional.avg_temp_obt(x.obt, d.as_of),
        "data_vault": vault.dv_avg_temp(x.sat_reading, x.link, x.hub_device, d.registry, d.as_of),
    })


@query("j12_obt", f"""
    SELECT e.reading_id, e.device_id, e.reading_ts, e.loaded_at, e.source_file, e.temperature, e.humidity, e.pressure,
           e.battery_pct, e.latitude, e.longitude, e.firmware_version, e.error_profile, e.temperature_zscore,
           CASE WHEN abs(e.temperature_zscore) > 2 THEN 'warning' ELSE 'normal' END AS anomaly_severity,
           e.device_name, e.device_type, e.cluster_id, r.base_latitude, r.base_longitude, r.install_date,
           {limit_of('temperature', 'min_valid')} AS threshold_min, {limit_of('temperature', 'max_valid')} AS threshold_max,
           false AS is_out_of_range, e.hour_of_day, e.day_of_week, e.is_weekend, e.is_business_hours,
           date_trunc('hour', e.reading_ts)::TIMESTAMP AS reading_hour,
           date_trunc('day', e.reading_ts)::TIMESTAMP AS reading_date,
           date_trunc('week', e.reading_ts)::TIMESTAMP AS reading_week,
           date_trunc('month', e.reading_ts)::TIMESTAMP AS reading_month,
           CASE WHEN e.battery_pct >= 50 THEN 'good' WHEN e.battery_pct >= 20 THEN 'medium'
                WHEN e.battery_pct >= 10 THEN 'low' ELSE 'critical' END AS battery_status,
           {rd(DRIFT_KM, 2)} AS gps_drift_km
    FROM enriched e JOIN registry r USING (device_id)""",
       doubles="temperature humidity pressure battery_pct latitude longitude temperature_zscore", longs="hour_of_day")
def obt(d):
    return d.layers.obt


SITE = "(SELECT cluster_id, count(*) AS readings FROM enriched GROUP BY 1)"


@query("j13_dim_cluster", f"""
    SELECT {key('cluster_id')} AS cluster_sk, cluster_id, 40.0::DOUBLE AS cluster_latitude,
           -74.0::DOUBLE AS cluster_longitude, cluster_city, cluster_timezone,
           CASE WHEN cluster_id[1:7] = 'FACTORY' THEN 'Manufacturing' WHEN cluster_id[1:9] = 'WAREHOUSE' THEN 'Storage'
                ELSE 'Field' END AS cluster_category, readings
    FROM cluster_seed JOIN {SITE} USING (cluster_id)""")
def dim_cluster(d):
    """With the readings of each site."""
    counts = d.layers.enriched.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("readings"))
    return d.layers.dim_cluster.join(counts, "cluster_id")


@query("j13_dim_device_type", f"""
    SELECT {key('device_type')} AS device_type_sk, t.*, readings
    FROM (VALUES ('Type_A', 'Industrial Grade', 'high', 90, 500), ('Type_B', 'Standard', 'medium', 180, 250),
                 ('Type_C', 'Economy', 'low', 365, 100))
         AS t(device_type, type_description, accuracy_tier, calibration_interval_days, unit_cost_usd)
    JOIN (SELECT device_type, count(*) AS readings FROM enriched GROUP BY 1) USING (device_type)""",
       longs="calibration_interval_days unit_cost_usd")
def dim_device_type(d):
    """With the readings of each type."""
    counts = d.layers.enriched.groupBy("device_type").agg(F.count(F.lit(1)).alias("readings"))
    return d.layers.dim_device_type.join(counts, "device_type")


@query("j13_dim_device_normalized", DEVICE_NORMALIZED)
def dim_device_normalized(d):
    return d.layers.dim_device_normalized


@query("j14_dim_time", f"""
    SELECT {key(ts_text('hour_ts'))} AS time_sk, hour_ts,
           {', '.join(f"date_trunc('{u}', hour_ts)::TIMESTAMP AS date_{u}" for u in ('day', 'week', 'month', 'quarter'))},
           year(hour_ts) AS year, month(hour_ts) AS month, day(hour_ts) AS day_of_month, hour(hour_ts) AS hour_of_day,
           strftime(hour_ts, '%a') AS day_name, dayofweek(hour_ts) AS day_of_week_num,
           isodow(hour_ts) >= 6 AS is_weekend, hour(hour_ts) BETWEEN 8 AND 17 AS is_business_hours,
           CASE WHEN hour(hour_ts) < 6 OR hour(hour_ts) > 21 THEN 'night' WHEN hour(hour_ts) < 10 THEN 'morning'
                WHEN hour(hour_ts) < 14 THEN 'midday' WHEN hour(hour_ts) < 18 THEN 'afternoon' ELSE 'evening' END
           AS time_of_day_category
    FROM (SELECT unnest(generate_series(date_trunc('hour', min(reading_ts))::TIMESTAMP,
                                        date_trunc('hour', max(reading_ts))::TIMESTAMP, INTERVAL 1 HOUR)) AS hour_ts
          FROM staged)""", longs="year month day_of_month hour_of_day day_of_week_num")
def dim_time(d):
    return d.layers.dim_time


@query("j14_fixed_spine", """
    SELECT hour_ts, hour(hour_ts) AS hour_of_day, isodow(hour_ts) >= 6 AS is_weekend, count(reading_id) AS readings
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2025-12-30 23:00:00', INTERVAL 1 HOUR)) AS hour_ts)
    LEFT JOIN staged ON date_trunc('hour', reading_ts) = hour_ts GROUP BY hour_ts""", longs="hour_of_day")
def fixed_spine(d):
    """Readings per hour of the spine of two years, hours without readings included."""
    spine = dimensional.dim_time(d.spark, "2024-01-01 00:00:00").select("hour_ts", "hour_of_day", "is_weekend")
    per_hour = d.staged.groupBy(F.date_trunc("hour", "reading_ts").cast("timestamp_ntz").alias("hour_ts")).agg(
        F.count("reading_id").alias("readings"))
    return spine.join(per_hour, "hour_ts", "left").select(
        "hour_ts", "hour_of_day", "is_weekend", F.coalesce("readings", F.lit(0)).alias("readings"))


@query("j15_fct_normalized", f"""
    SELECT reading_id, {key('device_id')} AS device_sk, {key(ts_text("date_trunc('hour', reading_ts)::TIMESTAMP"))}
           AS time_sk, temperature, humidity, pressure, battery_pct, latitude, longitude, temperature_zscore,
           firmware_version, error_profile, reading_ts, loaded_at, source_file FROM enriched""",
       doubles="temperature humidity pressure battery_pct latitude longitude temperature_zscore")
def fct_normalized(d):
    return d.layers.fct_normalized


@query("j16_dim_clusters", f"SELECT s.*, readings FROM cluster_seed s JOIN {SITE} USING (cluster_id)",
       longs="max_devices")
def dim_clusters(d):
    """With the readings of each site."""
    counts = d.layers.enriched.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("readings"))
    return d.layers.dim_clusters.join(counts, "cluster_id")


@query("j17_run_models", "SELECT * FROM overview", doubles="avg_quality_score fleet_uptime_pct fleet_avg_battery")
def run_all_models(d):
    """All tables written in order; the last of them is returned."""
    return run_models(d.spark, d.layers, d.scratch("models"))["rpt_fleet_overview"]


@query("j17_model_rows", """
    SELECT 'obt_readings' AS model, count(*) AS row_count FROM enriched UNION ALL SELECT 'fct_hourly_readings', count(*) FROM hourly
    UNION ALL SELECT 'fct_device_health', count(*) FROM health UNION ALL SELECT 'fct_anomalies', count(*) FROM anomalies
    UNION ALL SELECT 'fct_readings_normalized', count(*) FROM enriched UNION ALL SELECT 'hub_sensor_reading', count(DISTINCT reading_id) FROM staged
    UNION ALL SELECT 'hub_device', count(DISTINCT device_id) FROM staged UNION ALL SELECT 'link_device_reading', count(*) FROM hubs
    UNION ALL SELECT 'sat_reading_metrics', count(*) FROM deduped UNION ALL SELECT 'int_late_arriving_readings', count(*) FROM late""")
def model_rows(d):
    """Rows of tables of all four modelling styles after one run over the whole graph."""
    written = run_models(d.spark, d.layers, d.scratch("models"))
    names = ("obt_readings", "fct_hourly_readings", "fct_device_health", "fct_anomalies", "fct_readings_normalized", "hub_sensor_reading", "hub_device",
             "link_device_reading", "sat_reading_metrics", "int_late_arriving_readings")
    return marts.model_counts({name: written[name] for name in names})


@query("j17_selected_models", "SELECT * FROM anomalies", doubles="observed_value expected_min expected_max zscore")
def selected_models(d):
    """One table with all it is made from."""
    return run_models(d.spark, d.layers, d.scratch("models"), "+fct_anomalies")["fct_anomalies"]


@query("j18_compact", """
    SELECT device_id, firmware_version, error_profile, reading_ts FROM staged
    QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY reading_ts DESC, reading_id DESC, loaded_at DESC) = 1""")
def compact(d):
    log = d.staged.select("device_id", "firmware_version", "error_profile", "reading_ts", "reading_id", "loaded_at")
    return dedup.compact(log, "device_id", ["reading_ts", "reading_id", "loaded_at"]).drop("reading_id", "loaded_at")


