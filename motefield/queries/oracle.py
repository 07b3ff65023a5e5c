"""SQL text of the derived tables, for the engine the results are compared with."""

from __future__ import annotations

import re

from ..fixture import CLUSTERS, THRESHOLDS
from ..functions.keys import NULL_TOKEN
from ..schemas import CLUSTER_METADATA, SENSOR_THRESHOLDS, columns


def rd(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def num_text(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,6)) AS VARCHAR)"


def key(*texts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce({t}, '{NULL_TOKEN}')" for t in texts) + "))"


def limit_of(sensor: str, name: str) -> str:
    return f"(SELECT {name} FROM thresholds WHERE sensor_type = '{sensor}')"


def _valid(sensor: str, column: str) -> str:
    low, high = limit_of(sensor, "min_valid"), limit_of(sensor, "max_valid")
    return f"coalesce({column} BETWEEN {low} AND {high}, {'true' if sensor == 'co2' else 'false'})"


def _plain(values: str) -> str:
    return re.sub(r"(?<=\d)D\b", "::DOUBLE", values)


AS_OF = "(SELECT max(loaded_at) FROM staged)"
KM = 6371.0088

CTES = {
    "thresholds": f"SELECT * FROM (VALUES {_plain(THRESHOLDS)}) AS t({', '.join(columns(SENSOR_THRESHOLDS))})",
    "cluster_seed": f"SELECT * FROM (VALUES {CLUSTERS}) AS t({', '.join(columns(CLUSTER_METADATA))})",
    "registry": """
        SELECT 'DEV_' || lpad(CAST(n AS VARCHAR), 3, '0') AS device_id,
               'Sensor ' || lower(site) || '_' || lpad(CAST(n AS VARCHAR), 3, '0') AS device_name,
               ['Type_A', 'Type_B', 'Type_C'][n % 3 + 1] AS device_type,
               site AS cluster_id, 40.0::DOUBLE AS base_latitude, -74.0::DOUBLE AS base_longitude,
               CASE WHEN n <= 30 THEN DATE '2025-01-15' ELSE DATE '2025-06-01' END AS install_date
        FROM (SELECT n, ['FACTORY_A', 'FACTORY_B', 'WAREHOUSE_A', 'WAREHOUSE_B', 'OUTDOOR'][(n - 1) // 10 + 1] AS site
              FROM range(1, 51) AS r(n))""",
    "ev": """
        SELECT event_id AS e, ts, user_id % 50 + 1 AS dev, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "readings": """
        SELECT e, 'R' || e AS reading_id, 'DEV_' || lpad(CAST(dev AS VARCHAR), 3, '0') AS device_id, ts AS reading_ts,
               CASE WHEN e % 31 = 0 THEN NULL WHEN e % 37 = 0 THEN 75.0::DOUBLE + k ELSE value / 10 END AS temperature,
               CASE WHEN e % 41 = 0 THEN 5.0::DOUBLE ELSE 40.0::DOUBLE + k / 4.0::DOUBLE END AS humidity,
               CASE WHEN e % 43 = 0 THEN 1100.0::DOUBLE ELSE 1000.0::DOUBLE + e % 40 END AS pressure,
               CASE WHEN e % 47 = 0 THEN NULL ELSE 100.0::DOUBLE - e % 97 END AS battery_pct,
               CASE WHEN e % 53 = 0 THEN 2500.0::DOUBLE
                    WHEN event_type IN ('click', 'view') THEN 400.0::DOUBLE + k * 10 END AS co2_level,
               40.0::DOUBLE + (k - 50) / 1000.0::DOUBLE AS latitude,
               -74.0::DOUBLE + (e % 100 - 50) / 1000.0::DOUBLE AS longitude,
               CASE WHEN ts < TIMESTAMP '2024-01-15' OR dev % 3 = 0 THEN '1.0.0' ELSE '2.0.0' END AS firmware_version,
               ['none', 'normal', 'high', 'chaos'][e % 4 + 1] AS error_profile,
               CAST(NULL AS DOUBLE) AS signal_strength, CAST(NULL AS VARCHAR) AS temp_celsius_renamed,
               date_trunc('hour', ts)::TIMESTAMP + to_hours(CASE WHEN e % 23 = 0 THEN 4 ELSE 1 END) AS first_load
        FROM ev""",
    "staged": """
        SELECT r.* EXCLUDE (e, first_load), first_load + to_hours(c) AS loaded_at,
               'batch_' || strftime(first_load + to_hours(c), '%Y-%m-%d_%H') || '.json' AS source_file
        FROM readings r JOIN (VALUES (0), (1)) AS copies(c) ON c = 0 OR e % 20 = 0""",
    "deduped": """
        SELECT * FROM staged
        QUALIFY row_number() OVER (PARTITION BY reading_id ORDER BY loaded_at, source_file) = 1""",
    "scored": """
        SELECT *, (temperature - avg(temperature) OVER w) / nullif(stddev_samp(temperature) OVER w, 0)
                  AS temperature_zscore
        FROM deduped
        WINDOW w AS (PARTITION BY device_id ORDER BY reading_ts, reading_id ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)""",
    "checked": f"""
        SELECT *, {_valid('temperature', 'temperature')} AS is_temperature_valid,
               {_valid('humidity', 'humidity')} AS is_humidity_valid,
               {_valid('pressure', 'pressure')} AS is_pressure_valid,
               {_valid('battery', 'battery_pct')} AS is_battery_valid,
               {_valid('co2', 'co2_level')} AS is_co2_valid,
               coalesce(abs(temperature_zscore) > 3, false) AS is_anomaly
        FROM scored""",
    "reasons": """
        SELECT *, list_filter([
                   CASE WHEN NOT is_temperature_valid THEN 'TEMPERATURE_OUT_OF_RANGE' END,
                   CASE WHEN NOT is_humidity_valid THEN 'HUMIDITY_OUT_OF_RANGE' END,
                   CASE WHEN NOT is_pressure_valid THEN 'PRESSURE_OUT_OF_RANGE' END,
                   CASE WHEN NOT is_battery_valid THEN 'BATTERY_OUT_OF_RANGE' END,
                   CASE WHEN NOT is_co2_valid THEN 'CO2_OUT_OF_RANGE' END,
                   CASE WHEN is_anomaly THEN 'ZSCORE_ANOMALY' END], lambda x: x IS NOT NULL) AS rejection_reasons
        FROM checked""",
    "validated": "SELECT *, len(rejection_reasons) AS validation_error_count FROM reasons",
    "enriched": """
        SELECT v.reading_id, v.device_id, v.reading_ts, v.temperature, v.humidity, v.pressure, v.battery_pct,
               v.co2_level, v.latitude, v.longitude, v.firmware_version, v.error_profile, v.temperature_zscore,
               v.loaded_at, v.source_file, r.device_type, r.cluster_id, r.device_name,
               hour(v.reading_ts) AS hour_of_day, strftime(v.reading_ts, '%a') AS day_of_week,
               isodow(v.reading_ts) >= 6 AS is_weekend, hour(v.reading_ts) BETWEEN 8 AND 17 AS is_business_hours
        FROM validated v LEFT JOIN registry r USING (device_id)
        WHERE v.validation_error_count = 0""",
    "quarantined": """
        SELECT * EXCLUDE (rejection_reasons), rejection_reasons, array_to_string(rejection_reasons, ',') AS reason_text
        FROM validated WHERE validation_error_count > 0""",
    "late": """
        SELECT *, date_diff('minute', reading_ts, loaded_at) AS arrival_delay_minutes FROM deduped
        WHERE date_diff('minute', reading_ts, loaded_at) > 60""",
    "metadata": """
        SELECT device_id, firmware_version, loaded_at AS last_seen_at FROM staged
        QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY loaded_at DESC, firmware_version DESC) = 1""",
    "hourly": f"""
        SELECT {key('device_id', ts_text("date_trunc('hour', reading_ts)::TIMESTAMP"))} AS hourly_reading_id, device_id,
               date_trunc('hour', reading_ts)::TIMESTAMP AS reading_hour,
               avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
               max(temperature) AS max_temperature, stddev_samp(temperature) AS stddev_temperature,
               avg(humidity) AS avg_humidity, min(humidity) AS min_humidity, max(humidity) AS max_humidity,
               avg(pressure) AS avg_pressure, avg(co2_level) AS avg_co2_level, min(co2_level) AS min_co2_level,
               max(co2_level) AS max_co2_level, avg(battery_pct) AS avg_battery_pct,
               min(battery_pct) AS min_battery_pct, count(*) AS reading_count,
               count(*) FILTER (WHERE abs(temperature_zscore) > 3) AS anomaly_count,
               any_value(cluster_id) AS cluster_id, any_value(device_type) AS device_type
        FROM enriched GROUP BY device_id, date_trunc('hour', reading_ts)""",
    "daily": f"""
        SELECT device_id, CAST(reading_ts AS DATE) AS report_date, avg(battery_pct) AS avg_battery_pct,
               min(battery_pct) AS min_battery_pct, max(battery_pct) AS max_battery_pct,
               (arg_max(battery_pct, (reading_ts, reading_id)) - arg_min(battery_pct, (reading_ts, reading_id)))
                   / nullif(date_diff('hour', min(reading_ts), max(reading_ts)), 0) AS battery_drain_rate,
               count(*) AS readings_received, {rd('count(*) / 288.0::DOUBLE * 100', 2)} AS uptime_pct,
               count(*) FILTER (WHERE battery_pct < 15) AS low, count(*) FILTER (WHERE abs(temperature_zscore) > 3) AS odd
        FROM enriched GROUP BY ALL""",
    "health": f"""
        SELECT {key('device_id', 'CAST(report_date AS VARCHAR)')} AS device_health_id,
               * EXCLUDE (low, odd), 288 AS readings_expected, low + odd AS alert_count,
               CASE WHEN uptime_pct < 50 OR min_battery_pct < 5 THEN 'critical'
                    WHEN uptime_pct < 80 OR min_battery_pct < 15 OR odd > 5 THEN 'warning'
                    ELSE 'healthy' END AS health_status
        FROM daily""",
    "sensor_rows": """
        SELECT reading_id, device_id, reading_ts, temperature_zscore, s.* FROM validated,
             LATERAL (VALUES ('temperature', temperature, is_temperature_valid AND NOT (is_anomaly AND temperature IS NOT NULL)),
                             ('humidity', humidity, is_humidity_valid), ('pressure', pressure, is_pressure_valid),
                             ('battery', battery_pct, is_battery_valid), ('co2', co2_level, is_co2_valid))
             AS s(sensor_type, observed_value, fine)""",
    "anomalies": f"""
        SELECT {key('reading_id', 'sensor_type')} AS anomaly_id, device_id, reading_ts AS detected_at,
               CASE WHEN sensor_type = 'temperature' AND abs(temperature_zscore) > 3 THEN 'zscore' ELSE 'out_of_range'
               END AS anomaly_type, sensor_type, observed_value, min_valid AS expected_min, max_valid AS expected_max,
               CASE WHEN sensor_type = 'temperature' THEN temperature_zscore END AS zscore,
               CASE WHEN observed_value < critical_low THEN 'critical'
                    WHEN observed_value > critical_high AND sensor_type <> 'battery' THEN 'critical'
                    WHEN sensor_type <> 'temperature' THEN 'warning'
                    WHEN observed_value < warning_low OR observed_value > warning_high THEN 'warning'
                    ELSE 'info' END AS severity
        FROM sensor_rows LEFT JOIN thresholds USING (sensor_type) WHERE NOT fine""",
    "per_file": """
        SELECT source_file, max(loaded_at) AS batch_ts, count(*) AS n,
               sum((temperature IS NULL)::INT + (humidity IS NULL)::INT + (pressure IS NULL)::INT
                   + (battery_pct IS NULL)::INT)::BIGINT AS nulls
        FROM staged GROUP BY source_file""",
    "file_counts": """
        SELECT f.*, d.n AS kept, coalesce(f.n - d.n, 0) AS dups, coalesce(q.n, 0) AS bad, coalesce(l.n, 0) AS late_n
        FROM per_file f
        LEFT JOIN (SELECT source_file, count(*) AS n FROM deduped GROUP BY 1) d USING (source_file)
        LEFT JOIN (SELECT source_file, count(*) AS n FROM quarantined GROUP BY 1) q USING (source_file)
        LEFT JOIN (SELECT source_file, count(*) AS n FROM late GROUP BY 1) l USING (source_file)""",
    "quality": f"""
        SELECT {key('source_file')} AS quality_id, batch_ts, source_file, n AS total_records, nulls AS null_count,
               {rd('nulls / (n * 4.0::DOUBLE) * 100', 2)} AS null_pct, dups AS duplicate_count,
               {rd('dups / n::DOUBLE * 100', 2)} AS duplicate_pct, bad AS quarantined_count,
               late_n AS late_arrival_count,
               greatest(0::DOUBLE, {rd('100 - nulls / (n * 4.0::DOUBLE) * 100 * 0.5::DOUBLE'
                        ' - dups / n::DOUBLE * 100 * 0.3::DOUBLE - bad / n::DOUBLE * 100 * 0.2::DOUBLE', 2)})
               AS quality_score
        FROM file_counts""",
    "overview": f"""
        SELECT h.report_date, h.active_devices, h.total_readings, coalesce(q.score, 100) AS avg_quality_score,
               coalesce(a.critical_alerts, 0) AS critical_alerts, coalesce(a.warning_alerts, 0) AS warning_alerts,
               h.devices_low_battery, h.devices_offline, h.fleet_uptime_pct, h.fleet_avg_battery,
               coalesce(q.bad, 0) AS total_quarantined, coalesce(q.late_n, 0) AS total_late_arrivals,
               coalesce(a.total_anomalies, 0) AS total_anomalies
        FROM (SELECT report_date, count(DISTINCT device_id) AS active_devices,
                     sum(readings_received)::BIGINT AS total_readings, {rd('avg(uptime_pct)', 2)} AS fleet_uptime_pct,
                     {rd('avg(avg_battery_pct)', 2)} AS fleet_avg_battery,
                     count(*) FILTER (WHERE min_battery_pct < 15) AS devices_low_battery,
                     count(*) FILTER (WHERE uptime_pct < 50) AS devices_offline
              FROM health GROUP BY 1) h
        LEFT JOIN (SELECT CAST(batch_ts AS DATE) AS report_date, {rd('avg(quality_score)', 2)} AS score,
                          sum(quarantined_count)::BIGINT AS bad, sum(late_arrival_count)::BIGINT AS late_n
                   FROM quality GROUP BY 1) q USING (report_date)
        LEFT JOIN (SELECT CAST(detected_at AS DATE) AS report_date,
                          count(*) FILTER (WHERE severity = 'critical') AS critical_alerts,
                          count(*) FILTER (WHERE severity = 'warning') AS warning_alerts,
                          count(*) AS total_anomalies
                   FROM anomalies GROUP BY 1) a USING (report_date)""",
    "devices": f"""
        SELECT r.*, m.firmware_version, m.last_seen_at,
               CASE WHEN m.last_seen_at IS NULL THEN 'never_seen'
                    WHEN date_diff('hour', m.last_seen_at, {AS_OF}) > 24 THEN 'offline'
                    WHEN date_diff('hour', m.last_seen_at, {AS_OF}) > 6 THEN 'inactive'
                    ELSE 'active' END AS device_status
        FROM registry r LEFT JOIN metadata m USING (device_id)""",
    "hubs": f"""
        SELECT DISTINCT reading_id, device_id, reading_ts, {key('reading_id')} AS hub_reading_hk,
               {key('device_id')} AS hub_device_hk FROM staged""",
    "versions": """
        SELECT device_id, firmware_version, cluster_id, device_type, base_latitude, base_longitude,
               reading_ts AS valid_from,
               lead(reading_ts) OVER (PARTITION BY device_id ORDER BY reading_ts, reading_id) AS valid_to
        FROM (SELECT d.*, r.cluster_id, r.device_type, r.base_latitude, r.base_longitude,
                     lag(firmware_version) OVER (PARTITION BY device_id ORDER BY reading_ts, reading_id) AS prior
              FROM deduped d LEFT JOIN registry r USING (device_id))
        WHERE prior IS NULL OR prior <> firmware_version""",
    "stream": """
        SELECT *, reading_ts + to_seconds(e % 10) AS stream_loaded, dev % 5 AS source_partition,
               row_number() OVER (PARTITION BY dev % 5 ORDER BY e) - 1 AS source_offset
        FROM (SELECT r.*, CAST(substr(device_id, 5) AS BIGINT) AS dev FROM readings r)""",
    "usage": """
        SELECT event_type AS warehouse_name, ts AS start_time, value / 1000 AS credits_used_compute,
               k / 100000.0::DOUBLE AS credits_used_cloud_services,
               value / 1000 + k / 100000.0::DOUBLE AS credits_used FROM ev""",
    "jobs": """
        SELECT 'R' || e AS query_id, ['copy into t', 'call task', 'select streamlit', 'select 1'][e % 4 + 1] AS query_text,
               CASE WHEN e % 5 = 0 THEN 'dbt' END AS query_tag, CASE WHEN e % 7 = 0 THEN 'STREAMLIT' ELSE 'U' END
               AS user_name, event_type AS warehouse_name, 'SUCCESS' AS execution_status,
               value * 1000 AS total_elapsed_time, k / 100000.0::DOUBLE AS credits_used_cloud_services,
               ts AS start_time FROM ev""",
}


def with_ctes(body: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(sql)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    own = re.sub(r"^\s*WITH\b", ",", body, count=1)  # a body with its own CTEs continues the list
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + own
