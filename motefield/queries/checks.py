"""Data-quality checks (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..schemas import PAYLOAD_FIELDS, STAGED, struct
from .base import query
from .oracle import AS_OF
from .parsing import DRIFTED


@query("k1_not_null", "SELECT reading_id, device_id, loaded_at FROM staged WHERE temperature IS NULL")
def not_null(d):
    return quality.not_null(d.staged, "temperature").select("reading_id", "device_id", "loaded_at")


@query("k2_unique", "SELECT reading_id, count(*) AS row_count FROM staged GROUP BY 1 HAVING count(*) > 1")
def unique(d):
    return quality.unique(d.staged, "reading_id")


@query("k3_accepted_values", """
    SELECT error_profile, count(*) AS row_count FROM staged WHERE error_profile NOT IN ('none', 'normal') GROUP BY 1""")
def accepted_values(d):
    return quality.accepted_values(d.staged, "error_profile", ["none", "normal"])


@query("k4_relationships", """
    SELECT device_id, count(*) AS row_count FROM staged
    WHERE device_id NOT IN (SELECT device_id FROM registry WHERE device_type <> 'Type_A') GROUP BY 1""")
def relationships(d):
    known = d.registry.filter(F.col("device_type") != "Type_A")
    return quality.relationships(d.staged, known, "device_id").groupBy("device_id").agg(
        F.count(F.lit(1)).alias("row_count"))


@query("k5_schema_contract", """
    SELECT 'reading_ts' AS column_name, 'timestamp_ntz' AS expected_type, 'string' AS actual_type, count(*) AS row_count
    FROM staged""")
def schema_contract(d):
    """A frame whose reading time stayed text, with the rows concerned."""
    wrong = d.staged.withColumn("reading_ts", F.col("reading_ts").cast("string"))
    rows = wrong.agg(F.count(F.lit(1))).scalar()
    return quality.schema_contract(wrong, struct(STAGED)).withColumn("row_count", rows)


@query("k6_between", """
    SELECT reading_id, loaded_at, humidity FROM staged WHERE humidity < 10 OR humidity > 64""", doubles="humidity")
def between(d):
    return quality.between(d.staged, "humidity", 10, 64, F.col("humidity").isNotNull()).select(
        "reading_id", "loaded_at", "humidity")


@query("k6_between_mostly", """
    SELECT reading_id, loaded_at, pressure FROM staged WHERE pressure > 1010
      AND (SELECT avg((pressure BETWEEN 900 AND 1010)::INT) FROM staged) < 0.9
    UNION ALL
    SELECT reading_id, loaded_at, pressure FROM staged WHERE pressure > 1050
      AND (SELECT avg((pressure BETWEEN 900 AND 1050)::INT) FROM staged) < 0.9""", doubles="pressure")
def between_mostly(d):
    strict = quality.between(d.staged, "pressure", 900, 1010, mostly=0.9)
    loose = quality.between(d.staged, "pressure", 900, 1050, mostly=0.9)
    return strict.unionByName(loose).select("reading_id", "loaded_at", "pressure")


@query("k7_row_count_anomaly", f"""
    SELECT n AS current_rows, usual AS avg_rows,
           CAST(round(CAST(100 * abs(n - usual) / usual AS DECIMAL(28,10)), 2) AS DOUBLE) AS deviation_pct
    FROM (SELECT count(*) AS n FROM staged) CROSS JOIN (
        SELECT avg(c) AS usual FROM (SELECT CAST(loaded_at AS DATE) AS day, count(*) AS c FROM staged GROUP BY 1)
        WHERE day >= {AS_OF} - INTERVAL 7 DAY)""", doubles="avg_rows")
def row_count_anomaly(d):
    """The whole table against its own daily volume, which must alarm."""
    daily = d.staged.groupBy(F.to_date("loaded_at").cast("timestamp_ntz").alias("run_ts")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return quality.row_count_anomaly(d.staged, daily, d.as_of)


@query("k8_no_duplicate_readings", """
    SELECT device_id, reading_ts, count(*) AS row_count FROM deduped GROUP BY 1, 2 HAVING count(*) > 1""")
def no_duplicate_readings(d):
    return quality.no_duplicate_readings(d.layers.deduped)


@query("k9_coordinates_valid", """
    SELECT device_id, base_latitude * 3 AS base_latitude, base_longitude * 3 AS base_longitude
    FROM devices WHERE base_latitude * 3 > 90 AND firmware_version = '2.0.0'""")
def coordinates_valid(d):
    """Positions spoiled on purpose for devices with the newer firmware."""
    spoiled = d.layers.dim_devices.withColumns({
        c: F.col(c) * F.when(F.col("firmware_version") == "2.0.0", 3.0).otherwise(1.0)
        for c in ("base_latitude", "base_longitude")})
    return quality.coordinates_valid(spoiled)


@query("k10_no_future_timestamps", """
    SELECT reading_id, device_id, reading_ts, TIMESTAMP '2024-01-25 12:00:00' AS check_time FROM staged
    WHERE reading_ts > TIMESTAMP '2024-01-26 12:00:00'""")
def no_future_timestamps(d):
    return quality.no_future_timestamps(d.staged, "2024-01-25 12:00:00")


@query("k11_score_in_range", """
    SELECT quality_id, source_file, quality_score + 10 AS quality_score FROM quality WHERE quality_score > 90""",
       doubles="quality_score")
def score_in_range(d):
    """Scores raised by ten, so that good files violate the range."""
    return quality.score_in_range(d.layers.quality.withColumn("quality_score", F.col("quality_score") + 10))


@query("k12_quarantine_has_reasons", "SELECT reading_id, device_id FROM quarantined WHERE rejection_reasons = ['ZSCORE_ANOMALY']")
def quarantine_has_reasons(d):
    """With the z-score reason taken away, rows that had no other reason violate the check."""
    fewer = d.layers.quarantined.withColumn("rejection_reasons", F.array_remove("rejection_reasons", "ZSCORE_ANOMALY"))
    return quality.quarantine_has_reasons(fewer).select("reading_id", "device_id")


@query("k13_source_freshness", f"""
    SELECT max(loaded_at) AS latest_load, 45::BIGINT AS minutes_since_load, 'warn' AS status FROM staged""",
       longs="minutes_since_load")
def source_freshness(d):
    return quality.source_freshness(d.staged, d.as_of + F.expr("interval 45 minutes"))


K14 = """
    SELECT 'staged.reading_id unique' AS "check", 'error' AS severity,
           (SELECT count(*) FROM (SELECT 1 FROM staged GROUP BY reading_id HAVING count(*) > 1)) AS failing_rows,
           'fail' AS status
    UNION ALL SELECT 'deduped.reading_id unique', 'error', 0, 'pass'
    UNION ALL SELECT 'deduped.reading_id not null', 'error', 0, 'pass'
    UNION ALL SELECT 'anomalies.severity accepted', 'error', 0, 'pass'
    UNION ALL SELECT 'no future timestamps', 'warn', (SELECT count(*) FROM staged WHERE reading_ts > TIMESTAMP '2024-01-21'),
              'warn'
    UNION ALL SELECT 'score in range', 'error', 0, 'pass'"""


@query("k14_run_checks", K14)
def run_checks(d):
    x = d.settled
    return quality.run_checks([
        quality.Check("staged.reading_id unique", quality.unique(d.staged, "reading_id")),
        quality.Check("deduped.reading_id unique", quality.unique(x.deduped, "reading_id")),
        quality.Check("deduped.reading_id not null", quality.not_null(x.deduped, "reading_id")),
        quality.Check("anomalies.severity accepted",
                      quality.accepted_values(x.anomalies, "severity", ["info", "warning", "critical"])),
        quality.Check("no future timestamps", quality.no_future_timestamps(d.staged, "2024-01-20 00:00:00"), "warn"),
        quality.Check("score in range", quality.score_in_range(x.quality)),
    ])


@query("k14_fused_rules", K14)
def fused_rules(d):
    """The same checks declared as rules: one scan per table."""
    x, severity, score = d.settled, F.col("severity"), F.col("quality_score")
    return quality.run_rules({"staged": d.staged, "deduped": x.deduped, "anomalies": x.anomalies, "quality": x.quality}, [
        quality.Rule("staged.reading_id unique", "staged", unique=("reading_id",)),
        quality.Rule("deduped.reading_id unique", "deduped", unique=("reading_id",)),
        quality.Rule("deduped.reading_id not null", "deduped", F.col("reading_id").isNull()),
        quality.Rule("anomalies.severity accepted", "anomalies", ~severity.isin("info", "warning", "critical")),
        quality.Rule("no future timestamps", "staged", F.col("reading_ts") > F.lit("2024-01-21").cast("timestamp_ntz"), severity="warn"),
        quality.Rule("score in range", "quality", ~score.between(0, 100)),
    ])


@query("k15_contract_rules", """
    SELECT avg((temperature IS NULL)::INT) AS null_rate,
           (SELECT count(*) FROM (SELECT 1 FROM staged GROUP BY reading_id HAVING count(*) > 1)) AS duplicate_keys,
           avg((temperature IS NULL)::INT) < 0.05 AS null_rate_ok, false AS unique_ok FROM staged""", doubles="null_rate")
def contract_rules(d):
    return quality.contract_rules(d.staged, "temperature", 0.05, "reading_id")


@query("k16_payload_drift", f"""
    WITH seen AS (SELECT * FROM ({DRIFTED}))
    SELECT source_file, 'signal_strength' AS field, 'new' AS drift, count(*) AS row_count FROM seen
    WHERE signal_strength IS NOT NULL GROUP BY 1
    UNION ALL SELECT source_file, 'temp_celsius', 'renamed from temperature', count(*) FROM seen
    WHERE temp_celsius_renamed IS NOT NULL GROUP BY 1
    UNION ALL SELECT source_file, f, 'missing', 0 FROM (
        SELECT source_file, unnest([CASE WHEN count(co2_level) = 0 THEN 'co2_level' END,
                                    CASE WHEN count(temperature) = 0 THEN 'temperature' END,
                                    CASE WHEN count(battery_pct) = 0 THEN 'battery_pct' END]) AS f
        FROM seen GROUP BY 1) WHERE f IS NOT NULL""")
def payload_drift(d):
    return quality.payload_drift(d.raw, PAYLOAD_FIELDS, renamed={"temp_celsius": "temperature"})


