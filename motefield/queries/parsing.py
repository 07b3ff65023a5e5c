"""Parsing, casts, filters and column rules (B, C, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixture import payload
from ..functions import parsing, rules, timing
from ..functions.geo import distance_km
from ..functions.keys import surrogate_key
from ..functions.numbers import floor_at, ratio, round_to
from ..operators import staging, validation
from ..operators.enrich import enrich
from ..operators.validation import FLAGS
from .base import MEASURES, joined, query
from .oracle import AS_OF, KM, key, limit_of, num_text, rd, ts_text

DRIFTED = """
    SELECT s.* REPLACE (CASE WHEN n % 59 = 0 THEN -50.0::DOUBLE END AS signal_strength,
                        CASE WHEN n % 61 = 0 THEN CAST(temperature AS VARCHAR) END AS temp_celsius_renamed,
                        CASE WHEN n % 61 <> 0 THEN temperature END AS temperature)
    FROM (SELECT *, CAST(substr(reading_id, 2) AS BIGINT) AS n FROM staged) s"""


@query("b1_stage_readings", f"""
    SELECT * EXCLUDE (n) REPLACE (CAST(temp_celsius_renamed AS DOUBLE) AS temp_celsius_renamed) FROM ({DRIFTED})""",
       doubles=MEASURES + " signal_strength temp_celsius_renamed")
def stage_readings(d):
    return staging.stage_readings(d.raw).withColumn(
        "temp_celsius_renamed", F.col("temp_celsius_renamed").cast("double"))


@query("b2_json_field", """
    SELECT firmware_version, error_profile, count(*) AS n, count(temperature) AS with_temperature,
           count(co2_level) AS with_co2, 0::BIGINT AS wrong_type FROM staged GROUP BY ALL""")
def json_field(d):
    field = lambda name, type_="string": parsing.json_field("raw_data", name, type_)
    return d.raw_plain.groupBy(
        field("firmware_version").alias("firmware_version"), field("error_profile").alias("error_profile")
    ).agg(F.count(F.lit(1)).alias("n"), F.count(field("temperature", "double")).alias("with_temperature"),
          F.count(field("co2_level", "double")).alias("with_co2"),
          F.count(field("device_id", "double")).alias("wrong_type"))


@query("b3_try_double", """
    SELECT event_type, count(value) AS good, 0::BIGINT AS bad, sum(value) AS total FROM events GROUP BY 1""",
       doubles="total")
def try_double(d):
    good = parsing.try_double(F.col("value").cast("string"))
    bad = parsing.try_double(F.concat(F.lit("x"), F.col("value").cast("string")))
    return d.events.groupBy("event_type").agg(F.count(good).alias("good"), F.count(bad).alias("bad"),
                                              F.sum(good).alias("total"))


@query("b4_safe_numeric", """
    SELECT device_id, count(CAST(temperature AS DECIMAL(10,2))) AS fits,
           count(*) FILTER (WHERE abs(round(CAST(temperature AS DECIMAL(18,3)), 1)) < 10) AS fits_narrow,
           CAST(sum(CAST(CAST(temperature AS DECIMAL(18,3)) AS DECIMAL(10,2))) AS DOUBLE) AS total
    FROM staged GROUP BY 1""", doubles="total")
def safe_numeric(d):
    value = F.col("temperature").cast("decimal(18,3)")
    return d.staged.groupBy("device_id").agg(
        F.count(parsing.safe_numeric(value)).alias("fits"),
        F.count(parsing.safe_numeric(value, 2, 1)).alias("fits_narrow"),
        F.sum(parsing.safe_numeric(value)).cast("double").alias("total"),
    )


@query("b5_try_ts", "SELECT reading_id, reading_ts, CAST(NULL AS TIMESTAMP) AS broken FROM deduped")
def try_ts(d):
    text = parsing.json_field("raw_data", "reading_ts")
    rows = d.layers.deduped.select("reading_id", F.parse_json(payload(d.staged, False)).alias("raw_data"))
    return rows.select("reading_id", parsing.try_ts(text).alias("reading_ts"),
                       parsing.try_ts(F.concat(F.lit("on "), text)).alias("broken"))


@query("b6_project_raw", f"""
    SELECT reading_id, device_id, firmware_version, reading_ts, temperature, humidity, pressure, battery_pct,
           latitude, longitude, source_file, loaded_at FROM staged""",
       doubles="temperature humidity pressure battery_pct latitude longitude")
def project_raw(d):
    return staging.project_raw(d.raw_plain)


@query("b7_drift_fields", f"""
    SELECT source_file, count(signal_strength) AS with_signal, count(temp_celsius_renamed) AS renamed
    FROM ({DRIFTED}) GROUP BY 1""")
def drift_fields(d):
    return staging.stage_readings(d.raw).groupBy("source_file").agg(
        F.count("signal_strength").alias("with_signal"), F.count("temp_celsius_renamed").alias("renamed"))


@query("b8_coalesce_renamed", "SELECT reading_id, loaded_at, temperature FROM staged", doubles="temperature")
def coalesce_renamed(d):
    whole = parsing.coalesce_renamed(staging.stage_readings(d.raw), "temperature", "temp_celsius_renamed")
    return whole.select("reading_id", "loaded_at", "temperature")


@query("b9_projection", "SELECT reading_id, device_id, reading_ts, battery_pct FROM deduped", doubles="battery_pct")
def projection(d):
    return d.layers.deduped.select("reading_id", "device_id", "reading_ts", "battery_pct")


@query("b10_mask_columns", """
    SELECT reading_id, sha256(device_id) AS device_id,
           regexp_replace(firmware_version, '[0-9]', 'n', 'g') AS firmware_version FROM deduped""")
def mask_columns(d):
    rows = d.layers.deduped.select("reading_id", "device_id", "firmware_version")
    return parsing.mask_columns(rows, {"device_id": "hash", "firmware_version": "mask"})


FLAG_NAMES = ", ".join(FLAGS.values())


@query("c1_flag_ranges", f"SELECT reading_id, {FLAG_NAMES} FROM checked")
def flag_ranges(d):
    return validation.flag_ranges(d.layers.deduped, d.thresholds).select("reading_id", *FLAGS.values())


@query("c2_error_count", "SELECT validation_error_count, count(*) AS n FROM validated GROUP BY 1",
       longs="validation_error_count")
def error_count(d):
    return d.layers.validated.groupBy("validation_error_count").agg(F.count(F.lit(1)).alias("n"))


@query("c3_split_valid", """
    SELECT CASE WHEN validation_error_count = 0 THEN 'valid' ELSE 'quarantine' END AS side, device_id, count(*) AS n
    FROM validated GROUP BY ALL""")
def split_valid(d):
    valid, bad = validation.split_valid(d.layers.validated)
    sides = valid.select(F.lit("valid").alias("side"), "device_id").unionByName(
        bad.select(F.lit("quarantine").alias("side"), "device_id"))
    return sides.groupBy("side", "device_id").agg(F.count(F.lit(1)).alias("n"))


@query("c4_late_arrivals", """
    SELECT reading_id, device_id, reading_ts, loaded_at, arrival_delay_minutes, temperature, humidity, pressure,
           battery_pct, firmware_version, error_profile, source_file FROM late""",
       doubles="temperature humidity pressure battery_pct", longs="arrival_delay_minutes")
def late_arrivals(d):
    return d.layers.late


@query("c5_last_hours", f"""
    SELECT device_id, count(*) AS n FROM staged
    WHERE loaded_at >= {AS_OF} - INTERVAL 48 HOUR GROUP BY 1""")
def last_hours(d):
    return validation.last(d.staged, "loaded_at", 48, "hour", d.as_of).groupBy("device_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("c6_predicates", """
    SELECT cluster_id, count(*) FILTER (WHERE device_type IN ('Type_A', 'Type_B')) AS a_or_b,
           count(*) FILTER (WHERE cluster_id LIKE 'FACTORY%') AS factories,
           count(*) FILTER (WHERE device_name ILIKE '%WAREHOUSE%') AS warehouses,
           count(*) FILTER (WHERE temperature BETWEEN 10 AND 20) AS mild,
           count(*) FILTER (WHERE co2_level IS NULL) AS no_co2,
           count(*) FILTER (WHERE co2_level IS NOT NULL) AS has_co2 FROM enriched GROUP BY 1""")
def predicates(d):
    def hits(condition, name):
        return F.count(F.when(condition, 1)).alias(name)

    return d.layers.enriched.groupBy("cluster_id").agg(
        hits(F.col("device_type").isin("Type_A", "Type_B"), "a_or_b"),
        hits(F.col("cluster_id").like("FACTORY%"), "factories"),
        hits(F.col("device_name").ilike("%WAREHOUSE%"), "warehouses"),
        hits(F.col("temperature").between(10, 20), "mild"),
        hits(F.col("co2_level").isNull(), "no_co2"),
        hits(F.col("co2_level").isNotNull(), "has_co2"),
    )


@query("c7_future_rows", f"""
    SELECT reading_id, device_id, reading_ts, TIMESTAMP '2024-01-10' AS check_time FROM staged
    WHERE reading_ts > TIMESTAMP '2024-01-11'""")
def future_rows(d):
    return validation.future_rows(d.staged, "2024-01-10 00:00:00")


@query("c8_latest_day", """
    SELECT device_id, report_date, readings_received FROM health
    WHERE report_date = (SELECT max(report_date) FROM health)""")
def latest_day(d):
    return validation.latest_day(d.layers.health, "report_date").select("device_id", "report_date", "readings_received")


@query("c9_newer_than", """
    SELECT reading_id, loaded_at FROM staged
    WHERE loaded_at > (SELECT max(loaded_at) FROM staged WHERE loaded_at < TIMESTAMP '2024-01-20')""")
def newer_than(d):
    target = d.staged.filter(F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return validation.newer_than(d.staged, target, "loaded_at", "loaded_at").select("reading_id", "loaded_at")


def _class_sql(sensor: str, column: str) -> str:
    low, high = limit_of(sensor, "critical_low"), limit_of(sensor, "critical_high")
    wl, wh = limit_of(sensor, "warning_low"), limit_of(sensor, "warning_high")
    return (f"CASE WHEN {column} < {low} OR {column} > {high} THEN 'critical'"
            f" WHEN {column} < {wl} OR {column} > {wh} THEN 'warning' ELSE 'normal' END")


@query("h1_classify", f"""
    SELECT reading_id, {_class_sql('temperature', 'temperature')} AS temperature_class,
           {_class_sql('battery', 'battery_pct')} AS battery_class,
           {_class_sql('co2', 'co2_level')} AS co2_class FROM deduped""")
def classify(d):
    rows = d.layers.deduped
    for sensor in ("temperature", "battery", "co2"):
        rows = validation.with_severity(rows, d.thresholds, sensor, f"{sensor}_class")
    return rows.select("reading_id", "temperature_class", "battery_class", "co2_class")


@query("h2_device_status", "SELECT device_id, last_seen_at, device_status FROM devices")
def device_status(d):
    return d.layers.dim_devices.select("device_id", "last_seen_at", "device_status")


@query("h3_dim_devices", "SELECT * REPLACE (coalesce(firmware_version, device_id) AS firmware_version) FROM devices")
def dim_devices_(d):
    return d.layers.dim_devices


@query("h4_anomalies", "SELECT * FROM anomalies", doubles="observed_value expected_min expected_max zscore")
def anomalies(d):
    return d.layers.anomalies


QUARANTINE = ("reading_id, device_id, reading_ts, temperature, humidity, pressure, battery_pct, co2_level, latitude, "
              "longitude, firmware_version, error_profile, loaded_at, source_file")


@query("h5_quarantine", f"""
    SELECT {QUARANTINE}, reason_text AS rejection_reasons, validation_error_count, {AS_OF} AS quarantined_at
    FROM quarantined""", doubles=MEASURES, longs="validation_error_count")
def quarantine(d):
    return d.layers.quarantined.withColumn("rejection_reasons", joined("rejection_reasons"))


@query("h6_array_size", """
    SELECT len(rejection_reasons) AS reasons, count(*) AS n FROM quarantined GROUP BY 1""", longs="reasons")
def array_size(d):
    return d.layers.quarantined.groupBy(F.size("rejection_reasons").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query("h7_surrogate_key", f"""
    SELECT reading_id, {key('device_id', ts_text("date_trunc('hour', reading_ts)::TIMESTAMP"))} AS hour_key,
           {key('reading_id', 'CAST(CAST(reading_ts AS DATE) AS VARCHAR)', num_text('co2_level'))} AS mixed_key
    FROM deduped""")
def surrogate_key_(d):
    rows = d.layers.deduped.withColumns({"h": timing.trunc("hour", "reading_ts"), "day": F.to_date("reading_ts")})
    return rows.select("reading_id", surrogate_key(rows, "device_id", "h").alias("hour_key"),
                       surrogate_key(rows, "reading_id", "day", "co2_level").alias("mixed_key"))


HASHED = ("temperature", "humidity", "pressure", "battery_pct", "latitude", "longitude")


@query("h8_hashdiff", f"""
    SELECT reading_id, {key(*[num_text(c) for c in HASHED])} AS hashdiff FROM deduped""")
def hashdiff(d):
    rows = d.layers.deduped
    return rows.select("reading_id", surrogate_key(rows, *HASHED).alias("hashdiff"))


@query("h9_time_parts", """
    SELECT hour_of_day, day_of_week, is_weekend, is_business_hours, count(*) AS n FROM enriched GROUP BY ALL""",
       longs="hour_of_day")
def time_parts(d):
    return d.layers.enriched.groupBy("hour_of_day", "day_of_week", "is_weekend", "is_business_hours").agg(
        F.count(F.lit(1)).alias("n"))


UNITS = ("minute", "hour", "day", "week", "month", "quarter")


@query("h10_truncations", "SELECT reading_id, CAST(reading_ts AS DATE) AS as_date, " + ", ".join(
    f"date_trunc('{u}', reading_ts)::TIMESTAMP AS by_{u}" for u in UNITS) + " FROM deduped")
def truncations(d):
    return d.layers.deduped.select("reading_id", F.to_date("reading_ts").alias("as_date"),
                                   *[timing.trunc(u, "reading_ts").alias(f"by_{u}") for u in UNITS])


@query("h11_date_parts", """
    SELECT year(reading_ts) AS y, month(reading_ts) AS m, day(reading_ts) AS d, count(*) AS n FROM deduped
    GROUP BY ALL""", longs="y m d")
def date_parts(d):
    ts = F.col("reading_ts")
    return d.layers.deduped.groupBy(F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d")).agg(
        F.count(F.lit(1)).alias("n"))


@query("h12_part_of_day", """
    SELECT CASE WHEN hour(reading_ts) < 6 OR hour(reading_ts) > 21 THEN 'night' WHEN hour(reading_ts) < 10 THEN 'morning'
                WHEN hour(reading_ts) < 14 THEN 'midday' WHEN hour(reading_ts) < 18 THEN 'afternoon' ELSE 'evening' END
           AS part, count(*) AS n FROM deduped GROUP BY 1""")
def part_of_day(d):
    return d.layers.deduped.groupBy(timing.part_of_day("reading_ts").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("h13_time_difference", """
    SELECT reading_id, loaded_at, date_diff('second', reading_ts, loaded_at) AS seconds,
           date_diff('minute', reading_ts, loaded_at) AS minutes, date_diff('hour', reading_ts, loaded_at) AS hours
    FROM staged""")
def time_difference(d):
    return d.staged.select("reading_id", "loaded_at", *[
        timing.boundary_diff(u, "reading_ts", "loaded_at").alias(f"{u}s") for u in ("second", "minute", "hour")])


@query("h14_time_shift", """
    SELECT reading_id, reading_ts + INTERVAL 1 DAY AS next_day, reading_ts - INTERVAL 6 HOUR AS six_before
    FROM deduped""")
def time_shift(d):
    ts = F.col("reading_ts")
    return d.layers.deduped.select("reading_id", timing.shift(ts, "day", 1).alias("next_day"),
                                   timing.shift(ts, "hour", -6).alias("six_before"))


@query("h15_battery_band", """
    SELECT CASE WHEN battery_pct >= 50 OR battery_pct IS NULL THEN 'good' WHEN battery_pct >= 20 THEN 'medium'
                WHEN battery_pct >= 10 THEN 'low' ELSE 'critical' END AS band, count(*) AS n FROM deduped GROUP BY 1""")
def battery_band(d):
    return d.layers.deduped.groupBy(rules.battery_band(F.col("battery_pct")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))


@query("h16_zscore_band", """
    SELECT CASE WHEN abs(temperature_zscore) > 3 THEN 'critical' WHEN abs(temperature_zscore) > 2 THEN 'warning'
                ELSE 'normal' END AS band, count(*) AS n FROM scored GROUP BY 1""")
def zscore_band(d):
    return d.layers.validated.groupBy(rules.zscore_band(F.col("temperature_zscore")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * {KM} * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
            f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))")


DRIFT_KM = _haversine("latitude", "longitude", "base_latitude", "base_longitude")


@query("h17_gps_drift", f"""
    SELECT reading_id, {DRIFT_KM} AS drift_km FROM deduped JOIN registry USING (device_id)""", doubles="drift_km")
def gps_drift(d):
    rows = d.layers.deduped.join(d.registry, "device_id")
    km = distance_km(F.col("latitude"), F.col("longitude"), F.col("base_latitude"), F.col("base_longitude"))
    return rows.select("reading_id", km.alias("drift_km"))


@query("h18_math", f"""
    SELECT reading_id, {rd('temperature', 1)} AS rounded, abs(temperature - 20) AS distance,
           greatest(0::DOUBLE, temperature - 20) AS excess, temperature / nullif(e % 3, 0) AS share,
           coalesce(co2_level, -1) AS co2 FROM deduped JOIN (SELECT reading_id, e FROM readings) USING (reading_id)""",
       doubles="rounded distance excess share co2")
def math(d):
    t = F.col("temperature")
    return d.layers.deduped.select(
        "reading_id", round_to(t, 1).alias("rounded"), F.abs(t - 20).alias("distance"),
        F.coalesce(floor_at(t - 20, 0.0), F.lit(0.0)).alias("excess"),
        ratio(t, F.substring("reading_id", 2, 20).cast("long") % 3).alias("share"),
        F.coalesce("co2_level", F.lit(-1.0)).alias("co2"))


@query("h19_strings", """
    SELECT left(device_name, 10) AS preview, device_id || '/' || cluster_id AS path,
           CASE cluster_id WHEN 'FACTORY_A' THEN 'New York' WHEN 'FACTORY_B' THEN 'Los Angeles'
                WHEN 'WAREHOUSE_A' THEN 'Chicago' WHEN 'WAREHOUSE_B' THEN 'Houston' WHEN 'OUTDOOR' THEN 'Seattle'
           END AS city, device_name ILIKE '%outdoor%' AS outdoor, count(*) AS n
    FROM enriched GROUP BY ALL""")
def strings(d):
    return d.layers.enriched.groupBy(
        F.left("device_name", F.lit(10)).alias("preview"), F.concat("device_id", F.lit("/"), "cluster_id").alias("path"),
        rules.lookup(F.col("cluster_id"), rules.CLUSTER_CITY).alias("city"),
        F.col("device_name").ilike("%outdoor%").alias("outdoor"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("h20_uuid", "SELECT count(*) AS row_count, count(*) AS ids, 36::BIGINT AS id_length FROM staged")
def uuid(d):
    named = d.staged.select(F.uuid().alias("id"))
    per_id = named.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.sum("n").alias("row_count"), F.count("id").alias("ids"),
                      F.max(F.length("id")).cast("long").alias("id_length"))


@query("d1_enrich", "SELECT * FROM enriched", doubles=MEASURES + " temperature_zscore", longs="hour_of_day")
def enriched(d):
    return enrich(d.layers.validated, d.registry)


