"""Facts and dimensions of the star model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.numbers import count_if, floor_at, ratio, round_to
from ..functions.rules import device_status, health_status, outside
from ..functions.timing import as_ts, boundary_diff, trunc
from ..schemas import CLUSTER_METADATA, SENSORS, columns
from .ordered import rolling
from .sketches import KLL_K, exact_quantiles, quantile
from .validation import FLAGS, threshold_bounds

EXPECTED_PER_DAY = 288  # one reading every five minutes


def hourly_readings(enriched: DataFrame) -> DataFrame:
    """Per device and hour. All aggregates combine on the map side, so a busy device costs no extra.

    Cluster and type belong to the device, so they are grouping keys: a ``max`` over text would turn the
    hash aggregate into a sort of all readings.
    """
    wide = abs_zscore_over(3)
    hour = trunc("hour", "reading_ts").alias("reading_hour")
    facts = enriched.groupBy("device_id", hour, "cluster_id", "device_type").agg(
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.stddev_samp("temperature").alias("stddev_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.min("humidity").alias("min_humidity"),
        F.max("humidity").alias("max_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("co2_level").alias("avg_co2_level"),
        F.min("co2_level").alias("min_co2_level"),
        F.max("co2_level").alias("max_co2_level"),
        F.avg("battery_pct").alias("avg_battery_pct"),
        F.min("battery_pct").alias("min_battery_pct"),
        F.count(F.lit(1)).alias("reading_count"),
        count_if(wide).alias("anomaly_count"),
    )
    measures = [c for c in facts.columns if c not in ("device_id", "reading_hour", "cluster_id", "device_type")]
    return facts.select(
        surrogate_key(facts, "device_id", "reading_hour").alias("hourly_reading_id"),
        "device_id", "reading_hour", *measures, "cluster_id", "device_type",
    )


def abs_zscore_over(k: float) -> Column:
    return F.abs(F.col("temperature_zscore")) > k


def device_health(enriched: DataFrame, expected: int = EXPECTED_PER_DAY, **split) -> DataFrame:
    """Per device and day: battery, uptime, alerts, status. Of readings at one time the id decides which is first and last.

    The first and the last reading of a day are marked in the order of the device, which rolling scores have already made, so what
    follows is a hash aggregate. ``split`` are the arguments of :func:`ordered.rolling`.
    """
    day = F.to_date("reading_ts")

    def changes(other: Column) -> Column:
        return other.isNull() | ~other["day"].eqNullSafe(day)

    marked = rolling(
        enriched.select("device_id", "reading_ts", "reading_id", "battery_pct", "temperature_zscore"), ["device_id"], "reading_ts", ["reading_id"], 1,
        {"_opens": lambda w: changes(F.lag(F.struct(day.alias("day"))).over(w)), "_closes": lambda w: changes(F.lead(F.struct(day.alias("day"))).over(w))},
        ahead=1, **split)
    daily = marked.groupBy("device_id", day.alias("report_date")).agg(
        F.avg("battery_pct").alias("avg_battery_pct"),
        F.min("battery_pct").alias("min_battery_pct"),
        F.max("battery_pct").alias("max_battery_pct"),
        (F.max(F.when(F.col("_closes"), F.col("battery_pct"))) - F.max(F.when(F.col("_opens"), F.col("battery_pct")))).alias("_drained"),
        boundary_diff("hour", F.min("reading_ts"), F.max("reading_ts")).alias("_hours"),
        F.count(F.lit(1)).alias("readings_received"),
        count_if(F.col("battery_pct") < 15).alias("_low_battery"),
        count_if(abs_zscore_over(3)).alias("_anomalies"),
    )
    scored = daily.withColumn("uptime_pct", round_to(F.col("readings_received") / F.lit(float(expected)) * 100, 2))
    return scored.select(
        surrogate_key(scored, "device_id", "report_date").alias("device_health_id"),
        "device_id",
        "report_date",
        "avg_battery_pct",
        "min_battery_pct",
        "max_battery_pct",
        ratio(F.col("_drained"), F.col("_hours")).alias("battery_drain_rate"),
        "readings_received",
        F.lit(expected).alias("readings_expected"),
        "uptime_pct",
        (F.col("_low_battery") + F.col("_anomalies")).alias("alert_count"),
        health_status(F.col("uptime_pct"), F.col("min_battery_pct"), F.col("_anomalies")).alias("health_status"),
    )


def anomalies(validated: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row per failed sensor of a reading, in a single pass over the validated rows."""
    bounds = threshold_bounds(thresholds)
    zscore = F.col("temperature_zscore")
    events = []
    for sensor, column in SENSORS.items():
        value = F.col(column)
        failed = ~F.col(FLAGS[sensor])
        critical = outside(value, bounds[f"{sensor}_critical_low"], bounds[f"{sensor}_critical_high"])
        kind, shown_zscore, milder = F.lit("out_of_range"), F.lit(None).cast("double"), F.lit("warning")
        if sensor == "temperature":
            failed = failed | (F.col("is_anomaly") & value.isNotNull())
            kind = F.when(F.abs(zscore) > 3, "zscore").otherwise(kind)
            shown_zscore = zscore
            warning = outside(value, bounds["temperature_warning_low"], bounds["temperature_warning_high"])
            milder = F.when(warning, "warning").otherwise("info")
        elif sensor == "battery":
            critical = value < bounds["battery_critical_low"]
        event = F.struct(
            F.lit(sensor).alias("sensor_type"),
            kind.alias("anomaly_type"),
            value.alias("observed_value"),
            bounds[f"{sensor}_min_valid"].alias("expected_min"),
            bounds[f"{sensor}_max_valid"].alias("expected_max"),
            shown_zscore.alias("zscore"),
            F.when(critical, "critical").otherwise(milder).alias("severity"),
        )
        events.append(F.when(failed, event))
    rows = validated.filter(F.col("validation_error_count") > 0).select(
        "reading_id", "device_id", "reading_ts", F.inline(F.array_compact(F.array(*events)))
    )
    return rows.select(
        surrogate_key(rows, "reading_id", "sensor_type").alias("anomaly_id"),
        "device_id",
        F.col("reading_ts").alias("detected_at"),
        "anomaly_type",
        "sensor_type",
        "observed_value",
        "expected_min",
        "expected_max",
        "zscore",
        "severity",
    )


def null_counts(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """NULLs per column, optionally per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        *[count_if(F.col(n).isNull()).alias(f"null_{n}") for n in names],
    )


_FIELDS = ("temperature", "humidity", "pressure", "battery_pct")


def _staged_counters(staged: DataFrame, *keep: Column) -> DataFrame:
    nulls = F.lit(0)
    for field in _FIELDS:
        nulls = nulls + F.col(field).isNull().cast("int")
    zero = F.lit(0)
    return staged.select(
        "source_file", *keep, F.col("loaded_at").alias("_loaded"), nulls.alias("_nulls"), F.lit(1).alias("_rows"),
        zero.alias("_kept"), zero.alias("_bad"), zero.alias("_late"),
    )


def _later_counters(rows: DataFrame, kept: Column, bad: Column, late: Column, *keep: Column) -> DataFrame:
    return rows.select(
        "source_file", *keep, F.lit(None).cast("timestamp_ntz").alias("_loaded"), F.lit(0).alias("_nulls"),
        F.lit(0).alias("_rows"), kept.alias("_kept"), bad.alias("_bad"), late.alias("_late"),
    )


def _summed(counters: DataFrame, *by: str) -> DataFrame:
    """One shuffle; a file with very many rows is combined on the map side."""
    sums = [F.sum(f"_{c}").alias(f"_{c}") for c in ("nulls", "rows", "kept", "bad", "late")]
    return counters.groupBy(*by).agg(F.max("_loaded").alias("_loaded"), *sums)


def scorecard(counters: DataFrame) -> DataFrame:
    """Shares and score per file from its counters."""
    summed = _summed(counters, "source_file").filter(F.col("_rows") > 0).withColumnRenamed("_loaded", "batch_ts")
    named = F.col("source_file").isNotNull()  # counts of a NULL file match nothing
    total = F.col("_rows")
    duplicates = F.when(named & (F.col("_kept") > 0), total - F.col("_kept")).otherwise(F.lit(0))
    bad = F.when(named, F.col("_bad")).otherwise(F.lit(0))
    null_share = ratio(F.col("_nulls"), total * len(_FIELDS)) * 100
    duplicate_share = ratio(duplicates, F.when(named, total)) * 100
    bad_share = ratio(bad, total) * 100
    score = round_to(100 - null_share * 0.5 - duplicate_share * 0.3 - bad_share * 0.2, 2)
    return summed.select(
        surrogate_key(summed, "source_file").alias("quality_id"),
        "batch_ts",
        "source_file",
        total.alias("total_records"),
        F.col("_nulls").alias("null_count"),
        round_to(null_share, 2).alias("null_pct"),
        duplicates.alias("duplicate_count"),
        round_to(duplicate_share, 2).alias("duplicate_pct"),
        bad.alias("quarantined_count"),
        F.when(named, F.col("_late")).otherwise(F.lit(0)).alias("late_arrival_count"),
        floor_at(score, 0.0).alias("quality_score"),
    )


def data_quality(staged: DataFrame, deduped: DataFrame, quarantined: DataFrame, late: DataFrame) -> DataFrame:
    """Scorecard per source file from the four datasets."""
    one, zero = F.lit(1), F.lit(0)
    parts = (
        _later_counters(deduped, one, zero, zero),
        _later_counters(quarantined, zero, one, zero),
        _later_counters(late, zero, zero, one),
    )
    counters = _staged_counters(staged)
    for part in parts:
        counters = counters.unionByName(part)
    return scorecard(counters)


def _both_counters(staged: DataFrame, validated: DataFrame, late_minutes: int, *keep: Column) -> DataFrame:
    bad = (F.col("validation_error_count") > 0).cast("int")
    delay = boundary_diff("minute", "reading_ts", "loaded_at")
    late = F.coalesce(delay > late_minutes, F.lit(False)).cast("int")
    later = _later_counters(validated, F.lit(1), bad, late, *keep)
    return _staged_counters(staged, *keep).unionByName(later)


def data_quality_of(staged: DataFrame, validated: DataFrame, late_minutes: int = 60) -> DataFrame:
    """The same scorecard from two datasets: validated rows tell kept, quarantined and late in one pass."""
    return scorecard(_both_counters(staged, validated, late_minutes))


def quality_counters(staged: DataFrame, validated: DataFrame, late_minutes: int = 60) -> DataFrame:
    """Counters per file and load day, which :func:`scorecard` adds up; a file loaded again has several days."""
    day = F.to_date("loaded_at").alias("load_day")
    return _summed(_both_counters(staged, validated, late_minutes, day), "source_file", "load_day")


def fleet_overview(health: DataFrame, quality: DataFrame, anomaly_log: DataFrame) -> DataFrame:
    """Fleet KPIs per day; days come from the health facts."""
    status = F.col("health_status")
    by_health = health.groupBy("report_date").agg(
        F.count_distinct("device_id").alias("active_devices"),
        F.sum("readings_received").alias("total_readings"),
        round_to(F.avg("uptime_pct"), 2).alias("fleet_uptime_pct"),
        round_to(F.avg("avg_battery_pct"), 2).alias("fleet_avg_battery"),
        count_if(F.col("min_battery_pct") < 15).alias("devices_low_battery"),
        count_if(F.col("uptime_pct") < 50).alias("devices_offline"),
        count_if(status == "critical").alias("critical_devices"),
        count_if(status == "warning").alias("warning_devices"),
    )
    by_quality = quality.groupBy(F.to_date("batch_ts").alias("report_date")).agg(
        round_to(F.avg("quality_score"), 2).alias("avg_quality_score"),
        F.sum("quarantined_count").alias("total_quarantined"),
        F.sum("late_arrival_count").alias("total_late_arrivals"),
    )
    by_anomaly = anomaly_log.groupBy(F.to_date("detected_at").alias("report_date")).agg(
        count_if(F.col("severity") == "critical").alias("critical_alerts"),
        count_if(F.col("severity") == "warning").alias("warning_alerts"),
        F.count(F.lit(1)).alias("total_anomalies"),
    )

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return by_health.join(by_quality, "report_date", "left").join(by_anomaly, "report_date", "left").select(
        "report_date", "active_devices", "total_readings",
        F.coalesce("avg_quality_score", F.lit(100.0)).alias("avg_quality_score"),
        or_zero("critical_alerts"), or_zero("warning_alerts"),
        "devices_low_battery", "devices_offline", "fleet_uptime_pct", "fleet_avg_battery",
        or_zero("total_quarantined"), or_zero("total_late_arrivals"), or_zero("total_anomalies"),
    )


def dim_devices(
    registry: DataFrame,
    metadata: DataFrame,
    as_of: Column | dt.datetime,
    default: Column | None = None,
) -> DataFrame:
    """Registry plus live firmware and status; a device never heard of shows ``default`` (its own id)."""
    known = registry.join(metadata.select("device_id", "firmware_version", "last_seen_at"), "device_id", "left")
    fallback = F.col("device_id") if default is None else default
    return known.select(
        *registry.columns,
        F.coalesce(F.col("firmware_version"), fallback).alias("firmware_version"),
        "last_seen_at",
        device_status(F.col("last_seen_at"), as_ts(as_of)).alias("device_status"),
    )


def dim_clusters(cluster_metadata: DataFrame) -> DataFrame:
    return cluster_metadata.select(*columns(CLUSTER_METADATA))


def reaggregate(hourly: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Averages at a coarser grain, weighted by the rows behind each of them."""
    weighted = F.sum(F.col("avg_temperature") * F.col("reading_count"))
    weight = F.sum(F.when(F.col("avg_temperature").isNotNull(), F.col("reading_count")))
    return hourly.groupBy(*keys).agg(
        ratio(weighted, weight).alias("avg_temperature"),
        F.sum("reading_count").alias("reading_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
    )


def threshold_stats(df: DataFrame, column: str, points: Sequence[float], exact: bool = True) -> DataFrame:
    """Percentiles and mean for choosing alert limits, as one row.

    Exact percentiles come from ranks over counted values, so no task holds all of them; ``exact=False`` reads a sketch instead.
    """
    if exact:
        found = exact_quantiles(df, column, points)
        return found.withColumn("mean", df.agg(F.avg(column)).scalar())
    kept = df.agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(KLL_K)).alias("quantiles"), F.avg(column).alias("mean"))
    return kept.select(*[quantile(p).alias(f"p{round(p * 100)}") for p in points], "mean")


def raw_status(raw: DataFrame, as_of: Column | dt.datetime) -> DataFrame:
    """Load totals. Files are made distinct by a grouping first, which combines on the map side."""
    per_file = raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("_n"), F.min("loaded_at").alias("_first"), F.max("loaded_at").alias("_last")
    )
    now = as_ts(as_of)
    return per_file.agg(
        F.sum("_n").alias("total_rows"),
        F.count("source_file").alias("total_files"),
        F.min("_first").alias("first_load"),
        F.max("_last").alias("latest_load"),
    ).withColumn("minutes_since_last", boundary_diff("minute", "latest_load", now))


def model_counts(models: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
             for name, df in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def distinct_devices(raw: DataFrame, device: Column, approximate: bool = False) -> DataFrame:
    how = F.approx_count_distinct(device) if approximate else F.count_distinct(device)
    return raw.agg(how.alias("distinct_devices"))


def null_rate_by_file(raw: DataFrame, field: Column) -> DataFrame:
    return raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(field.isNull().cast("int")).alias("null_rate")
    )


def profile_counts(raw: DataFrame, profile: Column) -> DataFrame:
    return raw.groupBy(profile.alias("error_profile")).agg(F.count(F.lit(1)).alias("row_count"))


def top_devices(anomaly_log: DataFrame, k: int) -> DataFrame:
    """The noisiest devices; equal counts are ordered by id."""
    per_sensor = anomaly_log.groupBy("device_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("_n"), F.max("detected_at").alias("_last")
    )
    return (
        per_sensor.groupBy("device_id")
        .agg(F.sum("_n").alias("anomaly_count"), F.count("sensor_type").alias("affected_sensors"),
             F.max("_last").alias("latest_anomaly"))
        .orderBy(F.col("anomaly_count").desc(), "device_id")
        .limit(k)
    )


def latest_n(df: DataFrame, ts: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_first(), *ties).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def order_by_status(health: DataFrame) -> DataFrame:
    rank = F.when(F.col("health_status") == "critical", 1).when(F.col("health_status") == "warning", 2).otherwise(3)
    return health.orderBy(rank, "device_id")

