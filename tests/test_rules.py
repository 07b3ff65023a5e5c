"""The semantics that are easy to get wrong, on hand-made rows."""

import datetime as dt
import decimal
import hashlib

import pytest
from pyspark.sql import functions as F

from motefield import fixture
from motefield.functions import numbers, parsing, rules, timing
from motefield.functions.geo import distance_km
from motefield.functions.keys import NULL_TOKEN, surrogate_key
from motefield.operators import dedup, dimensional, enrich, history, marts, ordered, quality, staging, validation
from motefield.schemas import STAGED, columns

T0 = dt.datetime(2024, 1, 1)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def readings(frame, rows):
    """Staged rows from dicts; what is not given is NULL."""
    names = columns(STAGED)
    base = {"temperature": 20.0, "humidity": 50.0, "pressure": 1000.0, "battery_pct": 80.0, "firmware_version": "1.0.0",
            "error_profile": "none", "loaded_at": T0 + dt.timedelta(hours=1), "source_file": "f"}
    return frame([tuple((base | r).get(n) for n in names) for r in rows], STAGED)


def test_differences_count_boundaries(spark):
    start, end = ts("2024-01-01 00:00:59"), ts("2024-01-01 01:01:00")
    assert one(spark, timing.boundary_diff("minute", start, end)) == 61
    assert one(spark, timing.boundary_diff("hour", start, end)) == 1
    assert one(spark, timing.boundary_diff("second", end, start)) == -3601


def test_sunday_is_day_zero_and_weekend(spark):
    sunday, monday = ts("2024-01-07 12:00:00"), ts("2024-01-08 12:00:00")
    assert one(spark, timing.day_number(sunday)) == 0
    assert one(spark, timing.day_name(sunday)) == "Sun"
    assert one(spark, timing.is_weekend(sunday)) is True
    assert one(spark, timing.is_weekend(monday)) is False


@pytest.mark.parametrize("hour, part", [(5, "night"), (6, "morning"), (9, "morning"), (10, "midday"), (13, "midday"),
                                        (14, "afternoon"), (17, "afternoon"), (18, "evening"), (21, "evening"),
                                        (22, "night")])
def test_part_of_day(spark, hour, part):
    assert one(spark, timing.part_of_day(ts(f"2024-01-01 {hour:02d}:30:00"))) == part


def test_rounding_is_decimal(spark):
    assert one(spark, numbers.round_to(F.lit(1.005), 2)) == 1.01
    assert one(spark, numbers.ratio(F.lit(1.0), F.lit(0))) is None
    assert one(spark, numbers.floor_at(F.lit(None).cast("double"), 0.0)) is None


def test_tolerant_parsing(spark):
    assert one(spark, parsing.try_double(F.lit("bad"))) is None
    assert one(spark, parsing.safe_numeric(F.lit("12.345"))) == decimal.Decimal("12.35")
    assert one(spark, parsing.safe_numeric(F.lit("123456789012"))) is None
    assert one(spark, parsing.try_ts(F.lit("2024-01-01T02:00:00+02:00"))) == T0
    assert one(spark, parsing.try_ts(F.lit("2024-13-01"))) is None


def test_surrogate_keys_tell_null_from_text(frame):
    rows = frame([("a", None, 1e7), ("a", NULL_TOKEN, 1e7), ("a", "", 1e7)], "x string, y string, z double")
    keys = [r[0] for r in rows.select(surrogate_key(rows, "x", "y", "z")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert keys[2] == hashlib.md5(b"a--10000000.000000").hexdigest()


def test_any_payload_shape_stages(spark, frame):
    texts = ['{"reading_id":"1","temperature":"21.5","reading_ts":"2024-01-01T00:00:00Z"}', '{"temperature":"hot"}',
             '[1,2]', '"text"', '{"temp_celsius":3.5,"signal_strength":-40,"device_id":7}']
    raw = frame([(t,) for t in texts], "t string").select(
        F.parse_json("t").alias("raw_data"), ts("2024-01-01").alias("loaded_at"), F.lit("f").alias("source_file"))
    rows = staging.stage_readings(raw).collect()
    assert rows[0]["temperature"] == 21.5 and rows[0]["reading_ts"] == T0
    assert rows[1]["temperature"] is None and rows[2]["reading_id"] is None
    assert rows[4]["temp_celsius_renamed"] == "3.5" and rows[4]["signal_strength"] == -40.0
    assert rows[4]["device_id"] == "7"


def test_missing_values_and_missing_thresholds(spark, frame):
    rows = readings(frame, [{"reading_id": "a"}, {"reading_id": "b", "temperature": None},
                            {"reading_id": "c", "co2_level": 2500.0}])
    flagged = validation.flag_ranges(rows, fixture.thresholds(spark)).orderBy("reading_id").collect()
    assert [r["is_temperature_valid"] for r in flagged] == [True, False, True]
    assert [r["is_co2_valid"] for r in flagged] == [True, True, False]
    few = fixture.thresholds(spark).filter("sensor_type NOT IN ('humidity', 'co2')")
    flagged = validation.flag_ranges(rows, few).orderBy("reading_id").collect()
    assert [r["is_humidity_valid"] for r in flagged] == [False] * 3
    assert [r["is_co2_valid"] for r in flagged] == [True, True, False]


@pytest.mark.parametrize("count, found", [(10, 0), (11, 1)])
def test_a_score_above_three_needs_eleven_rows(frame, count, found):
    rows = [{"reading_id": f"r{i:02d}", "device_id": "d", "reading_ts": T0 + dt.timedelta(minutes=i),
             "temperature": 500.0 if i == count - 1 else 20.0} for i in range(count)]
    scored = ordered.rolling_zscore(readings(frame, rows))
    assert scored.filter(ordered.flag_anomaly()).count() == found


def test_one_row_and_constant_rows_have_no_score(frame):
    rows = [{"reading_id": "a", "device_id": "x", "reading_ts": T0}] + [
        {"reading_id": f"b{i}", "device_id": "y", "reading_ts": T0 + dt.timedelta(minutes=i)} for i in range(5)]
    scored = ordered.rolling_zscore(readings(frame, rows))
    assert scored.filter("temperature_zscore IS NOT NULL").count() == 0


def test_reasons_labels_and_severities(spark, frame):
    rows = readings(frame, [
        {"reading_id": "a", "device_id": "d", "reading_ts": T0, "temperature": None, "battery_pct": None},
        {"reading_id": "b", "device_id": "e", "reading_ts": T0, "battery_pct": 150.0, "humidity": 5.0},
    ])
    validated = validation.validate(rows, fixture.thresholds(spark))
    reasons = {r["reading_id"]: r["rejection_reasons"] for r in validation.quarantine(validated, "2024-01-02").collect()}
    assert reasons == {"a": ["TEMPERATURE_OUT_OF_RANGE", "BATTERY_OUT_OF_RANGE"],
                       "b": ["HUMIDITY_OUT_OF_RANGE", "BATTERY_OUT_OF_RANGE"]}
    events = marts.anomalies(validated, fixture.thresholds(spark)).collect()
    severity = {(r["device_id"], r["sensor_type"]): r["severity"] for r in events}
    assert severity == {("d", "temperature"): "info", ("d", "battery"): "warning", ("e", "humidity"): "critical",
                        ("e", "battery"): "warning"}


def test_quality_of_lost_and_unnamed_files(frame):
    rows = readings(frame, [{"reading_id": "a", "source_file": "kept"}, {"reading_id": "b", "source_file": None},
                            {"reading_id": "a", "source_file": "lost", "loaded_at": T0 + dt.timedelta(hours=5)}])
    deduped = dedup.dedup(rows)
    none = rows.filter(F.lit(False))
    late = none.withColumn("arrival_delay_minutes", F.lit(0))
    got = {r["source_file"]: r for r in marts.data_quality(rows, deduped, none, late).collect()}
    assert got["lost"]["duplicate_count"] == 0 and got["lost"]["quality_score"] == 100.0
    assert got[None]["duplicate_pct"] is None and got[None]["quality_score"] is None


def test_device_status_and_defaults(spark, frame):
    seen = frame([("A", None), ("B", T0), ("C", T0 + dt.timedelta(hours=20)), ("D", T0 + dt.timedelta(hours=26))],
                 "device_id string, last_seen_at timestamp_ntz")
    status = seen.select("device_id", rules.device_status(F.col("last_seen_at"), ts("2024-01-02 03:00:00")).alias("s"))
    assert dict(status.collect()) == {"A": "never_seen", "B": "offline", "C": "inactive", "D": "active"}
    registry = fixture.registry(spark)
    metadata = frame([("DEV_001", "2.0.0", T0)], "device_id string, firmware_version string, last_seen_at timestamp_ntz")
    devices = marts.dim_devices(registry, metadata, "2024-01-01").filter("device_id = 'DEV_002'").first()
    assert devices["firmware_version"] == "DEV_002" and devices["device_status"] == "never_seen"
    clusters, kinds = dimensional.dim_cluster(registry), dimensional.dim_device_type(registry)
    normal = dimensional.dim_device_normalized(registry, metadata, clusters, kinds, "2024-01-01")
    assert normal.filter("device_id = 'DEV_002'").first()["firmware_version"] == "unknown"


def test_hour_spine(spark):
    spine = dimensional.dim_time(spark)
    ends = spine.agg(F.count("*"), F.min("hour_ts"), F.max("hour_ts"), F.count_distinct("time_sk")).first()
    assert tuple(ends) == (17520, dt.datetime(2025, 1, 1), dt.datetime(2026, 12, 31, 23), 17520)


def test_snapshots_close_open_and_keep(frame):
    ddl = "device_id string, firmware_version string"
    empty = frame([], f"{ddl}, valid_from timestamp_ntz, valid_to timestamp_ntz")
    first = history.scd2_apply(empty, frame([("a", "1"), ("b", "1"), ("c", None)], ddl), "device_id",
                               ["firmware_version"], "2024-01-01")
    again = history.scd2_apply(first, frame([("a", "2"), ("b", "1"), ("c", None), ("d", "1")], ddl), "device_id",
                               ["firmware_version"], "2024-02-01")
    same = history.scd2_apply(again, frame([("a", "2"), ("c", None), ("d", "1")], ddl), "device_id",
                              ["firmware_version"], "2024-03-01")
    feb = dt.datetime(2024, 2, 1)
    want = {("a", "1", T0, feb), ("a", "2", feb, None), ("b", "1", T0, None), ("c", None, T0, None),
            ("d", "1", feb, None)}
    assert {tuple(r) for r in again.collect()} == want
    assert {tuple(r) for r in same.collect()} == want


def test_versions_return_to_an_old_value(frame):
    ddl = "device_id string, firmware_version string, reading_ts timestamp_ntz, reading_id string"
    days = [T0 + dt.timedelta(days=i) for i in range(5)]
    log = frame([("d", v, day, f"r{i}") for i, (v, day) in enumerate(zip(["1", "1", "2", "1", None], days))], ddl)
    for cut in (1, 1000):
        got = history.scd2_from_log(log, "device_id", ["firmware_version"], "reading_ts", ["reading_id"],
                                    rows_per_slice=cut)
        assert {tuple(r)[1:] for r in got.collect()} == {("1", days[0], days[2]), ("2", days[2], days[3]),
                                                         ("1", days[3], days[4]), (None, days[4], None)}


def test_high_water_mark_of_an_empty_target(frame):
    rows = readings(frame, [{"reading_id": "a"}, {"reading_id": "b"}])
    assert validation.newer_than(rows, rows.filter("false"), "loaded_at", "loaded_at").count() == 2
    assert validation.newer_than(rows, rows, "loaded_at", "loaded_at").count() == 0


def test_insert_only_and_upsert(frame):
    old = frame([("a", 1), ("b", 1)], "k string, v int")
    new = frame([("b", 2), ("c", 2)], "k string, v int")
    assert set(map(tuple, enrich.insert_new(new, old, "k").collect())) == {("c", 2)}
    assert set(map(tuple, history.merge_upsert(old, new, "k").collect())) == {("a", 1), ("b", 2), ("c", 2)}


def test_row_count_without_history_passes(frame):
    rows = readings(frame, [{"reading_id": "a"}])
    empty = frame([], "run_ts timestamp_ntz, row_count bigint")
    assert quality.row_count_anomaly(rows, empty, "2024-01-02").isEmpty()
    assert quality.row_count_anomaly(rows, empty, "2024-01-02", min_count=2).count() == 1
    usual = frame([(T0, 10), (T0, 0)], "run_ts timestamp_ntz, row_count bigint")
    assert quality.row_count_anomaly(rows, usual, "2024-01-02").first()["deviation_pct"] == 90.0
    assert quality.row_count_anomaly(rows.limit(0), empty, "2024-01-02", min_count=0).isEmpty()


def test_coarser_averages_ignore_empty_hours(frame):
    hourly = frame([("c", 10.0, 1, 0), ("c", None, 9, 0), ("c", 20.0, 3, 1)],
                   "cluster_id string, avg_temperature double, reading_count bigint, anomaly_count bigint")
    assert tuple(marts.reaggregate(hourly, ["cluster_id"]).first()) == ("c", 17.5, 13, 1)


def test_golden_counts(data):
    x = data.layers
    got = [df.count() for df in (x.staged, x.deduped, x.enriched, x.quarantined, x.late, x.hourly, x.health, x.anomalies)]
    assert got == [1050, 1000, 854, 146, 44, 816, 375, 150]
    rows = x.enriched.join(data.registry.select("device_id", "base_latitude", "base_longitude"), "device_id")
    km = distance_km(F.col("latitude"), F.col("longitude"), F.col("base_latitude"), F.col("base_longitude"))
    assert str(rows.agg(F.sum(km.cast("decimal(18,6)"))).first()[0]) == "3212.386767"


def test_drain_of_readings_at_one_time_follows_the_id(frame):
    rows = [("D1", "R2", 90.0, 0), ("D1", "R1", 80.0, 0), ("D1", "R4", 60.0, 2), ("D1", "R3", 70.0, 2)]
    results = []
    for order in (rows, rows[::-1]):
        df = frame(order, "device_id string, reading_id string, battery_pct double, hours int").selectExpr(
            "*", "timestampadd(HOUR, hours, TIMESTAMP_NTZ '2024-01-02 00:00:00') AS reading_ts", "0.0D AS temperature_zscore")
        results.append(marts.device_health(df).first()["battery_drain_rate"])
    assert results == [-10.0, -10.0]


def test_hour_spine_with_a_clock_in_a_far_year(frame):
    df = frame([("2024-01-01 10:30:00",), ("9999-12-31 23:10:00",)], "at string").selectExpr("CAST(at AS TIMESTAMP_NTZ) AS reading_ts")
    spine = dimensional.dim_time_spanning(df).select("hour_ts")
    assert spine.rdd.getNumPartitions() > 1
    assert spine.count() == (dt.datetime(9999, 12, 31, 23) - dt.datetime(2024, 1, 1, 10)) // dt.timedelta(hours=1) + 1
    assert dimensional.dim_time_spanning(df.where("false")).count() == 0


def test_rounding_beyond_the_decimal_is_null(frame):
    assert [r[0] for r in frame([(1e30,), (1.005,)], "v double").select(numbers.round_to(F.col("v"), 2)).collect()] == [None, 1.01]
