"""Hourly facts on a stream against clocks that run ahead or behind, and the states they are merged from."""

import random
import re

from pyspark.sql import functions as F

from motefield.operators import moments
from motefield.operators.marts import hourly_readings
from motefield.sources.tables import touched_partitions
from motefield.streaming.layers import hours_of, write_hourly

DDL = ("reading_id string, device_id string, at string, temperature double, humidity double, pressure double, co2_level double, "
       "battery_pct double, temperature_zscore double, cluster_id string, device_type string")


def typed(frame, part):
    return frame(part, DDL).withColumn("reading_ts", F.col("at").cast("timestamp_ntz")).drop("at")


def shown(df):
    """Doubles at six decimals: merged moments may differ in their last bits."""
    return sorted((tuple(f"{v:.6f}" if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


def readings(seed, n):
    rng = random.Random(seed)
    times = [None, "2023-06-01 01:00:00", *(f"2024-01-{d:02d} {h:02d}:{rng.randrange(60):02d}:00" for d in (1, 2, 3) for h in (0, 5, 23)), "2030-01-01 00:00:00"]

    def value(scale):
        return None if rng.random() < 0.2 else 1e6 + rng.random() * scale

    return [(f"R{i}", rng.choice(["D1", "D2", None]), rng.choice(times), value(1e-3), value(9.0), value(1.0), value(5.0), value(2.0),
             rng.choice([0.0, -4.0, None]), rng.choice(["C1", None]), "T1") for i in range(n)]


def run(spark, frame, tmp_path, batches):
    src, store, dst, checkpoint = (str(tmp_path / name) for name in ("src", "store", "dst", "checkpoint"))
    for part in batches:
        typed(frame, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(typed(frame, part).schema).parquet(src)
        write_hourly(stream, store, dst, checkpoint).awaitTermination()
    return store, spark.read.parquet(dst).drop("report_day")


def test_no_clock_drops_a_reading(spark, frame, tmp_path):
    times = [["2024-01-02 05:10:00", "2030-01-01 00:00:00"], ["2024-01-02 05:20:00", "2023-06-01 01:00:00"], ["2024-01-02 05:30:00", None]]
    rows = [[(f"R{b}{i}", "D1", at, 20.0 + b, 40.0, 1000.0, 400.0, 90.0, 0.0, "C1", "T1") for i, at in enumerate(slice_)] for b, slice_ in enumerate(times)]
    _, got = run(spark, frame, tmp_path, rows)
    want = hourly_readings(typed(frame, [row for part in rows for row in part]))
    assert shown(got) == shown(want) and got.count() == 4


def test_disordered_batches_equal_the_full_run(spark, frame, tmp_path):
    rows = readings(1, 240)
    store, got = run(spark, frame, tmp_path, [rows[i::4] for i in range(4)])
    assert shown(got) == shown(hourly_readings(typed(frame, rows)))
    state = spark.read.parquet(f"{store}/state")
    assert "reading_id" not in state.columns  # no reading is kept, at most two states per device and hour
    assert state.groupBy(*moments.HOUR_KEYS).count().agg(F.max("count")).first()[0] <= 2


def test_a_repeated_batch_replaces_its_part(spark, frame, tmp_path, monkeypatch):
    rows = readings(2, 120)
    from motefield.streaming import layers

    calls, real = [], layers.overwrite_partitions

    def breaks_once(df, path, *by):
        real(df, path, *by)
        calls.append(path)
        if len(calls) == 3:  # the second batch has merged its state and loses its facts
            raise OSError("lost")

    monkeypatch.setattr(layers, "overwrite_partitions", breaks_once)
    src, store, dst, checkpoint = (str(tmp_path / name) for name in ("src", "store", "dst", "checkpoint"))
    for part in (rows[:60], rows[60:], []):
        if part:
            typed(frame, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(typed(frame, rows).schema).parquet(src)
        try:
            write_hourly(stream, store, dst, checkpoint).awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
    assert shown(spark.read.parquet(dst).drop("report_day")) == shown(hourly_readings(typed(frame, rows))) and len(calls) == 5


def test_a_batch_scans_only_the_days_it_touches(spark, frame, tmp_path):
    store, _ = run(spark, frame, tmp_path, [readings(3, 100)])
    new = typed(frame, [("X", "D1", "2024-01-02 05:10:00", 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, "C1", "T1")])
    days = touched_partitions(new.select(F.to_date("reading_ts").alias("report_day")), "report_day")
    before = hours_of(spark, f"{store}/state", days)
    assert re.search(r"PartitionFilters: \[[^\]]*report_day#\d+ = 2024-01-02", before._jdf.queryExecution().executedPlan().toString())
    assert {re.search(r"report_day=([^/]*)", r[0]).group(1) for r in before.select(F.input_file_name()).distinct().collect()} == {"2024-01-02"}


def test_merged_states_are_the_state_of_all_rows(spark, frame):
    rows = [(f"g{i % 3}", i % 7, None if i % 5 == 0 else 1e9 + (i * 37 % 101) / 7) for i in range(300)] + [("empty", 0, None)]
    df = frame(rows, "g string, part int, v double")
    parts = moments.moments(df, ["g", "part"], ["v"])
    got = {r["g"]: r for r in moments.merged(parts, ["g"], ["v"]).select("*", moments.stddev_samp("v").alias("s")).collect()}
    for r in df.groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        mine = got[r["g"]]
        assert (mine["v_n"], mine["v_min"], mine["v_max"]) == (r["n"], r["lo"], r["hi"])
        if r["n"]:
            assert abs(mine["v_mean"] - r["mean"]) < 1e-5 and abs(mine["s"] - r["s"]) < 1e-6 * r["s"]
    assert got["empty"]["v_mean"] is None and got["empty"]["s"] is None
