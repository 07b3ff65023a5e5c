"""Physical plans: what must be in them and what must not."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from motefield import fixture
from motefield.operators import dedup, enrich, marts, ordered, vault
from motefield.plans.layers import Layers
from motefield.sources import files

from conftest import SMALL


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_limits_groups_before_the_shuffle(data):
    text = plan(dedup.dedup(data.staged))
    assert re.search(r"row_number\(\), 1, Partial", text) and re.search(r"row_number\(\), 1, Final", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_facts_use_hash_aggregates_and_no_further_shuffle(data):
    for df in (data.layers.hourly, data.layers.health):
        text = plan(df)
        assert "SortAggregate" not in text and "HashAggregate" in text
        # one shuffle for dedup, one for the device window; the facts reuse the second
        assert text.count("Exchange hashpartitioning") == 2


def test_anomalies_read_the_rows_once(data):
    text = optimized(data.layers.anomalies)
    assert text.count("inline(") == 1 and "Union" not in text


def test_satellite_of_devices_has_no_window(data):
    text = plan(vault.sat_device_details(data.staged, data.as_of))
    assert "Window" not in text and "SortAggregate" not in text


def test_filters_and_columns_reach_the_files(spark):
    events = fixture.events(spark, SMALL)
    recent = events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")).groupBy("event_type").count()
    text = plan(recent)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-20T00:00)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_staged_columns_are_pruned_to_the_file(data):
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan(
        data.staged.groupBy("device_id").agg(F.count_distinct("reading_id")))


def test_a_day_reads_only_its_folders(data):
    path = data.scratch("layout")
    files.write_partitioned(data.staged, path, "reading_ts")
    day = files.read_partition(data.spark, path, dt.date(2024, 1, 10))
    text = plan(day)
    assert re.search(r"PartitionFilters: \[.*day#\d+ = 10.*\]", text)
    assert day.count() == data.staged.filter("to_date(reading_ts) = DATE'2024-01-10'").count()


def test_insert_only_load_does_not_shuffle_the_target(data):
    target = data.spark.read.parquet(f"{SMALL}/events.parquet").select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("reading_id"))
    text = optimized(enrich.insert_new(data.layers.deduped, target, "reading_id"))
    assert "LeftSemi" in text and "LeftAnti" in text


def test_hot_devices_change_the_plan_only_when_there_are_any(data):
    calm = plan(ordered.rolling_zscore(data.layers.deduped, profile=data.staged))
    busy = plan(ordered.rolling_zscore(data.layers.deduped, profile=data.staged, rows_per_slice=50))
    assert "Union" not in calm and "Union" in busy


def test_slicing_does_not_change_any_mart(data):
    cut = Layers(data.staged, data.registry, data.thresholds, data.clusters, split={"rows_per_slice": 40})
    for name in ("validated", "quality"):
        whole, sliced = getattr(data.layers, name), getattr(cut, name)
        assert whole.exceptAll(sliced).isEmpty() and sliced.exceptAll(whole).isEmpty()
    assert marts.hourly_readings(cut.enriched).count() == data.layers.hourly.count()
