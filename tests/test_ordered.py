"""Sliced windows give the result of the plain window, whatever the skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from motefield.operators import enrich, ordered

DDL = "device_id string, reading_id string, reading_ts timestamp_ntz, temperature double"
START = dt.datetime(2024, 1, 1)


def skewed_rows(seed, n=900):
    """A third of the rows on one device, a burst in one minute, equal times, missing times and keys."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = i % 3
        device = "HOT" if kind == 0 else (None if kind == 1 and i % 2 else f"D{rng.randrange(6)}")
        minute = 5000 if i % 5 == 0 else rng.randrange(20_000)
        ts = START + dt.timedelta(minutes=minute, seconds=rng.randrange(60) if i % 4 else 0)
        value = None if i % 17 == 0 else float(rng.randrange(400)) / 7
        rows.append((device, f"R{i:05d}", None if i % 41 == 0 else ts, value))
    return rows


def plain_zscore(df, n=12):
    w = Window.partitionBy("device_id").orderBy(F.col("reading_ts").asc_nulls_last(), "reading_id")
    frame = w.rowsBetween(-n, 0)
    z = (F.col("temperature") - F.avg("temperature").over(frame)) / F.nullif(
        F.stddev_samp("temperature").over(frame), F.lit(0.0))
    return df.withColumn("temperature_zscore", z)


def by_id(df, column):
    return {r["reading_id"]: r[column] for r in df.collect()}


@pytest.mark.parametrize("rows_per_slice", [3, 10, 40, 250, 100_000])
def test_zscore_is_the_same_for_every_cut(frame, rows_per_slice):
    df = frame(skewed_rows(rows_per_slice), DDL)
    want = by_id(plain_zscore(df), "temperature_zscore")
    got = by_id(ordered.rolling_zscore(df, rows_per_slice=rows_per_slice), "temperature_zscore")
    assert got == want


def test_a_wrong_profile_only_moves_the_cuts(frame):
    df = frame(skewed_rows(1), DDL)
    other = df.filter("reading_id < 'R00300'")
    got = by_id(ordered.rolling_zscore(df, rows_per_slice=20, profile=other), "temperature_zscore")
    assert got == by_id(plain_zscore(df), "temperature_zscore")


def test_previous_row_and_rolling_mean(frame):
    df = frame(skewed_rows(2), DDL)
    w = Window.partitionBy("device_id").orderBy(F.col("reading_ts").asc_nulls_last(), "reading_id")
    got = ordered.with_previous(df, "device_id", "reading_ts", ["reading_id"], {"before": "reading_id"},
                                rows_per_slice=25)
    assert by_id(got, "before") == by_id(df.withColumn("before", F.lag("reading_id").over(w)), "before")
    mean = df.withColumn("m", F.avg("temperature").over(w.rowsBetween(-11, 0)))
    assert by_id(ordered.rolling_avg(df, rows_per_slice=25), "rolling_avg") == by_id(mean, "m")


@pytest.mark.parametrize("value", [lambda i, t: t, lambda i, t: float(i % 2), lambda i, t: float("nan") if i % 3 else None])
def test_rank_counts_rows_above(frame, value):
    df = frame([(*row[:3], value(i, row[3])) for i, row in enumerate(skewed_rows(3))], DDL)
    w = Window.partitionBy("device_id").orderBy(F.col("temperature").desc_nulls_first())
    want = by_id(df.withColumn("rank", F.rank().over(w)), "rank")
    for rows_per_slice in (1, 7, 40, ordered.ROWS_PER_SLICE):
        assert by_id(ordered.rank_in(df, ["device_id"], "temperature", rows_per_slice=rows_per_slice), "rank") == want


def test_ranks_and_scores_without_a_reused_shuffle(spark):
    rows = spark.range(40_000).selectExpr("id % 3 AS g", "cast(pmod(xxhash64(id), 100000) AS double) AS m", "id")
    want = {r["id"]: r["rank"] for r in rows.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("m")))).collect()}
    stamped = rows.selectExpr("g AS device_id", "timestampadd(SECOND, cast(m AS int), TIMESTAMP_NTZ '2024-01-01 00:00:00') AS reading_ts",
                              "cast(id AS string) AS reading_id", "m AS temperature")
    scores = by_id(plain_zscore(stamped), "temperature_zscore")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranked = ordered.rank_in(rows, ["g"], "m", rows_per_slice=500)
        assert {r["id"]: r["rank"] for r in ranked.collect()} == want
        assert by_id(ordered.rolling_zscore(stamped, rows_per_slice=500), "temperature_zscore") == scores
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("rows_per_slice", [1, 4, 30])
def test_rows_on_both_sides_of_a_cut(frame, rows_per_slice):
    df = frame(skewed_rows(4, 600), DDL)
    w = Window.partitionBy("device_id").orderBy(F.col("reading_ts").asc_nulls_last(), "reading_id")
    want = df.withColumn("around", F.sum("temperature").over(w.rowsBetween(-3, 5)).cast("decimal(20,6)"))
    got = ordered.rolling(df, ["device_id"], "reading_ts", ["reading_id"], 3,
                          {"around": lambda x: F.sum("temperature").over(x.rowsBetween(-3, 5)).cast("decimal(20,6)")}, rows_per_slice, ahead=5)
    assert by_id(got, "around") == by_id(want, "around")


@pytest.mark.parametrize("prefix", ["R", "sensor-reading-of-device-", "common-" * 30])
@pytest.mark.parametrize("shape", ["steady", "burst", "one instant", "no time"])
def test_no_slice_is_much_larger_than_asked(frame, shape, prefix):
    when = {
        "steady": lambda i: START + dt.timedelta(minutes=i),
        "burst": lambda i: START + dt.timedelta(seconds=i if i < 3000 else 3000 + i * 600),
        "one instant": lambda i: START if i < 3000 else START + dt.timedelta(days=i),
        "no time": lambda i: None if i < 3000 else START + dt.timedelta(days=i),
    }[shape]
    df = frame([("HOT", f"{prefix}{i:05d}", when(i), float(i % 13)) for i in range(4000)], DDL)
    slices = ordered.Slices(df, ["device_id"], ["reading_ts", "reading_id"], rows_per_slice=100)
    largest = slices.sliced(df).groupBy("device_id", "_slice").count().agg(F.max("count")).first()[0]
    assert largest <= 200
    got = by_id(ordered.rolling_zscore(df, rows_per_slice=100), "temperature_zscore")
    assert got == by_id(plain_zscore(df), "temperature_zscore")


@pytest.mark.parametrize("rows_per_slice", [3, 40, 10**6])
def test_versions_at_the_time_of_facts(frame, rows_per_slice):
    """One device with very many versions, others with gaps, versions that start together, and facts without key or time."""
    rng = random.Random(5)
    versions = [("HOT", START + dt.timedelta(minutes=i), START + dt.timedelta(minutes=i + 1), f"v{i}") for i in range(400)]
    versions += [("D1", START, START + dt.timedelta(hours=1), "a"), ("D1", START + dt.timedelta(hours=3), None, "b"), ("D1", START + dt.timedelta(hours=3), START + dt.timedelta(hours=3), "never"),
                 (None, START, None, "no key"), ("D2", None, None, "no start")]
    facts = [(f"f{i}", rng.choice(["HOT", "HOT", "D1", "D2", None]), None if i % 19 == 0 else START + dt.timedelta(seconds=rng.randrange(-600, 26_000))) for i in range(900)]
    facts += [("same", "HOT", START + dt.timedelta(minutes=7))] * 30
    f = frame(facts, "id string, device_id string, at timestamp_ntz")
    v = frame(versions, "device_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, name string")
    got = enrich.join_as_of_version(f, v, "device_id", "at", ["name"], rows_per_slice)

    def at(device, moment):
        hits = [n for d, low, high, n in versions if d is not None and d == device and moment is not None and low is not None and low <= moment and (high is None or moment < high)]
        return hits[0] if hits else None

    assert sorted((r["id"], r["name_at_reading"]) for r in got.collect()) == sorted(((i, at(d, m)) for i, d, m in facts), key=lambda x: (x[0], x[1]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join" in plan) == (rows_per_slice < 10**6)


def test_one_device_with_ten_thousand_versions(spark):
    rows = spark.range(10_000)
    stamp = "timestampadd(MINUTE, {}, TIMESTAMP_NTZ '2024-01-01 00:00:00')"
    versions = rows.selectExpr("'D' AS device_id", stamp.format("cast(id AS int)") + " AS valid_from", stamp.format("cast(id + 1 AS int)") + " AS valid_to", "id AS name")
    facts = spark.range(50_000).selectExpr("'D' AS device_id", stamp.format("cast(id % 10000 AS int)") + " AS at", "id % 10000 AS want")
    got = enrich.join_as_of_version(facts, versions, "device_id", "at", ["name"])
    assert got.filter("NOT (name_at_reading <=> want)").isEmpty() and got.count() == 50_000
