"""Exact quantiles against sorting, sketches within their errors, rules against the checks they stand for."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from motefield.operators import marts, quality, sketches


def interpolated(values, p):
    values = sorted(values)
    place = (len(values) - 1) * p
    low = int(place)
    return values[low] + (values[min(low + 1, len(values) - 1)] - values[low]) * (place - low)


@pytest.mark.parametrize("rows_per_slice", [1, 7, 100, 10**6])
@pytest.mark.parametrize("values", [[1.0], [2.0, 1.0], [5.0] * 9, [float(i % 37) for i in range(500)], [random.Random(1).gauss(0, 1) for _ in range(700)] + [None] * 5])
def test_exact_quantiles(frame, values, rows_per_slice):
    points = [0.0, 0.05, 0.5, 0.77, 1.0]
    row = sketches.exact_quantiles(frame([(v,) for v in values], "v double"), "v", points, rows_per_slice).first()
    known = [v for v in values if v is not None]
    assert [row[f"p{round(p * 100)}"] for p in points] == pytest.approx([interpolated(known, p) for p in points], abs=1e-12)


def test_no_values(frame):
    assert tuple(sketches.exact_quantiles(frame([(None,)], "v double"), "v", [0.5]).first()) == (None,)
    assert tuple(marts.threshold_stats(frame([], "v double"), "v", [0.5]).first()) == (None, None)


def test_sketches_of_days_merge(spark):
    rows = spark.range(60_000).selectExpr("id % 30 AS day", "cast(id AS double) AS v", "cast(id % 20000 AS string) AS who")
    kept = sketches.merge_sketches(sketches.sketch(rows, ["day"], "v", "who"))
    row = kept.select("rows", *[sketches.quantile(p).alias(f"q{i}") for i, p in enumerate((0.1, 0.5, 0.9))], sketches.distinct().alias("n")).first()
    assert row["rows"] == 60_000 and abs(row["n"] - 20_000) < 20_000 * 0.08
    for i, p in enumerate((0.1, 0.5, 0.9)):
        assert abs(row[f"q{i}"] / 60_000 - p) < 0.01
    weeks = sketches.merge_sketches(sketches.sketch(rows, ["day"], "v", "who"), [F.floor(F.col("day") / 7).alias("week")])
    assert weeks.count() == 5 and weeks.agg(F.sum("rows")).first()[0] == 60_000


def test_a_sketch_near_the_exact_stats(spark):
    df = spark.range(5000).selectExpr("cast(id % 977 AS double) AS v")
    exact, near = (marts.threshold_stats(df, "v", [0.05, 0.5], exact=e).first() for e in (True, False))
    assert exact["mean"] == near["mean"] == pytest.approx(statistics.mean(i % 977 for i in range(5000)))
    assert abs(exact["p50"] - near["p50"]) < 20 and abs(exact["p5"] - near["p5"]) < 20


def test_rules_are_the_checks(spark, frame, tmp_path):
    rows = [(i % 7 if i % 11 else None, "x" if i % 3 else None, float(i), i % 2) for i in range(60)]
    frame(rows, "k int, t string, v double, part int").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    rules = [quality.Rule("k unique", "t", unique=("k",)), quality.Rule("pair unique", "t", unique=("k", "part")), quality.Rule("v unique", "t", unique=("v",)),
             quality.Rule("t set", "t", F.col("t").isNull(), severity="warn"), quality.Rule("v low", "t", F.col("v") > 50)]
    checks = [quality.Check("k unique", quality.unique(t, "k")), quality.Check("pair unique", marts.duplicate_groups(t, ["k", "part"])),
              quality.Check("v unique", quality.unique(t, "v")), quality.Check("t set", quality.not_null(t, "t"), "warn"), quality.Check("v low", t.filter("v > 50"))]
    got = quality.run_rules({"t": t}, rules)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in quality.run_checks(checks).collect()}
    plain = quality.run_rules({"t": t.filter("false")}, [rules[3], rules[4]])
    assert {tuple(r) for r in plain.collect()} == {("t set", "warn", 0, "pass"), ("v low", "error", 0, "pass")}
    none = quality.run_rules({"t": t.filter("false")}, rules)
    assert {r["failing_rows"] for r in none.collect()} == {0} and none.count() == 5
