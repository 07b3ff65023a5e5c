"""Data checks. Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import ratio, round_to
from ..functions.timing import as_ts, boundary_diff
from .enrich import orphans
from .marts import duplicate_groups
from .validation import future_rows, last


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return duplicate_groups(df.filter(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their row counts."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return orphans(child, parent, key)


def schema_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type. Compares schemas only, reads no data."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {f.name: f.dataType.simpleString() for f in contract}
    rows = [
        (name, expected.get(name), actual.get(name))
        for name in sorted(actual.keys() | expected.keys())
        if actual.get(name) != expected.get(name)
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected_type string, actual_type string")


def between(df: DataFrame, column: str, low: float, high: float, when: Column | None = None,
            mostly: float = 1.0) -> DataFrame:
    """Rows outside the range; with ``mostly`` below 1 they only count if more than that share fails."""
    scope = df if when is None else df.filter(when)
    bad = ~F.coalesce(F.col(column).between(low, high), F.lit(True))
    out = scope.filter(bad)
    if mostly >= 1.0:
        return out
    share = scope.agg(F.avg((~bad).cast("double"))).scalar()
    return out.filter(share < mostly)


def row_count_anomaly(
    current: DataFrame,
    history: DataFrame,
    as_of: Column | dt.datetime,
    min_count: int = 1,
    max_deviation_pct: float = 50.0,
    days: int = 7,
) -> DataFrame:
    """One row if the row count is too low or too far from the average of ``history(run_ts, row_count)``."""
    usual = last(history, "run_ts", days, "day", as_of).filter(F.col("row_count") > 0).agg(F.avg("row_count"))
    counted = current.agg(F.count(F.lit(1)).alias("current_rows"))
    average = F.coalesce(F.nullif(usual.scalar(), F.lit(0.0)), F.col("current_rows").cast("double"))
    rows = counted.withColumn("avg_rows", average)
    deviation = round_to(ratio(100.0 * F.abs(F.col("current_rows") - F.col("avg_rows")), F.col("avg_rows")), 2)
    return rows.withColumn("deviation_pct", F.coalesce(deviation, F.lit(0.0))).filter(
        (F.col("current_rows") < min_count) | (F.col("deviation_pct") > max_deviation_pct)
    )


def coordinates_valid(devices: DataFrame) -> DataFrame:
    inside = F.col("base_latitude").between(-90, 90) & F.col("base_longitude").between(-180, 180)
    return devices.filter(~inside).select("device_id", "base_latitude", "base_longitude")


def no_duplicate_readings(deduped: DataFrame) -> DataFrame:
    return duplicate_groups(deduped, ["device_id", "reading_ts"])


def no_future_timestamps(staged: DataFrame, as_of: Column | dt.datetime) -> DataFrame:
    return future_rows(staged, as_of)


def score_in_range(quality: DataFrame) -> DataFrame:
    return between(quality, "quality_score", 0, 100).select("quality_id", "source_file", "quality_score")


def quarantine_has_reasons(quarantined: DataFrame) -> DataFrame:
    return quarantined.filter(F.size("rejection_reasons") == 0).select("reading_id", "device_id", "rejection_reasons")


def source_freshness(raw: DataFrame, as_of: Column | dt.datetime, warn: int = 30, error: int = 60) -> DataFrame:
    """Age of the latest load against two limits in minutes."""
    latest = raw.agg(F.max("loaded_at").alias("latest_load"))
    age = latest.withColumn("minutes_since_load", boundary_diff("minute", "latest_load", as_ts(as_of)))
    minutes = F.col("minutes_since_load")
    state = F.when(minutes.isNull() | (minutes > error), "error").when(minutes > warn, "warn").otherwise("pass")
    return age.withColumn("status", state)


def contract_rules(df: DataFrame, column: str, max_null_rate: float, key: str) -> DataFrame:
    """Null rate below a bound and key unique. Keys are grouped first, so no task holds all ids of the data."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count(column).alias("_set"))
    return per_key.agg(
        ratio(F.sum("_n") - F.sum("_set"), F.sum("_n")).alias("null_rate"),
        F.count(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), 1)).alias("duplicate_keys"),
    ).select(
        "null_rate",
        "duplicate_keys",
        (F.col("null_rate") < max_null_rate).alias("null_rate_ok"),
        (F.col("duplicate_keys") == 0).alias("unique_ok"),
    )


@dataclass(frozen=True)
class Check:
    """A named check with the rows that violate it."""

    name: str
    violations: DataFrame
    severity: str = "error"


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """(check, severity, failing_rows, status) for a list of checks, as one plan."""
    out = None
    for check in checks:
        count = check.violations.agg(F.count(F.lit(1)).alias("failing_rows"))
        bad = F.lit("warn" if check.severity == "warn" else "fail")
        row = count.select(
            F.lit(check.name).alias("check"),
            F.lit(check.severity).alias("severity"),
            "failing_rows",
            F.when(F.col("failing_rows") == 0, "pass").otherwise(bad).alias("status"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@dataclass(frozen=True)
class Rule:
    """A check that needs no other table: rows for which ``bad`` holds, or groups of ``unique`` columns that occur more than once."""

    name: str
    table: str
    bad: Column | None = None
    unique: tuple[str, ...] = ()
    severity: str = "error"


def _counted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The failures of all rules of one table from a single scan of it."""
    keys = list(dict.fromkeys(rule.unique for rule in rules if rule.unique))
    flags = {f"_bad{i}": rule.bad for i, rule in enumerate(rules) if not rule.unique}
    bad = [F.count(F.when(condition, 1)).alias(name) for name, condition in flags.items()]
    if not keys:
        counted = df.agg(F.lit(0).alias("_none"), *bad)
    else:
        names = list(dict.fromkeys(column for key in keys for column in key))
        # a set of grouping columns per key; rows are combined per key before the shuffle
        groups = df.groupingSets([[F.col(c) for c in key] for key in keys], *names).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"), *bad)
        ids = {key: sum(1 << (len(names) - 1 - i) for i, name in enumerate(names) if name not in key) for key in keys}
        twice = []
        for key in keys:
            known = F.lit(True)
            for column in key if len(key) == 1 else ():
                known = known & F.col(column).isNotNull()
            twice.append(F.count(F.when((F.col("_set") == ids[key]) & (F.col("_rows") > 1) & known, 1)).alias("_twice_" + "_".join(key)))
        first = F.col("_set") == ids[keys[0]]
        counted = groups.agg(*[F.coalesce(F.sum(F.when(first, F.col(name))), F.lit(0)).alias(name) for name in flags], *twice)
    rows = [F.struct(F.lit(rule.name).alias("check"), F.lit(rule.severity).alias("severity"),
                     F.col("_twice_" + "_".join(rule.unique) if rule.unique else f"_bad{i}").alias("failing_rows")) for i, rule in enumerate(rules)]
    return counted.select(F.inline(F.array(*rows)))


def run_rules(tables: dict[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(check, severity, failing_rows, status) of rules, with one scan per table whatever the number of its rules."""
    out = None
    for name in dict.fromkeys(rule.table for rule in rules):
        part = _counted(tables[name], [rule for rule in rules if rule.table == name])
        out = part if out is None else out.unionByName(part)
    status = F.when(F.col("failing_rows") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return out.withColumn("status", status)


def payload_fields(raw: DataFrame, by: Sequence[str] = ("source_file",), payload: str = "raw_data") -> DataFrame:
    """Fields seen in the payloads with their JSON type and number of rows, per load."""
    text = F.to_json(payload)
    names = F.explode(F.json_object_keys(text))
    seen = raw.select(*by, payload, names.alias("field"))
    value = F.try_variant_get(F.col(payload), F.concat(F.lit("$."), F.col("field")), "variant")
    return (
        seen.withColumn("seen_type", F.lower(F.schema_of_variant(value)))
        .groupBy(*by, "field", "seen_type")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def payload_drift(raw: DataFrame, contract: dict[str, str], by: Sequence[str] = ("source_file",),
                  renamed: dict[str, str] | None = None, payload: str = "raw_data") -> DataFrame:
    """Contract fields against seen fields per load: new, missing, renamed or type changed.

    A field counts as missing in a load when no row of it carries the field.
    """
    renamed = renamed or {}
    numbers = F.array(*[F.lit(t) for t in ("double", "bigint", "float", "int")])
    expected_map = F.create_map(*[F.lit(x) for item in contract.items() for x in item])
    rename_map = F.create_map(*[F.lit(x) for item in renamed.items() for x in item]) if renamed else None
    seen = payload_fields(raw, by, payload)
    field, kind = F.col("field"), F.col("seen_type")
    expected = F.try_element_at(expected_map, field)
    is_number = F.array_contains(numbers, kind) | kind.startswith("decimal")
    fits = (kind == "void") | (kind == expected) | ((expected == "double") & is_number)
    target = F.lit(None).cast("string") if rename_map is None else F.try_element_at(rename_map, field)
    drift = (
        F.when(target.isNotNull(), F.concat(F.lit("renamed from "), target))
        .when(expected.isNull(), "new")
        .when(~fits, "type changed")
    )
    changed = seen.withColumn("drift", drift).filter(F.col("drift").isNotNull())
    changed = changed.groupBy(*by, "field", "drift").agg(F.sum("row_count").alias("row_count"))

    fields = F.array(*[F.lit(f) for f in contract])
    known = seen.filter(expected.isNotNull()).groupBy(*by).agg(F.collect_set("field").alias("_seen"))
    gone = known.select(*by, F.explode(F.array_except(fields, "_seen")).alias("field"))
    missing = gone.select(*by, "field", F.lit("missing").alias("drift"), F.lit(0).cast("long").alias("row_count"))
    return changed.unionByName(missing)
