"""Batches give the result of a full run, and a repeated batch changes nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from motefield.plans import incremental
from motefield.plans.incremental import LOAD_DAY, IncrementalLayers
from motefield.plans.layers import MODELS, Layers, Model, in_order, run_models, select_models
from motefield.sources.tables import is_written, remove
from motefield.streaming.rolling import DAY, stored_history

FACTS = ("validated", "hourly", "health", "anomalies", "enriched", "quarantined", "late", "obt")


def rounded(df, drop=()):
    """Doubles at six decimals: a recomputed average may differ in its last bit."""
    df = df.drop(DAY, LOAD_DAY, "batch_id", "quarantined_at", *drop)
    shown = [F.col(c).cast("decimal(28,6)").alias(c) if t == "double" else
             F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    names = sorted(df.columns)
    return {tuple(r[n] for n in names) for r in df.select(*shown).collect()}


def slices(staged, count):
    """Batches in load order."""
    hours = [r[0] for r in staged.select("loaded_at").distinct().orderBy("loaded_at").collect()]
    step = -(-len(hours) // count)
    for low in range(0, len(hours), step):
        part = hours[low:low + step]
        yield staged.filter(F.col("loaded_at").between(part[0], part[-1]))


def disordered(staged):
    """Two batches by reading, so that the second one holds readings from between those of the first."""
    odd = F.crc32("reading_id") % 2 == 1
    yield staged.filter(odd)
    yield staged.filter(~odd)


@pytest.mark.parametrize("batches", [3, "disordered"])
def test_batches_equal_the_full_run(data, batches):
    state = IncrementalLayers(data.spark, data.scratch("state"), data.registry, data.thresholds)
    parts = disordered(data.staged) if batches == "disordered" else slices(data.staged, batches)
    for number, part in enumerate(parts):
        state.apply(part, number)
        if number == 1:
            state.apply(part, number)
    for name in FACTS:
        assert rounded(state.read(name)) == rounded(getattr(data.layers, name)), name
    assert rounded(state.quality()) == rounded(data.layers.quality)
    assert rounded(state.overview()) == rounded(data.layers.overview)


def test_a_day_can_lose_its_last_valid_row(data, frame):
    """A late reading turns an earlier reading into an anomaly; the day's facts go away."""
    state = IncrementalLayers(data.spark, data.scratch("state"), data.registry, data.thresholds)
    rows = data.staged.limit(0)
    names = rows.columns

    def reading(number, day, hour, temperature):
        values = {"reading_id": f"X{number:03d}", "device_id": "DEV_001", "temperature": temperature, "humidity": 50.0,
                  "pressure": 1000.0, "battery_pct": 80.0, "latitude": 40.0, "longitude": -74.0,
                  "firmware_version": "1.0.0", "error_profile": "none", "source_file": "f"}
        values["reading_ts"] = values["loaded_at"] = dt.datetime(2024, 1, day, hour)
        return tuple(values.get(n) for n in names)

    early = [reading(i, 1, i, 20.0 + i % 2) for i in range(9)]
    spike = [reading(90, 3, 0, 59.0)]
    late = [reading(50 + i, 2, i, 20.0 + i % 2) for i in range(12)]
    state.apply(frame(early + spike, rows.schema), 0)
    assert state.read("hourly").filter("device_id = 'DEV_001' AND to_date(reading_hour) = DATE'2024-01-03'").count() == 1
    state.apply(frame(late, rows.schema), 1)
    everything = Layers(frame(early + spike + late, rows.schema), data.registry, data.thresholds, data.clusters)
    for name in FACTS:
        stored = state.read(name)  # a fact without any row has no table
        assert (set() if stored is None else rounded(stored)) == rounded(getattr(everything, name)), name
    assert rounded(state.quality()) == rounded(everything.quality)
    assert state.read("hourly").filter("to_date(reading_hour) = DATE'2024-01-03'").isEmpty()


@pytest.mark.parametrize("part", [0, 1])
def test_rescored_batches_with_missing_times_and_devices(data, frame, part):
    """Stored plus rescored rows are the full run, wherever the new rows fall."""
    from motefield.operators.enrich import without
    from motefield.operators.ordered import rolling_zscore
    from motefield.streaming.rolling import rescore
    from test_ordered import DDL, skewed_rows

    df = frame(skewed_rows(7, 400), DDL)
    chosen = (F.crc32("reading_id") % 9 == 0) if part else (F.col("reading_ts").isNull() | (F.col("reading_id") > "R00390"))
    old, new = df.filter(~chosen), df.filter(chosen)
    redone = rescore(old, new)
    merged = redone.unionByName(without(rolling_zscore(old), redone, "reading_id"))
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in rolling_zscore(df).collect()}


def test_all_models_are_written_in_order(data):
    layers = Layers(data.staged, data.registry, data.thresholds, data.clusters)
    written = run_models(data.spark, layers, data.scratch("models"))
    assert list(written) == in_order() and set(written) == set(MODELS)
    assert all(order.index(i) < order.index(name) for order in [list(written)] for name, model in MODELS.items() for i in model.inputs)
    assert written["int_readings_deduped"].count() == 1000
    assert (written["int_readings_enriched"].count() + written["int_quarantined_readings"].count()) == 1000


def test_a_selection_of_models(data):
    path = data.scratch("models")
    some = run_models(data.spark, Layers(data.staged, data.registry, data.thresholds, data.clusters), path, "+fct_anomalies")
    assert list(some) == ["int_readings_deduped", "int_readings_validated", "fct_anomalies"]
    later = Layers(data.staged.limit(0), data.registry, data.thresholds, data.clusters, now="2024-02-01 00:00:00")
    rest = run_models(data.spark, later, path, "int_readings_enriched+")  # made from the stored validated rows
    assert set(rest) == {"int_readings_enriched", "fct_hourly_readings", "fct_device_health", "obt_readings", "fct_readings_normalized", "rpt_fleet_overview"}
    assert rest["fct_hourly_readings"].count() == 816


def test_graphs_are_checked():
    graph = {"a": Model("a", ("b",)), "b": Model("b", ("c",)), "c": Model("c")}
    assert in_order(graph) == ["c", "b", "a"] and select_models("b+", models=graph) == ["b", "a"] and select_models("+b", models=graph) == ["c", "b"]
    with pytest.raises(KeyError):
        select_models("d", models=graph)
    with pytest.raises(ValueError):
        in_order(graph | {"c": Model("c", ("a",))})


def test_a_batch_reads_no_day_before_its_first(data):
    """Stored days before the first reading of a batch are pruned; only their last rows per device come from the tails."""
    path = data.scratch("state")
    state = IncrementalLayers(data.spark, path, data.registry, data.thresholds)
    state.apply(data.staged.filter("loaded_at < '2024-01-20'"), 0)
    low = dt.date(2024, 1, 15)
    history = stored_history(data.spark, f"{path}/validated", f"{path}/tails", low, ["device_id", "reading_id", "reading_ts"])
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    before = history.filter(F.to_date("reading_ts") < F.lit(low)).groupBy("device_id", F.to_date("reading_ts")).count()
    assert before.agg(F.max("count")).first()[0] <= 12
    assert not is_written(data.spark, f"{path}/merged/batch=000000000")


def test_a_batch_that_broke_off_is_finished_from_its_log(data, monkeypatch):
    state = IncrementalLayers(data.spark, data.scratch("state"), data.registry, data.thresholds)
    early = F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz")
    state.apply(data.staged.filter(early), 0)

    def lost(df, path, *by):
        remove(data.spark, f"{state.path}/validated/{DAY}=2024-01-19")
        raise OSError("lost while moving")

    with monkeypatch.context() as patched:
        patched.setattr(incremental, "overwrite_partitions", lost)
        with pytest.raises(OSError):
            state.apply(data.staged.filter(~early), 1)
    state.apply(data.staged.filter(~early), 1)
    for name in FACTS:
        assert rounded(state.read(name)) == rounded(getattr(data.layers, name)), name


def test_a_batch_finds_its_new_readings_once(data, monkeypatch):
    """Scores and cuts start from the written new readings; rows that already lie by day are written without a shuffle; what a batch keeps
    of its days is logged alone, and the logs are removed."""
    path, sources, straight, logged = data.scratch("state"), [], {}, []
    rescore, overwrite, finish = incremental.rescore, incremental.overwrite_partitions, incremental.remove

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def scored(history, new, **split):
        sources.extend(plan(df) for df in (new, split["profile"]))
        return rescore(history, new, **split)

    def written(df, target, *by, **how):
        straight[target.rsplit("/", 1)[1]] = not how.get("rebalance", True) and "Exchange hashpartitioning" not in plan(df)
        overwrite(df, target, *by, **how)

    def removed(spark, *paths):
        logged.append([(spark.read.parquet(p).count(), p) for p in paths])
        finish(spark, *paths)

    for name, instead in (("rescore", scored), ("overwrite_partitions", written), ("remove", removed)):
        monkeypatch.setattr(incremental, name, instead)
    state = IncrementalLayers(data.spark, path, data.registry, data.thresholds)
    early = F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz")
    for number, part in enumerate((data.staged.filter(early), data.staged.filter(~early))):
        state.apply(part, number)
    assert len(sources) == 4 and not any("row_number" in text or "Exchange" in text for text in sources)
    assert {name for name, free in straight.items() if free} == {"enriched", "quarantined", "late", "obt", "anomalies"}
    assert set(straight) == set(FACTS) | {"file_counters"}
    (kept, _), (changed, _), (new, _) = logged[1]
    assert logged[0][0][0] == 0 and 0 < kept < new <= changed and state.read("validated").count() == 1000
    assert not any(is_written(data.spark, p) for batch in logged for _, p in batch)


def test_writes_at_the_same_time_report_errors():
    done = []
    with pytest.raises(OSError):
        incremental.together(lambda: (_ for _ in ()).throw(OSError("lost")), lambda: done.append(1))
    assert done == [1]


def test_the_vault_loads_in_batches(data):
    """Three batches, one of them twice, give the tables of one load; a day's answer reads the folders of its days."""
    from motefield.plans.vault_load import VaultTables

    tables = VaultTables(data.spark, data.scratch("vault"))
    for number, part in enumerate(slices(data.staged, 3)):
        for _ in range(2 if number == 1 else 1):
            tables.apply(part, number, data.as_of)
    full = {"hub_device": data.layers.hub_device, "hub_sensor_reading": data.layers.hub_reading, "link_device_reading": data.layers.link,
            "sat_reading_metrics": data.layers.sat_reading}
    for name, want in full.items():
        stored = tables.read(name)
        assert rounded(stored.select(*[c for c in want.columns])) == rounded(want), name
        assert stored.count() == want.count()
    answer = tables.average_temperature(data.registry, dt.datetime(2024, 1, 20))
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert plan.count("reading_day#") > 2 and plan.count(">= 2024-01-19") >= 2, plan
    whole = vault_answer(data, dt.datetime(2024, 1, 20))
    assert rounded(answer) == rounded(whole)


def vault_answer(data, as_of):
    from motefield.operators import vault

    x = data.layers
    return vault.dv_avg_temp(x.sat_reading, x.link, x.hub_device, data.registry, as_of)
