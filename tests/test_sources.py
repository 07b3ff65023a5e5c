"""Files, tables and messages."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from motefield.functions.parsing import json_field
from motefield.operators import quality
from motefield.schemas import PAYLOAD_FIELDS, STAGED, struct
from motefield.session import shared_dir
from motefield.sources import files, messages, tables
from motefield.streaming.layers import write_deduped
from motefield.streaming import ingest, rolling
from motefield.operators.ordered import rolling_zscore

READING = {"reading_id": "r1", "device_id": "DEV_001", "reading_ts": "2024-01-01T00:00:00+00:00", "temperature": 20.5,
           "humidity": 50.0, "pressure": 1000.0, "battery_pct": 90.0, "latitude": 40.0, "longitude": -74.0,
           "firmware_version": "1.0.0", "error_profile": "none"}


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing" / "year=2024" / "month=01" / "day=01"
    (root / "hour=00").mkdir(parents=True)
    (root / "hour=01").mkdir()
    two = [READING, READING | {"reading_id": "r2", "temperature": None, "co2_level": 500.0}, READING]
    (root / "hour=00" / "batch_1.json").write_text(json.dumps(two))
    (root / "hour=01" / "batch_2.json").write_text(json.dumps([READING | {"reading_id": "r3", "new_field": 1}])[:-9])
    (root / "hour=01" / "batch_3.json").write_text(json.dumps(READING | {"reading_id": "r4"}))
    (root / "hour=01" / "notes.txt").write_text("not a batch")
    return str(tmp_path / "landing")


def test_array_files_keep_duplicates_nulls_and_go_on_past_bad_files(spark, landing):
    rows = files.read_reading_files(spark, landing).cache()
    ids = [r["reading_id"] for r in rows.orderBy("reading_id").collect()]
    assert ids == [None, "r1", "r1", "r2", "r4"]
    audit = {r["source_file"].rsplit("/", 1)[1]: r for r in files.audit_load(rows, "2024-01-01").collect()}
    assert {k: (r["rows_loaded"], r["errors_seen"], r["load_status"]) for k, r in audit.items()} == {
        "batch_1.json": (3, 0, "SUCCESS"), "batch_2.json": (0, 1, "FAILED"), "batch_3.json": (1, 0, "SUCCESS")}


def test_variant_files_keep_the_whole_payload(spark, landing):
    rows = files.read_raw_variant(spark, landing, loaded_at="2024-01-02")
    good = rows.filter("raw_data IS NOT NULL")
    assert good.count() == 4 and rows.filter(F.col(files.CORRUPT).isNotNull()).count() == 1
    assert good.agg(F.sum(json_field("raw_data", "co2_level", "double"))).first()[0] == 500.0


@pytest.mark.parametrize("text, good, bad", [
    (r'[{"a":1},{"b":"x,]\"}"},{"c":', ['{"a":1}', r'{"b":"x,]\"}"}'], ['{"c":']),
    ('[{"a":1},{bad},{"c":[1,{"d":3}]}]', ['{"a":1}', '{"c":[1,{"d":3}]}'], ["{bad}"]),
    ('[{"a":1}, {"b":2} ', ['{"a":1}', '{"b":2}'], []),
    ("[1,2,34", ["1", "2"], ["34"]), ('{"a":1, "b', [], ['{"a":1, "b']), ("[", [], ["["]), ('["unclosed, {"a":1}]', [], ['["unclosed, {"a":1}]']),
    ("", [], [""]), ('[{"a":"' + "y" * 100_000 + '"},{"b', ['{"a":"' + "y" * 100_000 + '"}'], ['{"b']),
])
def test_whole_elements_of_a_damaged_array_are_kept(frame, text, good, bad):
    rows = files.explode_payload(frame([(text, 1)], "value string, k int"), "value", "k").select(F.to_json("raw_data").alias("j"), files.CORRUPT).collect()
    assert [r["j"] for r in rows if r["j"] is not None] == good and [r[files.CORRUPT] for r in rows if r["j"] is None] == bad


def test_a_file_cut_in_its_third_element(spark, tmp_path):
    folder = tmp_path / "cut"
    folder.mkdir()
    text = json.dumps([READING | {"reading_id": f"r{i}"} for i in range(4)])
    (folder / "a.json").write_text(text[:text.index('"r2"') + 20])
    for rows in (files.read_reading_files(spark, str(folder)), files.read_raw_variant(spark, str(folder), loaded_at="2024-01-02")):
        audit = files.audit_load(rows, "2024-01-01").first()
        assert (audit["rows_loaded"], audit["rows_parsed"], audit["errors_seen"], audit["load_status"]) == (2, 3, 1, "PARTIAL")
    assert [r["reading_id"] for r in files.read_reading_files(spark, str(folder)).orderBy("reading_id").collect()] == [None, "r0", "r1"]
    dst = str(tmp_path / "raw")
    assert ingest.load_new_files(spark, str(folder), dst, str(tmp_path / "checkpoint")) == 1
    dead = spark.read.parquet(ingest.dead_letters_of(dst)).first()["value"]
    assert spark.read.parquet(dst).count() == 2 and dead.startswith('{"reading_id": "r2"')


def test_each_file_is_loaded_once(spark, landing, tmp_path):
    dst, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    assert ingest.load_new_files(spark, landing, dst, checkpoint) == 3
    assert ingest.load_new_files(spark, landing, dst, checkpoint) == 0
    (tmp_path / "landing" / "batch_9.json").write_text(json.dumps([READING | {"reading_id": "r9"}]))
    assert ingest.has_new(spark, dst, str(tmp_path / "feed"))
    assert ingest.load_new_files(spark, landing, dst, checkpoint) == 1
    assert spark.read.parquet(dst).count() == 5
    dead = spark.read.parquet(ingest.dead_letters_of(dst)).collect()
    assert [(r["source_file"].rsplit("/", 1)[1], r["value"][:1]) for r in dead] == [("batch_2.json", "[")]
    audit = {r["source_file"].rsplit("/", 1)[1]: r for r in spark.read.parquet(ingest.audit_of(dst)).collect()}
    assert {k: (r["rows_loaded"], r["load_status"], r["error_details"] is None) for k, r in audit.items()} == {
        "batch_1.json": (3, "SUCCESS", True), "batch_2.json": (0, "FAILED", False), "batch_3.json": (1, "SUCCESS", True),
        "batch_9.json": (1, "SUCCESS", True)}
    with pytest.raises(ValueError):
        ingest.replay(spark, landing, dst, str(tmp_path / "fresh"))


def test_dedup_on_a_stream_keeps_old_loads_and_far_copies(spark, frame, tmp_path):
    """A load time far behind the newest drops no reading, and a copy that comes weeks later is still a copy."""
    ddl = "reading_id string, loaded_at string, source_file string"
    src, dst, checkpoint = (str(tmp_path / name) for name in ("src", "dst", "checkpoint"))
    for part in ([("r1", "2024-03-01", "a"), ("r1", "2024-03-01", "b")], [("r2", "2024-01-01", "c")], [("r1", "2024-05-01", "d"), ("r3", None, "d")]):
        typed = frame(part, ddl).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))
        typed.write.mode("append").parquet(src)
        write_deduped(spark.readStream.schema(typed.schema).parquet(src), dst, checkpoint).awaitTermination()
    assert sorted((r["reading_id"], r["source_file"]) for r in spark.read.parquet(dst).collect()) == [("r1", "a"), ("r2", "c"), ("r3", "d")]


def test_stored_history_grows_by_changes(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "history"), "device_id string, firmware string"
    for day, rows in ((1, [("a", "1"), ("b", "1")]), (2, [("a", "2"), ("b", "1")]), (3, [("a", "2")])):
        got = tables.snapshot_table(frame(rows, ddl), path, "device_id", ["firmware"], dt.datetime(2024, 1, day))
    assert sorted((r["device_id"], r["firmware"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day) for r in got.collect()) == [
        ("a", "1", 1, 2), ("a", "2", 2, None), ("b", "1", 1, None)]
    assert tables.list_versions(spark, path).count() == 3


def sizes(path):
    return {f: f.stat().st_size for f in path.rglob("*.parquet")}


def test_closed_versions_are_not_written_again(spark, frame, tmp_path):
    """Ten runs over many keys of which one changes each time: what a run writes does not grow with the history."""
    path, ddl = tmp_path / "history", "device_id string, firmware string"
    written, before = [], {}
    for day in range(1, 11):
        rows = [(f"d{i}", f"{day}" if i == day else "0") for i in range(50)]
        got = tables.snapshot_table(frame(rows, ddl).coalesce(1), str(path), "device_id", ["firmware"], dt.datetime(2024, 1, day))
        now = sizes(path)
        assert all(now.get(f) == size for f, size in before.items())  # every file of an earlier version is as it was
        written.append(sum(size for f, size in now.items() if f not in before))
        before = now
    assert max(written[2:]) < 1.3 * min(written[2:])
    closed = got.filter("valid_to IS NOT NULL")
    assert closed.count() == 2 * 9 and got.filter("valid_to IS NULL").count() == 50
    assert tables.read_as_of(spark, str(path), dt.datetime(2024, 1, 1)).count() == 50


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "mart")
    tables.write_version(spark.range(3), path, dt.datetime(2024, 1, 1))
    after = tables.newest_version(spark, path)
    assert tables.write_version(spark.range(4), path, dt.datetime(2024, 1, 2), after=after) == 2
    with pytest.raises(tables.VersionConflict):
        tables.write_version(spark.range(5), path, dt.datetime(2024, 1, 3), after=after)
    assert tables.read_as_of(spark, path).count() == 4 and tables.list_versions(spark, path).count() == 2
    assert tables.append_version(spark.range(2), path, dt.datetime(2024, 1, 4)) == 3
    assert tables.read_as_of(spark, path).count() == 6 and tables.read_as_of(spark, path, dt.datetime(2024, 1, 3)).count() == 4


def test_a_writer_who_breaks_off_leaves_no_version(spark, tmp_path):
    path = tmp_path / "mart"
    tables.write_version(spark.range(3), str(path), dt.datetime(2024, 1, 1))
    (path / "_versions" / "000000002.json").write_text("")  # took its number and was lost
    assert tables.read_as_of(spark, str(path)).count() == 3
    assert tables.append_version(spark.range(2), str(path), dt.datetime(2024, 1, 4)) == 3
    assert tables.read_as_of(spark, str(path)).count() == 5 and [r["version"] for r in tables.list_versions(spark, str(path)).collect()] == [1, 3]


def test_seeds(spark, tmp_path):
    (tmp_path / "device_registry.csv").write_text(
        "device_id,device_name,device_type,cluster_id,base_latitude,base_longitude,install_date\n"
        "DEV_001,One,Type_B,FACTORY_A,40.7,-74.0,2025-01-15\n")
    (tmp_path / "sensor_thresholds.csv").write_text(
        "sensor_type,min_valid,max_valid,warning_low,warning_high,critical_low,critical_high\n"
        "temperature,-20,60,-10,50,-20,60\n")
    (tmp_path / "cluster_metadata.csv").write_text(
        "cluster_id,cluster_city,cluster_state,cluster_timezone,environment_type,manager_name,max_devices\n"
        "FACTORY_A,New York,NY,America/New_York,indoor,Someone,20\n")
    seeds = files.load_seeds(spark, str(tmp_path))
    assert seeds["device_registry"].first()["install_date"] == dt.date(2025, 1, 15)
    assert seeds["sensor_thresholds"].first()["min_valid"] == -20.0


def test_versions_are_read_by_time(spark, tmp_path):
    path = str(tmp_path / "mart")
    assert tables.list_versions(spark, path).isEmpty()
    assert tables.write_version(spark.range(3), path, dt.datetime(2024, 1, 1)) == 1
    assert tables.write_version(spark.range(5), path, dt.datetime(2024, 1, 3)) == 2
    assert tables.read_as_of(spark, path, dt.datetime(2024, 1, 2)).count() == 3
    assert tables.read_as_of(spark, path).count() == 5
    with pytest.raises(LookupError):
        tables.read_as_of(spark, path, dt.datetime(2023, 1, 1))


def test_upsert_touches_only_its_partitions(spark, tmp_path, frame):
    path, ddl = str(tmp_path / "t"), "k string, v int, day string"
    tables.upsert_partitions(frame([("a", 1, "x"), ("b", 1, "y")], ddl), path, "k", "day")
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=y").iterdir()}
    for _ in range(2):
        tables.upsert_partitions(frame([("a", 2, "x"), ("c", 2, "x")], ddl), path, "k", "day")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1), ("c", 2)]
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "day=y").iterdir()} == before


def test_kafka_options():
    assert messages.kafka_options("h:9092", "t", "earliest", 100) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100"}


def test_dead_letters(frame):
    rows = frame([("k", '{"a":1}'), ("k", "{"), (None, None), ("k", "[1]"), ("k", "7")], "key string, value string")
    good, bad = messages.split_deadletter(rows)
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["empty message", "malformed JSON", "not an object",
                                                          "not an object"]


def test_schema_contract(data, frame):
    assert quality.schema_contract(data.staged, struct(STAGED)).isEmpty()
    wrong = data.staged.drop("humidity").withColumn("extra", F.lit(1))
    found = {r["column_name"]: (r["expected_type"], r["actual_type"])
             for r in quality.schema_contract(wrong, struct(STAGED)).collect()}
    assert found == {"humidity": ("double", None), "extra": (None, "int")}


def test_payload_drift_kinds(frame):
    texts = [("f", json.dumps(READING | {"co2_level": 400.0})), ("g", json.dumps(READING | {"temperature": "hot"})),
             ("g", json.dumps({k: v for k, v in READING.items() if k != "humidity"} | {"signal_strength": -5}))]
    raw = frame(texts, "source_file string, t string").select("source_file", F.parse_json("t").alias("raw_data"))
    got = {(r["source_file"], r["field"], r["drift"]) for r in quality.payload_drift(raw, PAYLOAD_FIELDS).collect()}
    assert got == {("g", "temperature", "type changed"), ("g", "signal_strength", "new"), ("g", "co2_level", "missing")}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scores_of_out_of_order_batches(data, tmp_path):
    """Readings arrive in a random order over four micro-batches; the stored scores are those of a full run."""
    spark, path = data.spark, str(tmp_path / "in")
    rows = data.layers.deduped.select("reading_id", "device_id", "reading_ts", "temperature").cache()
    for part in range(4):
        rows.filter(F.crc32("reading_id") % 4 == part).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    dst = str(tmp_path / "out")
    rolling.score_stream(stream, dst, str(tmp_path / "checkpoint")).awaitTermination()

    def scores(df):
        return {r[0]: r[1] for r in df.select(
            "reading_id", F.col("temperature_zscore").cast("decimal(28,6)")).collect()}

    assert scores(spark.read.parquet(f"{dst}/scored")) == scores(rolling_zscore(rows))
