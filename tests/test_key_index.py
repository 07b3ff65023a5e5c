"""The key index against plain sets: batches, repeats, merges, and what a load reads."""

import glob
import os

from pyspark.sql import functions as F

from motefield.sources import key_index
from motefield.sources.key_index import KeyIndex


def keys(frame, names):
    return frame([(n, i) for i, n in enumerate(names)], "reading_id string, v int")


def ids(df):
    return sorted((r["reading_id"] for r in df.collect()), key=str)


def test_only_unknown_keys_pass(spark, frame, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"), parts=4, fan=3)
    seen, batches = set(), [["a", "b", None], ["b", "c", "d"], [], ["a", None, "e"], ["f", "c"], ["g"], ["h", "b", "g"], ["i"] * 2]
    for number, names in enumerate(batches):
        for _ in range(2 if number % 2 else 1):  # a repeated batch sees what it saw before
            fresh = index.unknown(keys(frame, names), "reading_id", number)
            assert ids(fresh) == sorted((n for n in names if n not in seen), key=str)
            index.add(fresh, "reading_id", number)
        seen.update(names)
    assert len(index.generations()) < len(batches) and max(g.level for g in index.generations()) >= 1


def test_a_load_of_new_keys_opens_no_folder_of_keys(spark, tmp_path):
    """Whatever the history, new keys are told by the filters, and a repeated batch opens the folders of its own time only."""
    index = KeyIndex(spark, str(tmp_path / "index"), parts=8)
    read = []
    for number in range(4):
        rows = spark.range(number * 5000, (number + 1) * 5000).select(F.concat(F.lit("reading-"), F.col("id").cast("string")).alias("reading_id"))
        maybe = index.maybe_known(rows, "reading_id", number)
        read.append(0 if maybe is None else maybe.count())
        assert index.unknown(rows, "reading_id", number).count() == 5000
        index.add(rows, "reading_id", number)
    assert max(read) < 5000 * 3 * 0.01  # false hits of four bits at sixteen bits per key
    again = spark.range(5000, 5010).select(F.concat(F.lit("reading-"), F.col("id").cast("string")).alias("reading_id"))
    cells = {(r["generation"], r["part"]) for r in index.maybe_known(again, "reading_id", 9).collect()}
    assert {g for g, _ in cells} == {"0-000000001-000000001"} and index.unknown(again, "reading_id", 9).isEmpty()
    opened = index.keys_of(sorted(cells))
    assert len(opened.inputFiles()) < len(glob.glob(f"{index.path}/keys/generation=*/part=*/*.parquet")) / 2


def test_filters_are_two_bytes_per_key(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"))
    index.add(spark.range(30_000).select(F.col("id").cast("string").alias("reading_id")), "reading_id", 0)
    row = spark.read.parquet(f"{index.path}/filters").agg(F.sum(F.octet_length("bits")).alias("bytes"), F.max("pages").alias("pages")).first()
    assert row["bytes"] == row["pages"] * key_index.PAGE_BITS // 8 and 2 * 30_000 <= row["bytes"] < 5 * 30_000


def test_a_batch_that_broke_off_while_it_was_added(spark, frame, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "index"))
    index.add(keys(frame, ["a"]), "reading_id", 0)
    index.add(keys(frame, ["b"]), "reading_id", 1)
    for file in glob.glob(f"{index.path}/filters/generation=0-000000001-*/_SUCCESS"):
        os.remove(file)
    assert ids(index.unknown(keys(frame, ["a", "b"]), "reading_id", 1)) == ["b"]
    index.add(keys(frame, ["b"]), "reading_id", 1)
    assert ids(index.unknown(keys(frame, ["a", "b", "c"]), "reading_id", 2)) == ["c"]


def test_few_known_keys_move_no_rows(spark, tmp_path):
    """The known keys are a table of known size, so that the rows of a load are not shuffled to leave them out."""
    index = KeyIndex(spark, str(tmp_path / "index"))
    index.add(spark.range(1000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("reading_id")), "reading_id", 0)
    rows = spark.range(990, 3000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("reading_id"))
    fresh = index.unknown(rows.union(rows), "reading_id", 1)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, plan
    assert fresh.count() == 2 * 2000
