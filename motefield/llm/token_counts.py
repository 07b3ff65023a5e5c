"""Token counts of documents in flat token files that have no index.

A flat file is a stream of ids in which every document ends with a separator. It is read in blocks of fixed size that end
anywhere. Each block is searched for separators by itself; a prefix scan over the blocks of a file then gives every
block the ids, the separators and the last separator before it, which is all that is needed to stitch documents across blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import codec
from .workspace import Workspace

SEPARATOR = 50256
WIDTH = 2
BLOCK_BYTES = 1 << 20


def write_flat(docs: DataFrame, rank_file: bytes, pattern: str, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Encode documents into flat streams, one for each task: ``shard, block, data`` and the order ``shard, ordinal, doc_id``."""
    schema = "shard int, place long, doc_id long, data binary"
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def rows(shard: int, first: int, ids: list[int | None], data: list[bytes | None]) -> pa.RecordBatch:
        n = len(ids)
        columns = [[shard] * n, list(range(first, first + n)), ids, data]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "place", "doc_id", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encode = TaskContext.get().partitionId(), codec(rank_file, pattern).encode
        held, ordinal, block = bytearray(), 0, 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for text in batch.column(1):
                ids = np.array([*encode(text.as_py() or ""), SEPARATOR], dtype=f"<u{WIDTH}")
                held += ids.tobytes()
                while len(held) >= block_bytes:
                    yield rows(shard, block, [None], [bytes(held[:block_bytes])])
                    del held[:block_bytes]
                    block += 1
            yield rows(shard, ordinal, names, [None] * len(names))
            ordinal += len(names)
        if held:
            yield rows(shard, block, [None], [bytes(held)])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    store = work.settle(named.mapInArrow(run, schema), "flat")
    blocks = store.where("data IS NOT NULL").select("shard", F.col("place").alias("block"), "data")
    return blocks, store.where("data IS NULL").select("shard", F.col("place").alias("ordinal"), "doc_id")


def read_flat(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of raw token files: ``shard`` is the path. A file is read as one value, so files should be cut below 1 GB."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("shard"), "content")
    count = F.ceil(F.octet_length("content") / block_bytes).cast("int")
    cut = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
        i.cast("long").alias("block"), F.substring(F.col("content"), i * block_bytes + 1, F.lit(block_bytes)).alias("data")))
    return files.where("octet_length(content) > 0").select("shard", F.explode(cut).alias("cut")).select("shard", "cut.*")


def count_tokens(blocks: DataFrame, work: Workspace, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """A row per document of ``shard, block, data``: ``shard, ordinal, start, n_tokens, closed``.

    ``start`` and ``n_tokens`` count ids without the separator. Ids after the last separator of a file are one more document that
    is not closed. Blocks of a file hold whole ids. An empty document has no tokens; no blocks give no rows.
    """
    shard_type = blocks.schema["shard"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = [np.frombuffer(d.as_buffer(), dtype=f"<u{width}") for d in batch.column(2)]
            ends = [np.flatnonzero(s == separator).astype(np.int32) for s in streams]
            sizes = pa.array([len(s) for s in streams], pa.int64())
            columns = [batch.column(0), batch.column(1), sizes, pa.array(ends, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "block", "n_ids", "ends"])

    schema = f"shard {shard_type}, block long, n_ids long, ends array<int>"
    found = work.settle(blocks.select("shard", "block", "data").mapInArrow(search, schema), "separators")
    order = Window.partitionBy("shard").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own_last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    scanned = found.select("shard", "block", "n_ids", F.size("ends").alias("n_ends"), own_last.alias("own_last")).select(
        "*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ids_before"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("documents_before"),
    ).withColumn("start_before", F.coalesce(F.max(F.col("ids_before") + F.col("own_last")).over(before) + 1, F.lit(0)))
    scanned = work.settle(scanned, "scan")
    ends = found.select("shard", "block", "ends").join(scanned.select("shard", "block", "ids_before", "documents_before", "start_before"), ["shard", "block"])
    starts = F.concat(F.array((F.col("start_before") - F.col("ids_before")).cast("long")), F.transform("ends", lambda e: e.cast("long") + 1))
    each = ends.where("size(ends) > 0").select(
        "shard", "ids_before", "documents_before", starts.alias("starts"), F.posexplode("ends").alias("i", "end"))
    closed = each.select(
        "shard", (F.col("documents_before") + F.col("i")).alias("ordinal"),
        (F.col("ids_before") + F.expr("starts[i]")).alias("start"), (F.col("end") - F.expr("starts[i]")).alias("n_tokens"), F.lit(True).alias("closed"))
    tails = scanned.groupBy("shard").agg(
        F.sum("n_ends").alias("ordinal"), F.coalesce(F.max(F.col("ids_before") + F.col("own_last")) + 1, F.lit(0)).alias("start"), F.sum("n_ids").alias("size"),
    ).where("size > start").select("shard", "ordinal", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tails)


def document_counts(docs: DataFrame, rank_file: bytes, pattern: str, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, shard, ordinal, start``, counted from flat files alone.

    A null text counts as empty and has no tokens. Ids of documents may be null or repeated. No rows give no rows.
    """
    blocks, order = write_flat(docs, rank_file, pattern, work, id_col, text_col, block_bytes)
    counts = count_tokens(blocks, work)
    return order.join(counts, ["shard", "ordinal"]).select("doc_id", "n_tokens", "shard", "ordinal", "start")
