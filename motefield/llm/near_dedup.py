"""Near duplicates by SimHash fingerprints and an inverted index over byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most three bits share at least five of their eight bytes in place. A
posting list of a single byte would hold 1/256 of all rows, so a list is keyed by four positions at once. The lists are
the 14 blocks of the Steiner system S(3, 4, 8): four positions whose numbers have an exclusive or of 0. Any five positions contain
exactly one of these blocks, so a pair that shares five bytes meets in a list, and one that shares fewer than five need
not be found. For the pairs of a list the shared bytes are tallied, pairs below five are dropped, and the rest are
verified by their differing bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .components import components
from .workspace import Workspace

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BYTES = 8
BLOCKS = [b for b in combinations(range(BYTES), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]
LIST_ROWS = 256
CHUNK = 1 << 18
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: str | None, words: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer. ``bytes.split`` cuts at the blanks x20 and x09 to x0D."""
    seq = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not seq:
        return 0
    last = max(len(seq) - words, 0) + 1
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, last, CHUNK):
        hashes = [xxhash.xxh64_intdigest(b" ".join(seq[i:i + words]), SEED) for i in range(at, min(at + CHUNK, last))]
        block = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > last, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def simhash_column(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([simhash(t) for t in texts], dtype="<u8").view("<i8"))


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(255)


def _shared_bytes(difference: Column) -> Column:
    """In how many positions the exclusive or of two fingerprints is 0."""
    return sum((F.when(_byte(difference, p) == 0, 1).otherwise(0) for p in range(BYTES)), F.lit(0))


def _lists(prints: DataFrame, blocks: list[tuple[int, ...]]) -> DataFrame:
    """``fp, block, bytes``: an entry for each block; ``bytes`` are the fingerprint's bytes in the block's positions."""
    masks = F.array(*(F.lit(_signed(sum(255 << (8 * p) for p in block))) for block in blocks))
    entry = prints.select("fp", F.posexplode(masks).alias("block", "mask"))
    return entry.select("fp", "block", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _pairs(lists: DataFrame) -> DataFrame:
    """The pairs of each list that the tally and the check of bits leave."""
    difference = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    found = (
        (F.col("x.block") == F.col("y.block")) & (F.col("x.bytes") == F.col("y.bytes")) & (F.col("x.fp") < F.col("y.fp"))
        & (_shared_bytes(difference) >= BYTES - MAX_BITS) & (F.bit_count(difference) <= MAX_BITS)
    )
    return lists.alias("x").join(lists.alias("y"), found).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def linked(prints: DataFrame, work: Workspace, list_rows: int = LIST_ROWS) -> DataFrame:
    """``a, b``: all pairs of the distinct fingerprints ``fp`` that differ in at most three bits.

    Pairs of a list share one more byte among the four other positions, so lists of over ``list_rows`` entries
    are cut by each further byte; that finds the same pairs.
    """
    five = [tuple(sorted({*b, p})) for b in BLOCKS for p in range(BYTES) if p not in b]
    lists = work.settle(_lists(prints, BLOCKS), "lists")
    long = lists.groupBy("block", "bytes").count().where(F.col("count") > list_rows).select("block", "bytes")
    long = work.settle(long, "long-lists")
    short = lists.join(long, ["block", "bytes"], "left_anti")
    crowded = lists.join(long, ["block", "bytes"], "left_semi").select("fp").distinct()
    return _pairs(short).unionByName(_pairs(_lists(crowded, five))).distinct()


def near_duplicates(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id, component_root`` and the columns named in ``keep``.

    A null text counts as empty; texts without words have fingerprint zero and are linked like any other. Equal
    fingerprints are one node, so copies never become pairs. ``component_id`` is the smallest id that is not null, or
    null if a component has none; ``component_root`` names the component by its smallest fingerprint. Rows that repeat an id each get a row. No rows give no rows.
    """
    prints = docs.select(F.col(id_col).alias("doc_id"), *keep, simhash_column(F.col(text_col).cast("string")).alias("fp"))
    prints = work.settle(prints, "prints")
    nodes = work.settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = work.settle(components(linked(nodes.select("fp"), work), work), "roots")
    work.drop("lists", "long-lists")
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = work.settle(rooted.join(least, "root").select("fp", "component_id", "root"), "labels")
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.lower(F.lpad(F.hex("root"), 16, "0")).alias("component_root"), *keep)
