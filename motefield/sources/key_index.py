"""An index of known keys, so that an insert-only load need not read the keys of all history.

Every batch is a *generation* of two tables. ``keys`` holds its keys in ``parts`` folders by hash. ``filters`` holds Bloom bit sets:
a key's hash names a page of ``PAGE_BITS`` bits and ``HASHES`` bits in it. A load tests its keys against the filters, about two bytes per
known key, and reads only those folders of ``keys`` that may hold one of them; for new keys that are next to none. Of every ``FAN``
generations of one level one of the next level is made, so there are few, and a key is written again only once per level.

A batch never sees its own generation, and only generations of earlier batches are merged: a repeated batch finds what it found before
and replaces what it wrote.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import without
from .tables import remove

PAGE_BITS = 32_768
KEYS_PER_PAGE = PAGE_BITS // 16
HASHES = 4
PARTS = 16
FAN = 8


@dataclass(frozen=True)
class Generation:
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.level}-{self.first:09d}-{self.last:09d}"

    @staticmethod
    def of(name: str) -> Generation:
        return Generation(*map(int, name.split("-")))


def _bits(pos: int) -> Column:
    """The ``pos``-th bit of a key in its page: fifteen bits of its second hash."""
    return F.shiftrightunsigned("second", 15 * pos).bitwiseAND(PAGE_BITS - 1)


def _is_set(page: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(page, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


class KeyIndex:
    """Known keys below ``path``. ``key`` columns are compared as text; NULL is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS, fan: int = FAN):
        self.spark, self.path, self.parts, self.fan = spark, path.rstrip("/"), parts, fan

    def _at(self, table: str, generation: Generation) -> str:
        return f"{self.path}/{table}/generation={generation.name}"

    def generations(self) -> list[Generation]:
        """The committed generations: those whose filters are written. Their number grows with the logarithm of the batches."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/filters")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [re.search(r"generation=(\d+-\d+-\d+)$", f.getPath().toString()) for f in files.listStatus(folder)]
        found = [Generation.of(n.group(1)) for n in names if n]
        done = [g for g in found if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._at('filters', g)}/_SUCCESS"))]
        # a merged generation whose sources are still there stands for them
        return [g for g in done if not any(h.level > g.level and h.first <= g.first and g.last <= h.last for h in done)]

    def _hashed(self, df: DataFrame, key: str) -> DataFrame:
        text = F.col(key).cast("string")
        return df.select(text.alias("key"), F.xxhash64(text).alias("first"), F.xxhash64(text, F.lit(1)).alias("second")) \
            .withColumn("part", F.pmod("second", F.lit(self.parts)).cast("int"))

    def _write(self, hashed: DataFrame, generation: Generation) -> None:
        """Keys first, filters last: a generation counts once its filters are committed."""
        keys = self._at("keys", generation)
        hashed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(keys)
        rows = self.spark.read.schema(hashed.schema).parquet(keys)
        pages = 1 << (max(rows.count() - 1, 0) // KEYS_PER_PAGE).bit_length()
        bit = F.explode(F.array(*[_bits(i) for i in range(HASHES)]))
        pages_of = rows.select(F.col("first").bitwiseAND(pages - 1).alias("page"), bit.alias("bit"))
        sets = pages_of.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).withColumn("pages", F.lit(pages).cast("long"))
        sets.write.mode("overwrite").parquet(self._at("filters", generation))

    def add(self, rows: DataFrame, key: str, batch: int) -> None:
        """Make the keys of ``rows`` known as those of ``batch``; the same batch again replaces them."""
        self._write(self._hashed(rows, key).distinct(), Generation(0, batch, batch))
        self._merge(batch)

    def _merge(self, batch: int) -> None:
        level = 0
        while True:
            settled = sorted((g for g in self.generations() if g.level == level and g.last < batch), key=lambda g: g.first)
            if len(settled) < self.fan:
                return
            keys = self.spark.read.option("basePath", f"{self.path}/keys").parquet(*[self._at("keys", g) for g in settled])
            self._write(keys.select("key", "first", "second", "part").distinct(), Generation(level + 1, settled[0].first, settled[-1].last))
            remove(self.spark, *[self._at(table, g) for g in settled for table in ("filters", "keys")])
            level += 1

    def maybe_known(self, rows: DataFrame, key: str, batch: int) -> DataFrame | None:
        """``key, generation, part``: the folders that may hold keys of ``rows``, by the filters alone."""
        seen = [g for g in self.generations() if not (g.level == 0 and g.first == batch)]
        if not seen:
            return None
        filters = self.spark.read.option("basePath", f"{self.path}/filters").parquet(*[self._at("filters", g) for g in seen])
        sizes = filters.groupBy("generation").agg(F.max("pages").alias("pages"))
        wanted = self._hashed(rows, key).join(F.broadcast(sizes)).withColumn("page", F.col("first").bitwiseAND(F.col("pages") - 1))
        tested = wanted.drop("pages").join(filters.select("generation", "page", "bits"), ["generation", "page"])
        hit = F.lit(True)
        for i in range(HASHES):
            hit = hit & _is_set(F.col("bits"), _bits(i))
        return tested.filter(hit).select("key", "generation", "part")

    def known(self, rows: DataFrame, key: str, batch: int) -> DataFrame | None:
        """``key``: those of ``rows`` that other batches have."""
        maybe = self.maybe_known(rows, key, batch)
        if maybe is None:
            return None
        probe, found = (f"{self.path}/{table}/batch={batch:09d}" for table in ("probe", "known"))
        maybe.write.mode("overwrite").parquet(probe)
        maybe = self.spark.read.schema(maybe.schema).parquet(probe)
        cells = maybe.select("generation", "part").distinct().collect()  # at most generations x parts
        if not cells:
            return maybe.select("key")
        known = maybe.select("key").distinct().join(
            self.keys_of([(c["generation"], c["part"]) for c in cells]).withColumnRenamed("key", "_known"), F.col("key").eqNullSafe(F.col("_known")), "left_semi")
        known.write.mode("overwrite").parquet(found)  # a table of known size: few keys are broadcast, and the rows need not be shuffled
        return self.spark.read.schema(known.schema).parquet(found)

    def keys_of(self, cells: list[tuple[str, int]]) -> DataFrame:
        """The keys in the given folders; no other folder is opened."""
        folders = [f"{self._at('keys', Generation.of(generation))}/part={part}" for generation, part in cells]
        return self.spark.read.schema("key string").parquet(*folders)

    def unknown(self, rows: DataFrame, key: str, batch: int) -> DataFrame:
        """The rows whose key no other batch has."""
        known = self.known(rows, key, batch)
        return rows if known is None else without(rows, known.select(F.col("key").alias(key)), key)
