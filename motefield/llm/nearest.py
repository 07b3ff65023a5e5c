"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one, rotated at random, and kept as the signs of its coordinates with two scalars:
its length and the inner product of the unit vector with its code. From these follow an estimate of the inner product
with a query and a bound on its error. A query reranks on the original vectors what may still enter its list by that bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

TOP = 20
BLOCK_VALUES = 1 << 24
LEAST_ROWS = 4096
CHUNK = 2048
QUERY_ROWS = 256
#: Candidates scored before there is a bound, and pairs of queries and candidates estimated at a time.
SEEDS, PAIRS = 256, 1 << 22
#: Deviations of an estimate that its bound allows for. So recall stays above 0.97 with under a tenth of the pairs scored, see README.
CONFIDENCE = 1.25
QUERY_STEP = 20


def rotation(dims: int) -> np.ndarray:
    """An orthogonal matrix drawn from a fixed seed."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


class Codes:
    """The packed signs, lengths and corrections of a block of vectors."""

    def __init__(self, vectors: np.ndarray):
        self.dims = vectors.shape[1]
        self.norms = np.linalg.norm(vectors, axis=1)
        turned = (vectors / self.norms[:, None]).astype(np.float32) @ rotation(self.dims)
        self.packed = np.packbits(turned > 0, axis=1)
        self.agreement = np.abs(turned).sum(axis=1, dtype=np.float64) / math.sqrt(self.dims)

    def estimate(self, turned: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """For unit queries (rotated) and the vectors of ``part``: estimated inner products and their bounds."""
        signs = np.unpackbits(self.packed[part], axis=1, count=self.dims).astype(np.float32) * 2 - 1
        agreement, norms = self.agreement[part], self.norms[part]
        estimates = turned @ signs.T / math.sqrt(self.dims) / agreement * norms
        spread = np.sqrt(np.maximum(1 - agreement**2, 0)) / agreement / math.sqrt(max(self.dims - 1, 1))
        return estimates, CONFIDENCE * spread * norms


class Block:
    """Candidates of one block. Of equal vectors only the smallest ids can be in a list, one more than it is long."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        same = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)[1].ravel()
        by = np.argsort(same, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(same[by]) != 0))
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by] = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
        keep = rank <= top
        self.ids, self.vectors, self.top = ids[keep], vectors[keep].astype(np.float64), top
        self.codes, self.scored = Codes(self.vectors), 0

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The best candidates of each query, ids and exact scores.

        The candidates with the largest estimates are scored first; the last score of that list is the bound that the others' estimates,
        raised by their errors, have to reach. ``scored`` counts all that were scored.
        """
        norms = np.linalg.norm(queries, axis=1)
        turned = (queries / norms[:, None]).astype(np.float32) @ rotation(queries.shape[1])
        ids: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        together = max(1, PAIRS // max(len(self.ids), 1))
        for low in range(0, len(queries), together):
            parts = [self.codes.estimate(turned[low:low + together], slice(at, at + CHUNK)) for at in range(0, len(self.ids), CHUNK)]
            estimates, errors = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
            for q, row in enumerate(estimates, low):
                row = np.where(self.ids == query_ids[q], -np.inf, row)
                first = np.argpartition(-row, SEEDS)[:SEEDS] if len(row) > SEEDS else np.arange(len(row))
                first = first[row[first] > -np.inf]
                own = exact(self.vectors[first], queries[q])
                least = np.partition(own, -self.top)[-self.top] if len(own) >= self.top else -np.inf
                others = (row + errors) * norms[q] >= least
                others[first] = False
                maybe = np.flatnonzero(others & (row > -np.inf))
                own_ids = np.append(self.ids[first], self.ids[maybe])
                own = np.append(own, exact(self.vectors[maybe], queries[q]))
                self.scored += len(own)
                best = np.lexsort((own_ids, -own))[: self.top]
                ids.append(own_ids[best])
                scores.append(own[best])
        return ids, scores


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the components added in order."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def usable(vec: str = "vector"):
    """Not null, not empty, not zero, no component null or not finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0)


def search(vectors: DataFrame, top: int = TOP, query_step: int = QUERY_STEP, id_col: str = "vec_id", vec_col: str = "embedding",
           block_rows: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``query_step`` its ``top`` candidates by inner product.

    Vectors and queries of one length meet; other lengths form sets of their own. Candidates lie in blocks of about
    ``block_rows``, each held by one task, and queries stream through them. By default blocks grow with the square root of the
    table, so that blocks and copies of the queries grow alike, up to ``BLOCK_VALUES`` numbers. Vectors that are null, empty, zero or hold
    null or non-finite components, and null ids, take no part. A row that repeats an id is one more candidate; as a query an id asks
    once, with its smallest vector, and never finds its own id. No rows give no rows.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
    base = base.where(F.col("vec_id").isNotNull() & usable()).withColumn("dims", F.size("vector"))
    rows, widest = base.agg(F.count(F.lit(1)), F.coalesce(F.max("dims"), F.lit(1))).first()
    wanted = block_rows or max(1, min(BLOCK_VALUES // widest, max(LEAST_ROWS, 40 * math.isqrt(rows))))
    blocks = max(1, math.ceil(rows / wanted))
    held = base.select("dims", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "vector")
    queries = base.where(F.col("vec_id") % query_step == 0).groupBy("vec_id").agg(F.min(F.struct("dims", "vector")).alias("least"))
    asked = queries.select("vec_id", "least.*").select(
        "dims", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, block = None, [], [], None
        for batch in batches:
            dims, blocks_, kinds, vec_ids = (batch.column(i).to_numpy() for i in range(4))
            flat, offsets = batch.column(4).flatten().to_numpy(), np.append(0, np.cumsum(dims, dtype=np.int64))
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks_) != 0) | (np.diff(kinds) != 0)) + 1
            for low, high in zip([0, *edges], [*edges, len(dims)], strict=True):
                if low == high:
                    continue
                rows = flat[offsets[low]:offsets[high]].reshape(high - low, dims[low])
                if key != (dims[low], blocks_[low]):
                    key, ids, parts, block = (dims[low], blocks_[low]), [], [], None
                if kinds[low] == 0:
                    ids.append(vec_ids[low:high])
                    parts.append(rows)
                    continue
                if block is None and ids:
                    block = Block(np.concatenate(ids), np.vstack(parts), top)
                    ids, parts = [], []
                for a in range(0, high - low if block else 0, QUERY_ROWS):
                    asked_ids = vec_ids[low + a:min(low + a + QUERY_ROWS, high)]
                    found, scores = block.search(asked_ids, rows[a:a + QUERY_ROWS])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(asked_ids, [len(f) for f in found])), pa.array(np.concatenate(found)), pa.array(np.concatenate(scores)),
                    ], ["query_id", "vec_id", "score"])

    merged = held.unionByName(asked).repartition("dims", "block").sortWithinPartitions("dims", "block", "kind")
    found = merged.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
