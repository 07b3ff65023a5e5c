"""A quality classifier: random-indexing word vectors pooled per document and a two-layer network.

Every token has a sparse random index vector. The context vector of a word is the sum of the index vectors of the
tokens up to ``REACH`` places before and after it, over all tokens of all documents, held as exact integers. Words live in ``BUCKETS`` hashed
rows, so the table is bounded whatever the vocabulary. A document is the mean and the spread of its tokens' vectors and
how far vectors one and two places apart agree. A network with one hidden layer, trained with numpy, gives a logit; a temperature fitted on rows kept back from
training turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

BUCKETS = 1 << 13
DIMS = 32
NONZERO = 4
REACH = 2
FEATURES = 2 * DIMS + 2 * REACH
HIDDEN = 32
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
STEPS = 400
PART_BYTES = 2_000_000
_SPACE, _WORD, _SIGN = 0, 1, 2


def _byte_kinds() -> np.ndarray:
    """Space, word or sign for each byte; bytes above 127 belong to letters."""
    kinds = np.full(256, _SIGN, dtype=np.int8)
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kinds[a:b] = _WORD
    return kinds


_KINDS = _byte_kinds()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with the constants of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_buckets(data: bytes) -> np.ndarray:
    """The bucket of every token of a text: runs of word bytes or of signs, hashed by all their bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    kinds = _KINDS[raw]
    edge = np.empty(len(raw), dtype=bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    starts = np.flatnonzero(edge)
    within = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    values = _mix((raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + within.astype(np.uint64))
    sums = _mix(np.add.reduceat(values, starts))
    return (sums[kinds[starts] != _SPACE] >> np.uint64(20)).astype(np.int64) % BUCKETS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the places of its nonzero entries and their signs, from a fixed seed."""
    rng = np.random.default_rng(20)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice([-1, 1], size=(BUCKETS, NONZERO)).astype(np.int64)


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts of bounded size, cut after a space where there is one, else at an edge of a token: a token of any length stays whole."""
    at = 0
    while at < len(data):
        end = min(at + PART_BYTES, len(data))
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            end = cut + 1 if cut > at else _token_edge(data, at, end)
        yield data[at:end]
        at = end


def _token_edge(data: bytes, at: int, end: int) -> int:
    """The last edge between kinds of bytes after ``at`` and up to ``end``, else the first after it, else the end of the text."""
    kinds = _KINDS[np.frombuffer(data, dtype=np.uint8, count=end + 1 - at, offset=at)]
    edges = np.flatnonzero(kinds[1:] != kinds[:-1])
    if len(edges):
        return at + int(edges[-1]) + 1
    while end < len(data):
        kinds = _KINDS[np.frombuffer(data, dtype=np.uint8, count=min(PART_BYTES, len(data) - end) + 1, offset=end - 1)]
        edges = np.flatnonzero(kinds[1:] != kinds[:-1])
        if len(edges):
            return end + int(edges[0])
        end += len(kinds) - 1
    return end


def _add_contexts(total: np.ndarray, tokens: np.ndarray, counted: int, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the pairs of ``tokens`` whose later end is not among the first ``counted``; a token below 0 is no word and has no context."""
    for step in range(1, REACH + 1):
        first = max(counted - step, 0)
        late, early = tokens[first + step:], tokens[first:max(len(tokens) - step, first)]
        both = (late >= 0) & (early >= 0)
        late, early = late[both], early[both]
        for here, there in ((late, early), (early, late)):
            for k in range(NONZERO):
                cell = here * DIMS + places[there, k]
                sign = signs[there, k] > 0
                total += np.bincount(cell[sign], minlength=len(total)) - np.bincount(cell[~sign], minlength=len(total))


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The unit context vector of each bucket, from all documents. Tasks send sums, which are added per block of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total, gap = np.zeros(BUCKETS * DIMS, dtype=np.int64), np.full(REACH, -1, dtype=np.int64)
        held, size, counted = [], 0, 0
        for part in (part for batch in batches for text in batch.column(0) if text.is_valid
                     for part in (*_parts(text.as_py().encode("utf-8", "replace")), None)):
            # parts are counted together in larger arrays; documents have a gap between them that no context reaches over
            held.append(gap if part is None else token_buckets(part))
            size += len(part or b"")
            if size >= PART_BYTES:
                tokens = np.concatenate(held)
                _add_contexts(total, tokens, counted, places, signs)
                held, size, counted = [tokens[-REACH:]], 0, min(REACH, len(tokens))
        if held:
            _add_contexts(total, np.concatenate(held), counted, places, signs)
        rows = total.reshape(BUCKETS, DIMS)
        used = np.flatnonzero(rows.any(axis=1))
        for at in range(0, len(used), 1024):
            some = used[at:at + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(list(rows[some]), pa.list_(pa.int64()))], ["bucket", "v"])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, v array<long>")
    sums = parts.groupBy("bucket").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMS))).toPandas()
    vectors = np.zeros((BUCKETS, DIMS))
    if len(sums):
        vectors[sums["bucket"].to_numpy()] = sums.drop(columns="bucket").to_numpy(dtype=float)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of a text's token vectors, and for tokens one and two places apart the mean
    inner product and the share of equal ones; zeros for a text without tokens."""
    first, second, agree, n = np.zeros(DIMS), np.zeros(DIMS), np.zeros(2 * REACH), 0
    before = np.empty(0, dtype=np.int64)
    for part in _parts((text or "").encode("utf-8", "replace")):
        own = token_buckets(part)
        tokens = np.concatenate([before, own])
        rows, known = vectors[tokens], len(before)
        first += rows[known:].sum(axis=0, dtype=np.float64)
        second += np.einsum("ij,ij->j", rows[known:], rows[known:], dtype=np.float64)
        for lag in range(1, REACH + 1):
            a = max(known - lag, 0)
            b = max(len(tokens) - lag, a)
            agree[2 * lag - 2] += np.einsum("ij,ij->", rows[a + lag:], rows[a:b], dtype=np.float64)
            agree[2 * lag - 1] += np.count_nonzero(tokens[a + lag:] == tokens[a:b])
        n += len(own)
        before = tokens[-REACH:]
    if not n:
        return np.zeros(FEATURES)
    mean = first / n
    return np.concatenate([mean, np.sqrt(np.maximum(second / n - mean * mean, 0)), agree / n])


@dataclass
class Network:
    """Standardisation, two layers and a temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss with weight decay; every fifth row is kept back and fits the temperature.

    No rows, or rows of one label, give a network whose answer is 0.5, or the smoothed share of that label.
    """
    n, wide = x.shape
    rng = np.random.default_rng(7)
    net = Network(np.zeros(wide), np.ones(wide), rng.normal(size=(wide, HIDDEN)) / np.sqrt(wide), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (n + 2)
        net.b2 = float(np.log(share / (1 - share)))
        return net
    back = np.arange(n) % 5 == 4 if n >= 50 else np.zeros(n, dtype=bool)
    net.shift, net.scale = x[~back].mean(axis=0), x[~back].std(axis=0) + 1e-4
    z, t = (x[~back] - net.shift) / net.scale, y[~back]
    w = [net.w1, net.b1, rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.array(0.0)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(1, STEPS + 1):
        hidden = np.tanh(z @ w[0] + w[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ w[2] + w[3], -40, 40))) - t) / len(t)
        back_hidden = np.outer(error, w[2]) * (1 - hidden * hidden)
        grads = [z.T @ back_hidden + 1e-4 * w[0], back_hidden.sum(axis=0), hidden.T @ error + 1e-4 * w[2], error.sum()]
        for i, g in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - 0.02 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = w[0], w[1], w[2], float(w[3])
    if back.any():
        logits, truth = net.logits(x[back]), y[back]
        grid = np.geomspace(0.25, 8, 60)
        loss = [np.mean(np.logaddexp(0, -logits / t) * truth + np.logaddexp(0, logits / t) * (1 - truth)) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass
class Scorer:
    vectors: np.ndarray
    network: Network

    def column(self, text: Column) -> Column:
        """The probability of label 1 for a whole text. A null text counts as empty."""
        vectors, network = self.vectors, self.network

        @F.pandas_udf(DoubleType())
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                pooled = np.array([pool(t, vectors) for t in texts]).reshape(len(texts), FEATURES)
                yield pd.Series(network.probabilities(pooled), dtype="float64")

        return score(text.cast("string"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Scorer:
    """Word vectors from all documents, the network from at most ``train_rows`` labelled rows that are not held out.

    Which labelled rows these are follows from a hash of their ids, not from where they lie. Null labels are left out.
    """
    vectors = context_vectors(docs, text_col)
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(train_rows)

    @F.pandas_udf(ArrayType(FloatType()))
    def pooled(texts: pd.Series) -> pd.Series:
        return pd.Series([pool(t, vectors).astype(np.float32) for t in texts])

    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = named.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", pooled("text").alias("x"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(train_rows).toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), FEATURES)
    return Scorer(vectors, train(x, rows["quality"].to_numpy(dtype=float)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``. Only the text is read for a score.

    A null text counts as empty; all texts without tokens share one score. Repeated ids each get a row. Without labels
    every score is 0.5. No rows give no rows.
    """
    scorer = fit(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), scorer.column(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
