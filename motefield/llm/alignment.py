"""Alignment of two tokenizers over the same bytes by diagonal run skipping, and what the links say about a vocabulary.

Both token sequences cut the same bytes, so each is an array of ends. At the current shift between the two indices, slices of the
arrays are compared in steps that double until they differ, then halve back and end with a walk of a few: one-to-one stretches are jumped without a look at
their tokens. Where the ends part, a group is resolved token by token until both ends meet again; the shift is then what the
group left behind. Counts of linked id pairs are summed over the corpus and joined back, the few frequent pairs by broadcast and
all others by a shuffle in which no key is hot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from .byte_bpe import read_ranks
from .workspace import Workspace

PART_CHARS = 65_536
#: A window of so many ends that differ somewhere is looked through one by one; a larger one is halved.
WALK = 8
ID_BITS = 20
#: A pair is frequent if it owns more than this share of all rows of documents and pairs, so there are at most as many of them.
FREQUENT = 20_000

Run = tuple[int, int, int]
Group = tuple[int, int, int, int]


def spans(a: list[int], b: list[int]) -> tuple[list[Run], list[Group]]:
    """What lies between the common ends of ``a`` and ``b``: ``(i, j, n)`` for a stretch in which ``a[i:i+n]`` and ``b[j:j+n]`` are equal
    ends, one-to-one groups, and ``(i, n, j, m)`` for an irregular group of ``a[i:i+n]`` and ``b[j:j+m]``. The last ends are equal.
    """
    runs: list[Run] = []
    groups: list[Group] = []
    i = j = 0
    size = len(a)
    while i < size:
        end, other = a[i], b[j]
        if end == other:
            run = step = 1
            while i + run < size and a[i + run:i + run + step] == b[j + run:j + run + step]:
                run += step
                step += step
            run = min(run, size - i)
            while step > WALK:
                step >>= 1
                if i + run < size and a[i + run:i + run + step] == b[j + run:j + run + step]:
                    run = min(run + step, size - i)
            while i + run < size and a[i + run] == b[j + run]:
                run += 1
            runs.append((i, j, run))
            i += run
            j += run
        else:
            x, y = i, j
            while end != other:
                if end < other:
                    x += 1
                    end = a[x]
                else:
                    y += 1
                    other = b[y]
            groups.append((i, x + 1 - i, j, y + 1 - j))
            i, j = x + 1, y + 1
    return runs, groups


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + length``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@dataclass
class Alignment:
    """Two sequences of ends cut into groups: where groups end, and the index pairs of overlapping tokens.

    Stretches link their tokens one to one. Inside irregular groups every stretch of bytes between two neighbouring ends of either
    sequence belongs to one token on each side, and those are the links.
    """

    closes_a: np.ndarray
    closes_b: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> Alignment:
        runs, groups = spans(a.tolist(), b.tolist())
        i, j, n = np.array(runs, dtype=np.int64).reshape(-1, 3).T
        of_a, of_b = _ranges(i, n), _ranges(j, n)
        i, n, j, m = np.array(groups, dtype=np.int64).reshape(-1, 4).T
        odd_a, odd_b = _ranges(i, n), _ranges(j, m)
        ends = np.union1d(a[odd_a], b[odd_b])
        closes_a, closes_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        closes_a[of_a] = closes_b[of_b] = closes_a[i + n - 1] = closes_b[j + m - 1] = True
        return cls(closes_a, closes_b, np.concatenate([of_a, odd_a[np.searchsorted(a[odd_a], ends)]]),
                   np.concatenate([of_b, odd_b[np.searchsorted(b[odd_b], ends)]]))

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each token stands when groups are written one after the other, the tokens of ``a`` before those of ``b``."""
        group_a = np.cumsum(self.closes_a) - self.closes_a
        group_b = np.cumsum(self.closes_b) - self.closes_b
        whole_a, whole_b = np.append(0, np.flatnonzero(self.closes_a) + 1), np.append(0, np.flatnonzero(self.closes_b) + 1)
        return np.arange(len(group_a)) + whole_b[group_a], np.arange(len(group_b)) + whole_a[group_b + 1]


def _byte_chars() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: itself where it has a sign, the others from 256 on."""
    signs = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in signs]
    return {chr(b): b for b in signs} | {chr(256 + k): b for k, b in enumerate(others)}


class TokenizerPair:
    """A byte-level BPE (A) and a sentence-piece BPE with byte fallback (B), with the bytes of each of their tokens.

    Long texts are encoded in parts that start with a single blank between two signs: no token of A holds a blank after another
    character, and B is checked for that when it is loaded, so the ids are those of the whole text. ``ranks`` is the vocabulary of A as a
    rank file with its pattern; where given, a faster library encodes texts of ``PLAIN`` characters, which all Unicode tables class alike.
    """

    CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
    #: Latin letters up to Extended-B and what comes before them: no table has changed their classes since Unicode 5.
    PLAIN = re.compile("[\x00-\u024f]*")

    def __init__(self, byte_level: str, pieces: bytes, ranks: tuple[bytes, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=pieces)
        self.plain = tiktoken.Encoding("ranks", pat_str=ranks[1], mergeable_ranks=read_ranks(ranks[0]), special_tokens={}) if ranks else None
        chars = _byte_chars()
        size = self.a.get_vocab_size()
        self.bytes_a = [bytes(chars[c] for c in self.a.id_to_token(i)) if set(self.a.id_to_token(i)) <= chars.keys() else b"" for i in range(size)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = not any(" " in p.lstrip(b" ").decode("utf-8", "replace") for p in self.bytes_b)
        size = max(size, len(self.bytes_b))
        self.followed = {sign: np.array([f"{i}{sign}" for i in range(size)], dtype=object) for sign in ",|;"}
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b))

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts, each without the blank before it."""
        at = 0
        while self.cuts and len(text) - at > PART_CHARS:
            cut = self.CUT.search(text, at + PART_CHARS)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:]

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of A and B; both are empty if the bytes of either differ from a blank and the text."""
        ids_a: list[int] = []
        ids_b: list[int] = []
        for part in self.parts(text) if text else ():
            spaced = " " + part
            b, whole = self.b.encode(part), spaced.encode()
            if b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                return [], []
            if self.plain is not None and self.PLAIN.fullmatch(part):
                a = self.plain.encode_ordinary(spaced)  # ranks of bytes lose none
            else:
                a = self.a.encode_batch_fast([spaced], add_special_tokens=False)[0].ids
                if b"".join(map(self.bytes_a.__getitem__, a)) != whole:
                    return [], []
            ids_a += a
            ids_b += b
        return ids_a, ids_b

    def align(self, a: list[int], b: list[int]) -> tuple[int, np.ndarray, np.ndarray, str]:
        """The number of groups, the linked ids of A and of B, and the groups as text."""
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        found = Alignment.of(np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b]))
        shown = np.empty(len(a) + len(b), dtype=object)
        for ids, closes, at, last in zip((ids_a, ids_b), (found.closes_a, found.closes_b), found.places(), "|;", strict=True):
            shown[at] = np.where(closes, self.followed[last][ids], self.followed[","][ids])
        return int(found.closes_a.sum()), ids_a[found.left], ids_b[found.right], "".join(shown.tolist())[:-1]


_PAIRS: dict[int, TokenizerPair] = {}


def tokenizer_pair(byte_level: str, pieces: bytes, ranks: tuple[bytes, str] | None) -> TokenizerPair:
    """One pair for each worker process and vocabularies."""
    key = hash((byte_level, pieces, ranks))
    if key not in _PAIRS:
        _PAIRS[key] = TokenizerPair(byte_level, pieces, ranks)
    return _PAIRS[key]


ALIGNED = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def align_documents(docs: DataFrame, byte_level: str, pieces: bytes, ranks: tuple[bytes, str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: sizes, digest of the groups, and the distinct linked id pairs with how often each is linked.

    A pair is one number, the id of A shifted by ``ID_BITS`` plus the id of B. ``uid`` numbers rows, so it is stable only once written.
    """
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizer_pair(byte_level, pieces, ranks)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for uid, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                a, b = both.encode(text.as_py() or "")
                if not a:
                    rows.append((uid, doc_id, 0, 0, 0, 0, "", [], []))
                    continue
                groups, left, right, shown = both.align(a, b)
                keys, times = np.unique((left << ID_BITS) + right, return_counts=True)
                digest = hashlib.sha256(shown.encode()).hexdigest()
                rows.append((uid, doc_id, len(a), len(b), groups, len(left), digest, keys, times.astype(np.int32)))
                held += len(keys)
                if held > 500_000:
                    yield _batch(rows, kinds, names)
                    rows, held = [], 0
            yield _batch(rows, kinds, names)

    named = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(run, ALIGNED)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, docs, best``: in how many rows each pair is linked, and whether no other pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = counts.withColumn("a", F.shiftright("pair", ID_BITS))
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    return counts.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def align_corpus(docs: DataFrame, byte_level: str, pieces: bytes, work: Workspace, ranks: tuple[bytes, str] | None = None,
                 id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``byte_level`` is the JSON of tokenizer A, ``pieces`` the model of B, ``ranks`` see :class:`TokenizerPair`. A text that is null, empty, or that A or B do not give back
    byte for byte has no tokens, zeros and an empty digest. Rows with the same or a null id count as documents of their own; other
    columns are not read. Ties for the highest count all count as best. No rows give no rows. A text is one row and fits into one task.
    """
    aligned = work.settle(align_documents(docs, byte_level, pieces, ranks, id_col, text_col), "aligned")
    counts = work.settle(pair_counts(aligned), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    common = F.broadcast(counts.where(F.col("docs") > total // frequent))
    rare = counts.where(F.col("docs") <= total // frequent)
    linked = aligned.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("uid", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))

    def summed(links: DataFrame) -> DataFrame:
        return links.groupBy("uid").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))

    sums = summed(linked.join(common, "pair")).unionByName(summed(linked.join(common.select("pair"), "pair", "left_anti").join(rare, "pair")))
    sums = sums.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256")
