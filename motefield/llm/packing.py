"""Packing of token sequences by minimum bin slack.

Each document is tokenized once and cut into pieces of ``WINDOW`` ids and one remainder. How many pieces there are of each
length is all that the packing needs: at most ``WINDOW`` counts, whatever the size of the corpus. For the longest length left, a
bitset subset-sum over the lengths and their counts finds the fill closest to the window; the counts of lengths are read back from the
saved bitsets, and that fill is repeated as often as the counts allow. A piece then finds its place from its rank among
the pieces of its length.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .workspace import Workspace

WINDOW = 4096
END_ID = 2
CACHE_WORDS = 250_000
#: Characters encoded together, and rows taken at a time for each 4,000 of them: more of them share words and need more memory.
BATCH_CHARS = 2_000_000
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, slot long"


class WordEncoder:
    """Encodes with a byte-level tokenizer whose text pieces never reach over white space, word by word.

    The distinct words of a batch are looked up in a cache of two generations: when the newer is full, the older goes. A new word is normalised, cut by the
    tokenizer's own pattern, and each piece goes to the library's merge model. Texts with the control characters that Arrow takes
    for blanks and the tokenizer does not, or with a mark such as ``<|endoftext|>``, go to the library whole.
    """

    ODD = regex.compile("[\x1c-\x1f]")

    def __init__(self, definition: str, cache_words: int = CACHE_WORDS):
        self.tokenizer = Tokenizer.from_str(definition)
        self.merge = self.tokenizer.model.tokenize
        self.marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        split = json.loads(definition)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        self.byte_chars = _byte_chars()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _is_odd(self, text: str) -> bool:
        return self.ODD.search(text) is not None or any(mark in text for mark in self.marks)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part) or self.older_parts.get(part)
        if ids is None:
            shown = part if part.isascii() else "".join(map(self.byte_chars.__getitem__, part.encode()))
            ids = self.parts[part] = array("I", [t.id for t in self.merge(shown)]).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if word.isascii():
            word = word.lower()
            if word.isalpha():
                return self._part(word)
        else:
            word = self.tokenizer.normalizer.normalize_str(word)
        return b"".join(map(self._part, self.pieces(word)))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        if len(self.words) > self.cache_words // 2:
            self.words, self.older_words = {}, self.words
        if len(self.parts) > self.cache_words // 2:
            self.parts, self.older_parts = {}, self.parts
        cache, older, found = self.words, self.older_words, []
        for word in words:
            ids = cache.get(word)
            if ids is None:
                ids = older.get(word)
                ids = cache[word] = self._word(word) if ids is None else ids
            found.append(ids)
        return found

    def encode(self, texts: list[str], batch_chars: int = BATCH_CHARS) -> Iterator[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for part in _portions(texts, batch_chars):
            odd = [self._is_odd(t) for t in part]
            plain = ["" if o else t for t, o in zip(part, odd, strict=True)]
            lists = pc.utf8_split_whitespace(pa.array(plain, pa.large_string()))
            words = lists.flatten().dictionary_encode()
            ids = self._encode_words(words.dictionary.to_pylist())
            lengths = np.array([len(i) // 4 for i in ids], dtype=np.int64)
            pool, first = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(lengths) - lengths
            which = words.indices.to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy()
            for text, whole, a, b in zip(part, odd, bounds[:-1], bounds[1:], strict=True):
                if whole:
                    yield np.frombuffer(self._ids(text), dtype="<u4")
                else:
                    yield _gather(pool, first, lengths, which[a:b])


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it has a sign, else 256 and up."""
    signs = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in signs else next(others)) for b in range(256)]


def _portions(texts: list[str], batch_chars: int) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= batch_chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _gather(pool: np.ndarray, first: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of the words ``which``, one after the other."""
    counts = lengths[which]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.arange(total) + np.repeat(first[which] - (ends - counts), counts)]


_ENCODERS: dict[int, WordEncoder] = {}


def encoder(definition: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


def cut_pieces(docs: DataFrame, definition: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
               batch_chars: int = BATCH_CHARS) -> DataFrame:
    """A row for each piece. ``slot`` is its rank among the pieces of its length and ``task``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, slots = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        some = max(batch_chars // 4000, 1)
        for batch in (whole.slice(at, some) for whole in batches for at in range(0, whole.num_rows, some)):
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(definition).encode(texts, batch_chars), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), task, int(slots[len(piece)])))
                    slots[len(piece)] += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


@dataclass
class Segment:
    """Ranks ``low`` to ``high`` of a length go, ``uses`` to a sequence, into sequences from ``sequence`` on at ``offset``."""

    low: int
    high: int
    uses: int
    sequence: int
    offset: int


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to use each length so that the sum comes closest to ``room`` from below.

    Bit ``s`` of a bitset says that some choice sums to ``s``. Counts are split into powers of two; the bitset before each
    such item is kept and the choice is read back from the last one.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, take = left - take, take * 2
            if reach >> room:
                break
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> dict[int, list[Segment]]:
    """Segments by length for ``counts`` pieces of each length; every round empties a length or repeats its fill to the end."""
    left, sequence = {n: c for n, c in counts.items() if c}, 0
    taken: dict[int, int] = dict.fromkeys(left, 0)
    plan: dict[int, list[Segment]] = {n: [] for n in left}
    while left:
        seed = max(left)
        rest = left | {seed: left[seed] - 1}
        used = closest_fill({n: c for n, c in rest.items() if c}, window - seed)
        used[seed] = used.get(seed, 0) + 1
        repeats, offset = min(left[n] // k for n, k in used.items()), 0
        for length, uses in sorted(used.items(), reverse=True):
            plan[length].append(Segment(taken[length], taken[length] + uses * repeats, uses, sequence, offset))
            taken[length] += uses * repeats
            left[length] -= uses * repeats
            offset += uses * length
            if not left[length]:
                del left[length]
        sequence += repeats
    return plan


def pack(docs: DataFrame, definition: str, work: Workspace, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         batch_chars: int = BATCH_CHARS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``definition`` is the JSON of a tokenizer. A null text is empty and has the closing id only. Ids of documents may be null or
    repeated; such rows are packed like others. A document is one row, so its ids fit into one task. No rows give no rows.
    """
    pieces = work.settle(cut_pieces(docs, definition, window, id_col, text_col, batch_chars), "pieces")
    by_task = work.settle(pieces.groupBy("task", "length").count(), "by-task")
    counts = {r["length"]: r["pieces"] for r in by_task.groupBy("length").agg(F.sum("count").alias("pieces")).collect()}
    plan = plan_windows(counts, window)
    before = "coalesce(sum(count) OVER (PARTITION BY length ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    first = by_task.select("task", "length", F.expr(before).alias("first"))
    ranked = pieces.join(first, ["task", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("slot")).alias("rank"))
    highs = {n: [s.high for s in segments] for n, segments in plan.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences, offsets = [], []
            for length, rank in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist(), strict=True):
                s = plan[length][bisect_left(highs[length], rank + 1)]
                at, use = divmod(rank - s.low, s.uses)
                sequences.append(s.sequence + at)
                offsets.append(s.offset + use * length)
            columns = [*(batch.column(i) for i in range(5)), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    placed = ranked.withColumn("length", F.col("length").cast("long"))
    return placed.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
