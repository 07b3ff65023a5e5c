"""Byte-level BPE as a reduction over a tree of text halves.

A text is encoded in halves down to leaves. The join of two neighbours re-encodes a window around the cut that grows until it
starts and ends at a stable place, and keeps all ids outside it. A place is stable if a letter or digit stands before it and a
space or line feed after it: no match of the pattern holds white space after another character, so every encoding
has a boundary there; and what follows it never depends on what stands before. Decoding concatenates bytes up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

LEAF_CHARS = 4096
LEAF_IDS = 4096
WINDOW = 32


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file of base64 tokens and numbers."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def _stable(text: str, at: int) -> bool:
    return text[at] in " \n" and text[at - 1].isalnum()


class TreeCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        return self._encode(text, 0, len(text), max(leaf, 2)) if text else []

    def _encode(self, text: str, low: int, high: int, leaf: int) -> list[int]:
        if high - low <= leaf:
            return self.encoding.encode_ordinary(text[low:high])
        cut = (low + high) // 2
        return self._join(text, low, cut, high, self._encode(text, low, cut, leaf), self._encode(text, cut, high, leaf))

    def _join(self, text: str, low: int, cut: int, high: int, left: list[int], right: list[int]) -> list[int]:
        """The ids of ``text[low:high]`` from those of its two parts."""
        if _stable(text, cut):
            return left + right
        reach, start, end = WINDOW, None, None
        while start is None or end is None:
            first, last = max(low, cut - reach), min(high, cut + reach)
            if start is None:
                start = next((i for i in range(cut - 1, first, -1) if _stable(text, i)), low if first == low else None)
            if end is None:
                end = next((i for i in range(cut + 1, last) if _stable(text, i)), high if last == high else None)
            reach *= 2
        encode = self.encoding.encode_ordinary
        kept_left = len(left) - len(encode(text[start:cut]))
        return left[:kept_left] + encode(text[start:end]) + right[len(encode(text[cut:end])):]

    def decode(self, ids: list[int], low: int = 0, high: int | None = None) -> bytes:
        high = len(ids) if high is None else high
        if high - low <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids[low:high]))
        cut = (low + high) // 2
        return self.decode(ids, low, cut) + self.decode(ids, cut, high)


_CODECS: dict[int, TreeCodec] = {}


def codec(rank_file: bytes, pattern: str) -> TreeCodec:
    """One codec for each worker process and vocabulary."""
    key = zlib.crc32(rank_file + pattern.encode())
    if key not in _CODECS:
        _CODECS[key] = TreeCodec(read_ranks(rank_file), pattern)
    return _CODECS[key]


CODED = StructType([
    StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
])


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    A null text counts as empty and has no ids; both digests are then those of empty input. Repeated ids each get a row. No
    rows give no rows.
    """

    @F.pandas_udf(CODED)
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = codec(rank_file, pattern)
        shown = [str(i) for i in range(max(tree.tokens, default=0) + 1)]
        for texts in batches:
            rows = []
            for text in texts:
                ids = tree.encode(text or "")
                digest = hashlib.sha256(",".join(map(shown.__getitem__, ids)).encode()).hexdigest()
                rows.append((len(ids), digest, hashlib.sha256(tree.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=CODED.names)

    return docs.select(F.col(id_col).alias("doc_id"), coded(F.col(text_col).cast("string")).alias("coded")).select("doc_id", "coded.*")
