"""Cross-tokenizer alignment against a version that compares every token with every other."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motefield.llm import alignment

from .conftest import SMALL
from .test_documents import read

BYTE_LEVEL, PIECES = read("byte_bpe_50k.json").decode(), read("piece_bpe_32k.model")
RANKS = (read("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
PAIR, FAST = alignment.TokenizerPair(BYTE_LEVEL, PIECES), alignment.TokenizerPair(BYTE_LEVEL, PIECES, RANKS)


def cuts(lengths):
    found, at = [], 0
    for n in lengths:
        found.append((at, at + n))
        at += n
    return found


def brute(text):
    """Ids of both, index pairs of overlapping tokens, and the groups as text; straight from the libraries."""
    if not text:
        return [], [], [], ""
    a = PAIR.a.encode(" " + text, add_special_tokens=False).ids
    b = PAIR.b.encode(text)
    if any(b"".join(table[i] for i in ids) != (" " + text).encode() for table, ids in ((PAIR.bytes_a, a), (PAIR.bytes_b, b))):
        return [], [], [], ""
    at, bt = cuts([len(PAIR.bytes_a[i]) for i in a]), cuts([len(PAIR.bytes_b[i]) for i in b])
    links = [(i, j) for i, (s, e) in enumerate(at) for j, (u, v) in enumerate(bt) if s < v and u < e]
    common = sorted({e for _, e in at} & {e for _, e in bt})
    shown, low = [], 0
    for end in common:
        shown.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, spans, strict=True) if low <= s and e <= end) for ids, spans in ((a, at), (b, bt))))
        low = end
    return a, b, links, ";".join(shown)


def expected(texts):
    parts = [brute(t) for t in texts]
    docs = Counter(p for a, b, links, _ in parts for p in {(a[i], b[j]) for i, j in links})
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    for a, b, links, shown in parts:
        pairs = [(a[i], b[j]) for i, j in links]
        yield (len(a), len(b), shown.count(";") + 1 if a else 0, len(links), sum(docs[p] == best[p[0]] for p in pairs), sum(docs[p] for p in pairs),
               hashlib.sha256(shown.encode()).hexdigest() if a else "")


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD_SPACES = ["▁ stays", "a\x00b", "  two  blanks ", "　wide blank", "ﬁ ﬀ é́", "<unk> <0x41> <s></s>", "� x", "x" * 700, "日本語のテキスト" * 40]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 3, 10**9])
def test_odd_texts(spark, work, odd, frequent):
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD_SPACES)], "doc_id long, text string"))
    docs = docs.where("text IS NULL OR length(text) < 2000")
    rows = [tuple(r) for r in docs.collect()]
    want = Counter((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows]), strict=True))
    got = alignment.align_corpus(docs.withColumn("pair", docs.doc_id), BYTE_LEVEL, PIECES, work, frequent=frequent)
    assert Counter(tuple(r) for r in got.select("doc_id", *COLUMNS).collect()) == want


def test_documents(spark, work):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 1500")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {i: e for (i, _), e in zip(rows, expected([t for _, t in rows]), strict=True)}
    got = alignment.align_corpus(docs, BYTE_LEVEL, PIECES, work, RANKS)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got.collect()} == want and len(want) > 50


def test_no_rows(empty, work):
    assert alignment.align_corpus(empty, BYTE_LEVEL, PIECES, work).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=60), st.lists(st.booleans(), min_size=1, max_size=60))
def test_spans_are_the_common_ends(in_a, in_b):
    size = max(len(in_a), len(in_b)) + 1
    a = [k + 1 for k, x in enumerate(in_a) if x] + [size + 1]
    b = [k + 1 for k, x in enumerate(in_b) if x] + [size + 1]
    found = alignment.Alignment.of(np.array(a), np.array(b))
    assert found.closes_a.sum() == found.closes_b.sum() == len(set(a) & set(b))
    assert [x for x, closed in zip(a, found.closes_a, strict=True) if closed] == sorted(set(a) & set(b))
    overlaps = [(i, j) for i in range(len(a)) for j in range(len(b)) if max([0, *a][i], [0, *b][j]) < min(a[i], b[j])]
    assert sorted(zip(found.left.tolist(), found.right.tolist(), strict=True)) == overlaps
    assert sorted(np.concatenate(found.places())) == list(range(len(a) + len(b)))
    runs, groups = alignment.spans(a, b)
    assert all(a[i:i + n] == b[j:j + n] for i, j, n in runs) and all(a[i] != b[j] and a[i + n - 1] == b[j + m - 1] for i, n, j, m in groups)
    # a stretch is jumped as a whole: between two of them stands an irregular group
    assert len(runs) <= len(groups) + 1


PIECES_OF_TEXT = ["word", "Words,", "12", " ", "  ", "\n", "\t", "é", "日本", "語", ".", "don't", "\x1c", "\x85", "\u2003", "\u00a0", "\u200b", "\u180e", "_", "x" * 30, "<|endoftext|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES_OF_TEXT), min_size=1, max_size=40), st.sampled_from(["", " "]), st.sampled_from([PAIR, FAST]))
def test_parts_give_the_ids_of_the_whole(pieces, glue, pair):
    text = glue.join(pieces)
    before, alignment.PART_CHARS = alignment.PART_CHARS, 7
    try:
        assert " ".join(pair.parts(text)) == text
        assert pair.encode(text) == (PAIR.a.encode(" " + text, add_special_tokens=False).ids, PAIR.b.encode(text))
    finally:
        alignment.PART_CHARS = before


def test_both_libraries_agree_on_plain_characters():
    """Every plain character between letters, digits, signs and blanks: the classes of the pattern and the merges are the same."""
    around = ["", "a", "1", "%", " ", "\n", "é"]
    texts = [x + chr(c) + y for c in range(0x250) for x in around for y in around]
    assert all(FAST.PLAIN.fullmatch(t) for t in texts) and not FAST.PLAIN.fullmatch("\u0250")
    of_json = [e.ids for e in PAIR.a.encode_batch(texts, add_special_tokens=False)]
    assert [FAST.plain.encode_ordinary(t) for t in texts] == of_json


def test_vocabularies_are_parameters():
    assert public_tokenizers.path("piece_bpe_32k.model").endswith("piece_bpe_32k.model") and PAIR.cuts
