"""The divergence audit against plain counting and its SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference

from motefield.llm import divergence

from .conftest import SMALL
from .test_documents import UPPER


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(rows, least):
    """``rows`` of lang, source, text; every row of the result."""
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = words(text)
        held[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in {k for k, _ in counts}:
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=lambda t: t.encode())
        own = {s: c for (k, s), c in counts.items() if k == lang}

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        for s in own:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s))
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(pairs)]
            terms = sorted(((q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] and p[s][t] > q[t]))[:50]
            out += [(lang, s, "term", t, -v, r + 1) for r, (v, _, t) in enumerate(terms)]
    return out


def sample(seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "B", "é", "É", "ß", "İ", "日本", "x9y", "don't", "naïve", "Zz", "zz", " ", "𝔘", "long" * 20]
    rows = [(["en", "EN", None, "", "de"][rng.integers(5)], [f"s{k}" for k in range(9)][rng.integers(9)] if rng.random() < 0.9 else None,
             " ".join(rng.choice(vocabulary, rng.integers(0, 12)))) for _ in range(300)]
    return rows + [("en", "empty", ""), ("en", "null", None), ("fr", "only", "one one two"), ("it", "a", "1 2 3"), ("it", "b", "rare"), ("it", "b", "rare")]


@pytest.mark.parametrize("bits, tile, least", [(14, 64, 3), (1, 1, 3), (2, 2, 1), (0, 3, 2), (14, 64, 10**6)])
def test_audit(spark, work, bits, tile, least):
    rows = sample()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, number long, block string")
    got = divergence.audit(docs, work, min_documents=least, bits=bits, tile=tile)
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute(rows, least))


def test_sql(spark, work):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert difference(divergence.audit(docs, work), connect(SMALL), divergence.ORACLE_SQL) is None


def test_counts_are_flushed_and_texts_cut(spark, work, monkeypatch):
    monkeypatch.setattr(divergence, "PART_BYTES", 5)
    for text in ("", "a", "abcdefgh", "ab cd ef gh", "éééééé é", "a  b" * 9, "x" * 11 + " y"):
        assert [t.decode() for part in divergence.terms_of(text.encode()) for t in part] == words(text)


def test_no_rows(spark, work):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string"), work).collect() == []


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2] * 8, [1, 2] * 4 + [3, 4] * 4])
    forest = divergence.Forest.build(counts, 16)
    # levels of width 8, 4 and 2: the two kinds of pairs, then their repeats
    assert [len(left) for left, _ in forest.children] == [2, 2, 2, 2] and len(forest.leaves) == 4
    walk = forest.walk(np.array([0]), np.array([1]))
    assert len(walk.a) == 4  # (1,1) (2,2) (1,3) (2,4): sixteen ids, four prices
    price = np.abs(forest.leaves[walk.a] - forest.leaves[walk.b])
    assert walk.total(price).tolist() == [16] and price[walk.at_ids()].tolist() == [0] * 8 + [2] * 8
