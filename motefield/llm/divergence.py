"""How the sources of a language differ in their words: hash-consed segment trees over term ids, compared pairwise.

The terms that a language keeps are numbered in their order and cut into aligned blocks of ``1 << BITS`` ids. Over each block every
source has a segment tree of its counts; trees of all sources share one store of nodes, in which a node is named by the names of its
children, so equal subtrees are one node wherever they stand. Two trees are walked together from the root; a pair of nodes met again,
at any place, is priced once, and prices are added up the tree. Spark adds the roots over blocks. A task holds the trees of at most two
tiles of ``TILE`` sources over one block, so neither many sources nor many terms meet in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

MIN_DOCUMENTS = 30
SCALE, SMOOTH = 1_000_000_000, 5
BITS = 14
TILE = 64
TOP_TERMS = 50
FLUSH_TERMS = 250_000
PART_BYTES = 4 << 20
#: Bytes of a text to those of its terms: letters in lower case, bytes of other scripts as they are, all else a blank.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in parts of about ``PART_BYTES``, cut between terms."""
    at = 0
    while at < len(text):
        end = at + PART_BYTES
        if end < len(text):
            while end < len(text) and FOLD[text[end]] != 0x20:
                end += 1
        yield text[at:end].translate(FOLD).split()
        at = end


COUNTS = "lang string, source string, term binary, n long, docs long"


def count_terms(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term in each group; nulls count as empty.

    Tasks count in dictionaries of bounded size before the shuffle.
    """
    kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
    names = ["lang", "source", "term", "n", "docs"]

    def flush(table: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, held) in table.items():
            terms = list(n)
            columns = [[lang] * len(terms), [source] * len(terms), terms, list(n.values()), [held[t] for t in terms]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        table.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group, text in zip(groups, batch.column(2), strict=True):
                own: Counter = Counter()
                for part in terms_of(text.as_py()):
                    own.update(part)
                n, held = table.setdefault(group, (Counter(), Counter()))
                size -= len(n)
                n.update(own)
                held.update(own.keys())
                size += len(n)
                if size >= FLUSH_TERMS:
                    yield from flush(table)
                    size = 0
        yield from flush(table)

    partial = _read(docs, lang_col, source_col, text_col).mapInArrow(run, COUNTS)
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _read(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text")))
    return docs.select(lang, source, text.cast("binary").alias("text"))


@dataclass
class Forest:
    """Segment trees of several rows of counts over one block, with one store of nodes.

    ``roots`` names the tree of each row, ``children`` the left and right names of each node, level by level from the root down, and
    ``leaves`` the count of each leaf; the leaf -1 stands for ids beyond the block's last term and costs nothing.
    """

    roots: np.ndarray
    children: list[tuple[np.ndarray, np.ndarray]]
    leaves: np.ndarray

    @classmethod
    def build(cls, counts: np.ndarray, width: int) -> Forest:
        """``counts`` has a row per tree; ids from ``width`` on are padding up to a power of two."""
        size = 1 << max(width - 1, 0).bit_length()
        padded = np.full((len(counts), size), -1, dtype=np.int64)
        padded[:, :width] = counts[:, :width]
        leaves, names = np.unique(padded, return_inverse=True)
        names, levels = names.reshape(padded.shape), []
        while names.shape[1] > 1:
            many = int(names.max()) + 1
            nodes, up = np.unique(names[:, 0::2] * many + names[:, 1::2], return_inverse=True)
            levels.append((nodes // many, nodes % many))
            names = up.reshape(len(names), -1)
        return cls(names[:, 0], levels[::-1], leaves)

    def walk(self, own: np.ndarray, other: np.ndarray) -> Walk:
        """Walk the trees ``own[k]`` and ``other[k]`` of each pair ``k`` together; see :class:`Walk`."""
        pair, a, b = np.arange(len(own)), self.roots[own], self.roots[other]
        folds = []
        for left, right in self.children:
            many = len(self.leaves) if left is self.children[-1][0] else int(max(left.max(), right.max())) + 1
            key = np.concatenate([(pair * many + left[a]) * many + left[b], (pair * many + right[a]) * many + right[b]])
            met, up = np.unique(key, return_inverse=True)
            folds.append(up)
            pair, a, b = met // many // many, met // many % many, met % many
        return Walk(pair, a, b, folds)


@dataclass
class Walk:
    """The distinct pairs of leaves that walks met, and how they fold into the pairs of nodes above."""

    pair: np.ndarray
    a: np.ndarray
    b: np.ndarray
    folds: list[np.ndarray]

    def total(self, price: np.ndarray) -> np.ndarray:
        """The price of each walk from the prices of the leaf pairs; a pair of nodes is added once, however often it was met."""
        for up in reversed(self.folds):
            price = price[up[:len(up) // 2]] + price[up[len(up) // 2:]]
        return price

    def at_ids(self) -> np.ndarray:
        """For a single walk: the leaf pair at each id."""
        at = np.zeros(1, dtype=np.int64)
        for up in self.folds:
            half = len(up) // 2
            at = np.stack([up[:half][at], up[half:][at]], axis=1).ravel()
        return at


def shares(leaves: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The smoothed share of each count in a group of ``total`` occurrences of ``terms`` terms, exactly; padding has 0."""
    wide = leaves.astype(object)
    return np.where(leaves < 0, 0, SCALE * (wide + SMOOTH) // max(total + SMOOTH * terms, 1) + 1).astype(np.int64)


PRICED = "lang string, source string, part string, other string, block long, slot int, term string, value long"


def price_block(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """All pairs of sources of two tiles over one block; on the diagonal, also each source's leading terms against the language.

    ``counts`` has ``number, slot, n, term`` and ``groups`` has ``number, tile, source, total, terms, first, width``; the language itself is number 0. The terms of
    a language fill its slots of a block from ``first`` on without gaps.
    """
    lang, block, low, high = (k.as_py() for k in key)
    groups = groups.sort_by("number")
    numbers, tiles = groups["number"].to_numpy(), groups["tile"].to_numpy()
    sources, first, width = groups["source"].to_pylist(), groups["first"][0].as_py(), groups["width"][0].as_py()
    matrix = np.zeros((len(numbers), max(width, 1)), dtype=np.int64)
    matrix[np.searchsorted(numbers, counts["number"].to_numpy()), counts["slot"].to_numpy() - first] = counts["n"].to_numpy()
    forest = Forest.build(matrix, width)
    priced = np.stack([shares(forest.leaves, t, v) for t, v in zip(groups["total"].to_pylist(), groups["terms"].to_pylist(), strict=True)])
    of_lang = counts.filter(pc.equal(counts["number"], 0))
    names = dict(zip(pc.subtract(of_lang["slot"], first).to_pylist(), of_lang["term"].to_pylist(), strict=True))
    rows: list[tuple] = []
    for i in np.flatnonzero((numbers > 0) & (tiles == low)):
        others = np.flatnonzero((numbers > 0) & (tiles == high))
        others = others[others > i]
        if len(others):
            walk = forest.walk(np.full(len(others), i), others)
            leaf = np.abs(priced[i][walk.a] - priced[others[walk.pair], walk.b])
            rows += [(lang, sources[i], "pair", sources[j], None, None, v) for j, v in zip(others, walk.total(leaf).tolist(), strict=True)]
        if low == high and width:
            walk = forest.walk(np.array([i]), np.array([0]))
            gap = priced[i][walk.a] - priced[0][walk.b]
            gap = np.where(forest.leaves[walk.a] > 0, gap, 0)[walk.at_ids()]
            slots = np.flatnonzero(gap > 0)
            slots = slots[np.lexsort((slots, -gap[slots]))][:TOP_TERMS]
            rows += [(lang, sources[i], "term", None, first + s, names[s], v) for s, v in zip(slots.tolist(), gap[slots].tolist(), strict=True)]
    columns = list(zip(*rows, strict=True)) or [()] * 7
    columns.insert(4, [block] * len(rows))
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
    names_out = [field.split()[0] for field in PRICED.split(", ")]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names_out)


def number_terms(kept: DataFrame, bits: int, work: Workspace) -> DataFrame:
    """``lang, term, n, block, slot``: the terms numbered without gaps in the order of language and term, in blocks of ``1 << bits``.

    Sorted ranges are numbered side by side; what comes before a range is a sum over the ranges. So blocks follow from the terms alone.
    """
    ranges = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").withColumn("id", F.monotonically_increasing_id())
    ranges = work.settle(ranges.select("lang", "term", "n", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place")), "ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("place")
    return ranges.join(before, "part").select("lang", "term", "n", F.shiftright(number, bits).alias("block"), number.bitwiseAND((1 << bits) - 1).cast("int").alias("slot"))


def audit(docs: DataFrame, work: Workspace, min_documents: int = MIN_DOCUMENTS, bits: int = BITS, tile: int = TILE,
          lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets each group of documents apart.

    Part ``pair``: each other source of the language with the sum of the absolute differences of shares over all kept terms (0 without any).
    Part ``term``: the group's own terms whose share is above that of the language, at most ``TOP_TERMS``. Ranks run by value, then item. A null
    lang, source or text counts as empty; a group without terms has all its pairs; a source alone in its language has no rows. Repeated
    rows count each. Other columns are not read. No rows give no rows.
    """
    counts = work.settle(count_terms(docs, lang_col, source_col, text_col), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_documents).drop("docs")
    kept = work.settle(kept, "kept")
    terms = work.settle(number_terms(kept, bits, work), "terms")
    rows = work.settle(counts.drop("docs").join(terms.drop("n"), ["lang", "term"]).select("lang", "source", "block", "slot", "n"), "rows")

    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    groups = _read(docs, lang_col, source_col, text_col).select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = work.settle(groups.na.fill(0, ["total", "terms", "lang_total"]).withColumn("number", number).withColumn("tile", F.floor((number - 1) / tile).cast("int")), "groups")

    # one more block without terms for each language, so that a language that keeps none has its pairs, too
    blocks = terms.groupBy("lang", "block").agg(F.min("slot").alias("first"), F.count(F.lit(1)).cast("int").alias("width")).unionByName(
        groups.select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("first"), F.lit(0).alias("width")).distinct())
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    paired = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, "tile").alias("low"), F.greatest(t, "tile").alias("high"))))
    tasks = groups.join(tiles, "lang").select("lang", "source", "number", "tile", "total", "terms", paired.alias("task")).select("*", "task.*").drop("task")
    whole = groups.groupBy("lang").agg(F.first("lang_total").alias("total"), F.first("terms").alias("terms")).join(tiles, "lang").select(
        "lang", F.lit(None).cast("string").alias("source"), F.lit(0).alias("number"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "total", "terms")
    whole = whole.withColumn("low", F.col("tile")).withColumn("high", F.col("tile"))
    members = work.settle(tasks.unionByName(whole).join(blocks, "lang"), "members")
    of_groups = rows.join(tasks.select("lang", "source", "number", "low", "high"), ["lang", "source"]).select(
        "lang", "block", "low", "high", "number", "slot", "n", F.lit(None).cast("string").alias("term"))
    of_langs = terms.join(whole.select("lang", "low", "high"), "lang").select("lang", "block", "low", "high", F.lit(0).alias("number"), "slot", "n", "term")
    key = ["lang", "block", "low", "high"]
    n_tasks = members.select(*key).distinct().count()
    dealt = of_groups.unionByName(of_langs).repartition(max(n_tasks, 1), *key)
    priced = work.settle(dealt.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(price_block, PRICED), "priced")

    sums = priced.where("part = 'pair'").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")).withColumnRenamed("other", "item")
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    leading = priced.where("part = 'term'").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "block", "slot"))).where(F.col("rank") <= TOP_TERMS)
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        leading.select("lang", "source", "part", F.col("term").alias("item"), "value", "rank"))


ORACLE_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
    FROM documents
), held AS (
    SELECT d, lang, source, term, count(*) AS n FROM (SELECT d, lang, source, unnest(words) AS term FROM docs) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS n FROM held GROUP BY lang, term HAVING count(*) >= {MIN_DOCUMENTS}
), vocab AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, sum(held.n) AS n FROM held JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
    SELECT lang, source, term, coalesce(c.n, 0) AS n,
        1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTH})::HUGEINT) // (g.total + {SMOOTH} * v)::HUGEINT AS p
    FROM groups g JOIN vocab USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), lang_shares AS (
    SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + {SMOOTH})::HUGEINT) // (total + {SMOOTH} * v)::HUGEINT AS q FROM kept JOIN vocab USING (lang)
), gaps AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
