"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. Each block has its word count and link density, those of its neighbours,
whether it is a heading, and whether it stands in a place that markup names (an article, or a menu, footer, notice or the
like). A tree that is grown from a small table of labelled blocks decides which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements by their part in a page.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr math maction menclose mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot "
             "annotation mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
SKIPPED = set("script style noscript template iframe object embed svg annotation canvas audio video select textarea button title head".split())
RAW = set("script style noscript template iframe textarea title svg annotation select button object canvas audio video".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = set("nav header footer aside form menu dialog div section article main ul ol dl table tbody tr td th blockquote figure details fieldset".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BAD_TAGS = set("nav header footer aside form menu dialog fieldset".split())
HARD_TAGS = set("nav footer aside menu dialog".split())
GOOD_TAGS = {"article", "main"}
# A name is a whole word of class, id, role or itemprop; has-sidebar or sticky-header say nothing of what the element holds.
_AROUND = r"(?:(?:site|page|global|main|top|bottom|left|right|primary|secondary|post|article|entry|blog|social|js)[-_]+)?"
_AFTER = r"(?:[-_]+(?:wrapper|wrap|container|box|list|area|section|block|bar|inner|outer|items?|links?|form|buttons?|icons?|panel|unit|slot|message|text|\d+))*"
BAD_NAMES = re.compile(
    _AROUND + r"(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|notification|alert|popup|pop-up|modal|overlay|"
    r"sidebar|side-bar|sidenav|nav\w*|menu\w*|breadcrumbs?|footer|topbar|toolbar|comments?|comment-\w+|disqus\w*|replies|reply|respond|"
    r"social|share|sharing|related|recommend\w*|newsletter|subscribe|subscription|login|signup|widget|pagination|pager|skip-link|copyright|legal|"
    r"contentinfo|complementary|search)" + _AFTER, re.I)
HEADER_NAMES = re.compile(r"(?:(?:site|global|main|top)[-_]+)?(?:header|masthead)" + _AFTER, re.I)
HARD_NAMES = re.compile(
    _AROUND + r"(?:sidebar|side-bar|sidenav|nav\w*|menu\w*|footer|comments?|comment-\w+|disqus\w*|replies|reply|respond|related|recommend\w*|complementary|contentinfo)"
    + _AFTER, re.I)
GOOD_NAMES = re.compile(r"article|articlebody|(?:article|post|entry|story)[-_]+(?:body|content)|main-content|content-body", re.I)
# Elements that a start tag closes if they are open, up to the elements that bound the search.
ENDS_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
P_SCOPE = {"table", "td", "th"}

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:[^'"<>]|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/><]*)([^<>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "heading", "place")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: bool
    place: int
    form: int = 0
    title: bool = False


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(source)}


def _place(tag: str, attributes: dict[str, str], outer: int) -> int:
    """Below 0 in menus, footers and the like, 1 in an article, else 0.

    -2 stays for all inside it but a ``main``; -1 stays up to an article inside it, which the wrapper does not make worse. Ids of
    headings, and of sections inside an article, name what the text is about and do not count.
    """
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
    if hidden:
        return -3
    if outer == -3:
        return outer
    anchor = tag in HEADINGS or (tag == "section" and outer > 0)
    names = " ".join(attributes.get(k, "") for k in ("class", "id", "role", "itemprop") if not (k == "id" and anchor)).split()
    good = tag in GOOD_TAGS or attributes.get("role") == "main" or any(map(GOOD_NAMES.fullmatch, names))
    hard = tag in HARD_TAGS or any(map(HARD_NAMES.fullmatch, names))
    bad = any(map(BAD_NAMES.fullmatch, names)) or (outer <= 0 and any(map(HEADER_NAMES.fullmatch, names)))
    if tag == "main" or (good and outer > -2 and not hard and not (bad and tag not in GOOD_TAGS and not any(map(GOOD_NAMES.fullmatch, names)))):
        return 1
    if hard:
        return min(outer, -2)
    if bad or (tag in BAD_TAGS and not (tag == "header" and outer > 0)):
        return min(outer, -1)
    return outer


class _Reader:
    """Collects the blocks of one page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.links = self.link_depth = 0  # 1 inside a link, 2 inside one that holds whole blocks
        self.opened: Counter = Counter()
        self.heading = self.title = False
        self.form = self.forms = self.linked_before = 0
        self.open: list[tuple[str, int]] = []

    @property
    def place(self) -> int:
        return self.open[-1][1] if self.open else 0

    def flush(self) -> None:
        words = "".join(self.parts).split()
        if words:
            place = max(self.place, -1)
            self.blocks.append(Block(" ".join(words), len(words), min(self.linked, len(words)), self.heading, place, 0 if place else self.form, self.title))
        self.parts, self.linked = [], 0

    def add(self, source: str) -> None:
        if source:
            text = html.unescape(source)
            self.parts.append(text)
            if self.links:
                self.linked += len(text.split())

    def close(self, tags: set[str], scope: set[str]) -> None:
        """End the open elements of ``tags``, with all inside them, that lie within the innermost element of ``scope``."""
        if not any(self.opened[tag] for tag in tags):
            return
        depth = len(self.open)
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                depth = i
            elif self.open[i][0] in scope:
                break
        if depth < len(self.open):
            self.cut(depth)

    def cut(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.opened[tag] -= 1
            if tag == "form":
                self.form = 0
        del self.open[depth:]
        if depth < self.link_depth:  # a link does not outlive the element it was opened in
            self.links = 0

    def start(self, tag: str, source: str) -> None:
        if tag == "a":
            self.links, self.link_depth, self.linked_before = 1, len(self.open), self.linked
        elif tag in ("br", "wbr", "img"):
            self.parts.append(" " if tag == "br" else "")
        elif tag not in INLINE:
            if self.links == 1:  # a link around a block holds on; one with text before the block was left open
                self.links = 2 if self.linked == self.linked_before else 0
            self.flush()
            self.heading, self.title = tag in HEADINGS, tag == "h1"
            if tag in ENDS_P:
                self.close({"p"}, P_SCOPE)
            if tag in ENDS:
                self.close(*ENDS[tag])
        named = source and tag not in VOID and any(k in source.lower() for k in ("class", "id", "role", "hidden", "style", "itemprop"))
        if tag in CONTAINERS or (named and tag not in INLINE and tag not in ("html", "body")):
            if not source.rstrip().endswith("/"):
                place = _place(tag, _attributes(source) if source else {}, self.place)
                if tag == "form" and self.place == 0 and place == -1:
                    self.forms, place = self.forms + 1, 0
                    self.form = self.forms
                self.open.append((tag, place))
                self.opened[tag] += 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag not in INLINE:
            self.flush()
            self.heading = self.title = False
            if self.links == 1:
                self.links = 0
            if self.opened[tag]:
                self.cut(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def settle_forms(self) -> None:
        """A form outside articles is a page's wrapper if it holds a first heading or most of the words, else its blocks are bad."""
        total = sum(b.words for b in self.blocks if b.place >= 0)
        for form in range(1, self.forms + 1):
            held = [b for b in self.blocks if b.form == form]
            if 2 * sum(b.words for b in held) <= total and not any(b.title for b in held):
                for block in held:
                    block.place = -1


def read_blocks(page: str | None) -> list[Block]:
    """The text blocks of a page, in page order. Inline elements and line breaks do not end a block; a cut-off page is read as far as it goes."""
    page, at, reader = page or "", 0, _Reader()
    while True:
        found = MARKUP.search(page, at)
        if not found:
            reader.add(page[at:])
            break
        reader.add(page[at:found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        closing, source = found[1] or found[4], found[3] or found[6] or ""
        if tag in SKIPPED:
            if tag not in INLINE:
                reader.flush()
            if not closing and tag in RAW and not source.rstrip().endswith("/"):
                over = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = over.end() if over else (len(page) if tag in ("script", "style") else at)
        elif tag and closing:
            reader.end(tag)
        elif tag:
            reader.start(tag, source)
    reader.flush()
    reader.settle_forms()
    return reader.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block; a missing neighbour has no words and no links."""
    own = np.array([(b.words, b.linked / b.words) for b in blocks], dtype=float).reshape(len(blocks), 2)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own])[:-1], np.vstack([own, none])[1:]
    rest = np.array([(b.heading, b.place) for b in blocks], dtype=float).reshape(len(blocks), 2)
    return np.hstack([own, before, after, rest])


# Pages of labelled blocks. Each block is its words, words in links, heading (h) or not (-), place
# (a article, n none, b named as something else), and whether it is main text (1) or not (0).
LABELLED = """
6 6 - b 0; 5 0 - b 0; 9 0 h a 1; 60 0 - a 1; 4 0 - a 1; 1 0 - a 1; 85 3 - a 1; 12 0 - b 0
1 1 - b 0; 1 1 - b 0; 9 0 - b 0; 1 0 h a 1; 1 0 - a 1; 2 0 - a 1; 30 0 - a 1; 7 0 - b 0
3 3 - b 0; 3 0 h a 1; 2 0 - a 1; 40 0 - b 0; 25 1 - a 1; 140 0 - a 1; 11 0 - b 0; 30 0 - b 0
8 0 h a 1; 1 0 - a 1; 3 0 - a 1; 2 0 - a 1; 200 0 - a 1; 5 1 - a 1; 80 0 - b 0; 60 0 - b 0; 6 3 - b 0
2 2 - n 0; 2 2 - n 0; 1 1 - n 0; 9 0 h n 1; 55 2 - n 1; 70 0 - n 1; 8 0 h n 1; 40 1 - n 1; 5 5 - n 0; 4 0 - n 0
4 4 - n 0; 6 0 h n 1; 18 0 - n 1; 90 4 - n 1; 33 0 - n 1; 3 3 - n 0; 3 3 - n 0; 7 0 - n 0
1 1 - n 0; 3 0 - n 0; 10 0 h n 1; 120 5 - n 1; 12 0 - n 1; 64 0 - n 1; 9 9 - n 0; 8 8 - n 0; 12 1 - n 0
5 0 - n 0; 4 4 - n 0; 7 0 h n 1; 22 0 - n 1; 30 0 - n 1; 4 0 - n 1; 45 0 - n 1; 6 6 - n 0; 5 0 - n 0
12 12 - n 0; 25 24 - n 0; 6 0 h n 1; 75 1 - n 1; 20 18 - n 0; 16 15 - n 0; 4 0 - n 0
90 0 - b 0; 45 0 - b 0; 20 2 - b 0; 100 0 h b 0; 3 0 - b 0; 15 15 - b 0; 28 0 - n 1; 31 0 - n 1
300 0 - n 1
30 0 - n 1
45 1 - n 1; 60 0 - n 1
12 0 h n 1; 150 2 - n 1; 26 0 - n 1
2 2 - n 0; 80 0 - n 1; 35 0 - n 1; 9 8 - n 0
8 0 h n 1; 100 7 - n 1; 80 0 - n 1; 60 6 - n 1; 45 5 - n 1; 110 14 - n 1; 6 6 - n 0; 30 28 - n 0
4 4 - n 0; 10 0 h n 1; 100 7 - n 1; 35 4 - n 1; 70 14 - n 1; 9 9 - n 0; 40 36 - n 0; 25 20 - n 0
3 3 - n 0; 5 0 h n 1; 90 22 - n 1; 120 30 - n 1; 40 9 - n 1; 60 50 - n 0; 14 11 - n 0; 12 8 - n 0
50 5 - n 1; 25 2 - n 1; 100 25 - n 1; 100 7 - n 1; 7 5 - n 0; 8 8 - n 0; 20 14 - n 0
4 4 - b 0; 6 0 h a 1; 5 5 - a 1; 60 0 - a 1; 2 0 - a 1; 2 2 - a 1; 40 0 - a 1; 2 0 - a 1; 3 3 - a 1; 2 2 - a 1; 4 4 - a 1; 8 0 - b 0
9 0 h a 1; 30 0 - a 1; 2 0 - a 1
4 0 h a 1; 1 0 - a 1
3 0 h a 1; 12 0 - a 1; 1 0 - a 1
6 0 h a 1; 3 3 - a 1
18 0 - n 1
5 0 h a 1; 5 5 - a 1; 60 0 - a 1
7 0 h a 1; 50 0 - a 1; 4 4 - a 1; 30 0 - a 1
8 0 h a 1; 25 0 - a 1; 3 3 - a 1; 2 0 - a 1
4 4 - n 0; 6 0 h n 1; 90 0 - n 1; 9 9 - n 0; 70 0 - n 1
5 0 h a 1; 7 7 - a 1; 1 0 - a 1; 1 1 - a 1; 3 3 - a 1; 2 0 h a 1; 90 3 - a 1; 3 0 h a 1; 6 6 - a 1; 5 5 - a 1; 9 9 - b 0
16 0 - n 1; 20 0 - n 1; 300 0 - n 1; 9 9 - a 1; 12 12 - a 1; 50 0 - a 1; 3 3 - b 0; 2 0 - n 0; 2 2 - n 0
"""


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for line in LABELLED.strip().splitlines():
        blocks = []
        for entry in line.split(";"):
            words, linked, heading, place, label = entry.split()
            blocks.append(Block("", int(words), int(linked), heading == "h", {"a": 1, "n": 0, "b": -1}[place]))
            labels.append(int(label))
        rows.append(features(blocks))
    return np.vstack(rows), np.array(labels)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> tuple:
    """A tree of ``(feature, limit, low side, high side)`` with labels as leaves, split by least Gini impurity."""
    if depth == 0 or len(y) < 4 or y.min() == y.max():
        return (int(2 * y.sum() >= len(y)),)
    best = (np.inf, 0, 0.0)
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            low = x[:, feature] <= limit
            impurity = sum(side.sum() * (m := y[side].mean()) * (1 - m) for side in (low, ~low))
            if impurity < best[0] - 1e-12:
                best = (impurity, feature, float(limit))
    if best[0] == np.inf:
        return (int(2 * y.sum() >= len(y)),)
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def classify(tree: tuple, x: np.ndarray) -> np.ndarray:
    """The leaf of every row."""
    if len(tree) == 1 or not len(x):
        return np.full(len(x), tree[0] if len(tree) == 1 else 0)
    low, out = x[:, tree[0]] <= tree[1], np.zeros(len(x), dtype=int)
    out[low], out[~low] = classify(tree[2], x[low]), classify(tree[3], x[~low])
    return out


def main_text(page: str | None, tree: tuple) -> str:
    blocks = read_blocks(page)
    return "\n".join(b.text for b, keep in zip(blocks, classify(tree, features(blocks)), strict=True) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    A null page, an empty one and one without main text have an empty text. Repeated and null ids each get a row. Other
    columns are not read. No rows give no rows.
    """
    tree = grow(*labelled_table())

    @F.pandas_udf(StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series([main_text(s, tree) for s in sources], dtype=object)

    texts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(F.col(html_col).cast("string")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
