"""Main text of web pages: flat text blocks, classified by a decision tree from their own and their neighbours' measures.

A page is cut into blocks at the borders of block elements. Each block has a number of words and a link density (the
share of its words inside links); the tree sees those of the block, the block before and the block after (shallow
text features: Kohlschuetter, Fankhauser and Nejdl, 2010), and whether its containers say what they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role.
RAW = {"script", "style", "noscript", "template", "svg", "textarea", "iframe", "object", "select", "title", "math"}
CONTAINERS = {"div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table",
              "figure", "details", "dialog", "menu", "fieldset", "blockquote", "body"}
BLOCKS = CONTAINERS | {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "caption", "dt", "dd", "pre", "hr",
                       "figcaption", "address", "summary", "legend", "option", "head", "html", "center", "thead", "tbody"}
SPACES = {"br", "wbr", "img", "input", "button"}
BESIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
INSIDE = {"article", "main"}
# Words in class, id and role that name what stands beside an article.
BESIDE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion",
                "sidebar", "comment", "comments", "cookie", "cookies", "notice", "consent", "menu", "nav", "navbar",
                "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "share", "social", "related",
                "newsletter", "subscribe", "popup", "modal", "widget", "disqus", "complementary", "contentinfo", "search"}
# Words before a name that say what a page or wrapper has or lacks ("has-sidebar", "no-ads").
ABOUT = {"has", "have", "no", "not", "with", "without", "hide", "show"}
# Names of what may well be longer than the article.
THREADS = {"comment", "comments", "disqus"}
#: A container with more than this share of a page's words is a wrapper of the page if nothing else says where the article is.
MOST = 0.5

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+|[^>]*)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

#: Measures of a block, in the order of the table's columns.
MEASURES = ("words", "links", "words before", "links before", "words after", "links after", "beside", "inside", "elsewhere")
# A small labelled table, judged by hand: words and link density of a block, of the one before, of the one after;
# 1 if a container says it stands beside the article, 1 if one says it is inside it, 1 if the page has such a container
# and the block is outside; 1 if the block is main text.
LABELLED = """
120 0.00  90 0.00 110 0.00 0 0 0 1    45 0.05  60 0.00  80 0.02 0 0 0 1    30 0.00   8 0.00  70 0.00 0 0 0 1
 22 0.10  40 0.00  35 0.10 0 0 0 1     9 0.00  50 0.00  64 0.00 0 0 0 1     6 0.00  30 0.00  48 0.00 0 0 0 1
  3 0.00  80 0.05  90 0.00 0 0 0 1     1 0.00  55 0.00  41 0.00 0 0 0 1    12 0.00   5 0.00  95 0.00 0 0 0 1
  8 0.00   3 1.00 120 0.00 0 0 0 1    60 0.02   4 1.00  30 0.00 0 0 0 1    75 0.00  33 0.00   5 1.00 0 0 0 1
 52 0.08   2 1.00  12 0.50 0 0 0 1    28 0.20  44 0.00  51 0.10 0 0 0 1    14 0.00  25 0.00   6 0.00 0 0 0 1
200 0.01   0 0.00   0 0.00 0 0 0 1    18 0.00   0 0.00  90 0.00 0 0 0 1    46 0.30  70 0.05  66 0.02 0 0 0 1
 60 0.00  50 0.00   1 0.00 0 0 0 1    35 0.00   3 1.00   2 0.00 0 0 0 1    25 0.00   0 0.00   3 0.00 0 0 0 1
 80 0.00  10 0.00   4 1.00 0 0 0 1    19 0.00  60 0.00   2 0.00 0 0 0 1    90 0.05   2 1.00   3 1.00 0 0 0 1
 40 0.10  16 0.00   1 1.00 0 0 0 1    17 0.00   4 0.00   0 0.00 0 0 0 1    55 0.00   0 0.00   0 0.00 0 0 0 1
  1 1.00   1 1.00   1 1.00 0 0 0 0     2 1.00   1 1.00   3 1.00 0 0 0 0     4 1.00   0 0.00   2 1.00 0 0 0 0
  3 0.80   2 1.00  60 0.00 0 0 0 0     9 0.90   6 1.00   8 1.00 0 0 0 0    15 0.75  12 0.80  10 0.90 0 0 0 0
  2 0.00   1 1.00   2 1.00 0 0 0 0     5 0.00   3 1.00   4 1.00 0 0 0 0     7 0.20   2 1.00   3 1.00 0 0 0 0
  4 0.00   2 0.50   3 0.00 0 0 0 0     6 0.10   4 0.00   0 0.00 0 0 0 0     3 0.00   3 0.00   2 0.00 0 0 0 0
 25 0.60  18 0.70  20 0.50 0 0 0 0    40 0.80  70 0.00   4 1.00 0 0 0 0    11 0.00   6 1.00   2 0.00 0 0 0 0
120 0.00  90 0.00 110 0.00 0 1 0 1    30 0.05  12 0.00   9 0.00 0 1 0 1     1 0.00  14 0.00  10 0.00 0 1 0 1
  2 0.00   5 1.00  11 0.00 0 1 0 1     9 0.00   3 1.00   7 0.00 0 1 0 1     4 1.00  30 0.00  25 0.00 0 1 0 1
  6 0.50   8 0.00   4 0.00 0 1 0 1    20 0.00   0 0.00   0 0.00 0 1 0 1     3 0.00   2 0.00   3 1.00 0 1 0 1
 70 0.90  60 0.00  50 0.00 0 1 0 1     5 0.00   6 0.00  12 0.30 0 1 0 1    12 0.00  13 0.00   5 1.00 0 1 0 1
120 0.00  90 0.00 110 0.00 1 0 0 0    16 0.00   1 1.00  12 0.00 1 0 0 0     2 1.00   3 1.00   2 1.00 1 0 0 0
 35 0.00  60 0.00   4 0.00 1 0 0 0     1 0.00   2 0.00   3 0.00 1 0 0 0    80 0.10  40 0.00  50 0.00 1 0 1 0
 14 0.00   1 1.00   9 0.00 1 0 1 0    10 0.00  70 0.00   0 0.00 1 0 1 0     3 1.00   2 1.00   2 1.00 1 0 1 0
 45 0.00  90 0.00  60 0.00 1 1 0 0    25 0.10  33 0.00  28 0.00 1 1 0 0     4 0.00  51 0.00  62 0.00 1 1 0 0
  8 1.00  20 0.00   9 1.00 1 1 0 0    18 0.00   3 0.00  22 0.00 1 1 0 0     2 0.00   9 0.00   1 0.00 1 1 0 0
 30 0.00   3 1.00  90 0.00 0 0 1 0    12 0.00  70 0.00   0 0.00 0 0 1 0     2 1.00   1 1.00   3 1.00 0 0 1 0
 64 0.00  45 0.00  10 0.00 0 0 1 0     5 0.00   2 0.00   4 0.00 0 0 1 0    22 0.05  80 0.00  30 0.10 0 0 1 0
"""


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows = np.array(LABELLED.split(), np.float64).reshape(-1, len(MEASURES) + 1)
    return rows[:, :-1], rows[:, -1].astype(np.int64)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A binary tree by Gini impurity: (measure, limit, low side, high side), or a label at a leaf."""
    if depth == 0 or (y == y[0]).all():
        return int(2 * y.sum() > len(y))
    best = None
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, column] <= limit
            parts = [y[low], y[~low]]
            impurity = sum(len(p) * 2 * p.mean() * (1 - p.mean()) for p in parts)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, column, float(limit), low)
    if best is None:
        return int(2 * y.sum() > len(y))
    _, column, limit, low = best
    return column, limit, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def decide(tree, x: np.ndarray) -> np.ndarray:
    """The tree's label for each row."""
    if isinstance(tree, int):
        return np.full(len(x), tree)
    column, limit, low_side, high_side = tree
    low = x[:, column] <= limit
    out = np.empty(len(x), np.int64)
    out[low], out[~low] = decide(low_side, x[low]), decide(high_side, x[~low])
    return out


def _names(attributes: str) -> set[str]:
    """The BESIDE_NAMES in class, id and role of an element, without those that a word of ABOUT stands before."""
    out = set()
    for value in _NAMES.findall(attributes):
        for token in value.lower().split():
            for part in re.findall("[a-z]+", token):
                if part in ABOUT:
                    break
                out.add(part)
    return out & BESIDE_NAMES


class _Container:
    """An element: what it says of itself, the words in it, and the element around it."""

    def __init__(self, name: str, attributes: str, around: _Container | None):
        named = _names(attributes) if name != "body" else set()
        self.name, self.around, self.words = name, around, 0
        self.beside, self.inside = name in BESIDE or bool(named), name in INSIDE
        self.may_wrap, self.thread = name not in BESIDE - {"form"}, bool(named & THREADS)


def _settle(held: list[_Container], words: int) -> None:
    """Count the words of the elements, given in the order they open, and hand on to them what those around them say.

    Wrappers of the whole page or of its article are not beside it, whatever they are called. The article is the
    article or main element with the most words, if there is one.
    """
    for c in reversed(held):
        if c.around:
            c.around.words += c.words
    article = max((c for c in held if c.inside and not c.beside), key=lambda c: c.words, default=None)
    wrappers, at = set(), article
    while at:
        wrappers.add(at)
        at = at.around
    for c in held:
        if c.beside and c.may_wrap:
            c.beside = not (c in wrappers if article else c.words > MOST * words and not c.thread)
        if c.around:
            c.beside, c.inside = c.beside or c.around.beside, c.inside or c.around.inside


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """The text blocks of a page in order, and their measures. Tags may be left open or closed twice."""
    texts, facts = [], []
    stack: list[_Container] = []
    held: list[_Container] = []
    pieces: list[str] = []
    linked: list[bool] = []
    link, at = False, 0

    def close() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            in_links = sum(len(p.split()) for p, a in zip(pieces, linked) if a)
            words = len(text.split(" "))
            texts.append(text)
            facts.append((words, min(in_links / words, 1.0), stack[-1] if stack else None))
            if stack:
                stack[-1].words += words
        pieces.clear()
        linked.clear()

    while at < len(page):
        tag = _TAG.search(page, at)
        end = tag.start() if tag else len(page)
        if end > at:
            pieces.append(unescape(page[at:end]))
            linked.append(link)
        if tag is None:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in RAW and not tag[1]:
            if not tag[3].endswith("/"):
                shut = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = shut.end() if shut else len(page)
            continue
        if name == "a":
            link = not tag[1]
        elif name in SPACES:
            pieces.append(" ")
            linked.append(link)
        elif name in BLOCKS:
            close()
            link = False
            if name in CONTAINERS:
                if not tag[1]:
                    stack.append(_Container(name, tag[3], stack[-1] if stack else None))
                    held.append(stack[-1])
                elif any(c.name == name for c in stack):
                    while stack.pop().name != name:
                        pass
    close()
    if not texts:
        return [], np.zeros((0, len(MEASURES)))
    _settle(held, sum(f[0] for f in facts))
    own = np.array([(n, links, c is not None and c.beside, c is not None and c.inside) for n, links, c in facts], np.float64)
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own[:-1, :2]]), np.vstack([own[1:, :2], edge])
    elsewhere = (own[:, 3] == 0) & (own[:, 3].any())
    return texts, np.hstack([own[:, :2], before, after, own[:, 2:], elsewhere[:, None]])


def main_text(page: str | None, tree) -> tuple[str, int, int]:
    """(main text, blocks kept, blocks in all) of a page."""
    texts, measures = blocks(page or "")
    keep = decide(tree, measures) if texts else []
    kept = [t for t, k in zip(texts, keep) if k]
    return "\n".join(kept), len(kept), len(texts)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points), n_kept and n_blocks.

    One pass where the rows are read. Null, empty and tag-only pages give an empty text. Ids and urls are handed
    through, nulls and repeats included. White space is what Unicode calls so. An empty table gives no rows.
    """
    tree = grow(*labelled_table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py(), tree) for page in batch.column(2)]
            texts, kept, total = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(kept, pa.int64()), pa.array(total, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_kept", "n_blocks"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_kept long, n_blocks long")
