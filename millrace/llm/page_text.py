"""The main text of web pages: flat text blocks, each judged by a decision tree.

A page is cut into blocks wherever an element that stands on lines of its own begins or ends. A block's features are
its number of words and the share of them in links, the same two of the block before and of the block after, and
where it stands: inside elements (or elements with names) that hold an article, or menus, notices, comments and the
like. A decision tree, fitted with Spark on the small table of ``labelled_pages`` or another one of its kind, tells
which blocks are main text. Those are joined in page order.

Markup is read leniently and in time linear in its length: elements may be left open, a comment or script without
an end runs to the end of the page, as does a tag without one. Character references are decoded, white space
inside a block becomes one space. Nothing of a kept block is dropped.

A null html is an empty page, whose text is empty, as is that of a page without main text. Rows that repeat an
id are rows of their own; equal pages give equal texts. Very long pages are worked on one at a time. An empty table
gives no rows. Columns other than page_id, url and html are ignored. Without labelled blocks no block is main text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices
from millrace.llm.labelled_pages import pages

DEPTH = 8
FEATURES = (
    "words", "linked", "words_before", "linked_before", "words_after", "linked_after",
    "region", "outside", "in_regions", "heading", "sign",
)

# Elements of HTML by their part in the layout, and names that pages give to theirs.
OWN_LINES = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = set("noscript template svg math select button datalist object canvas audio video".split())
CLOSED_BY_NEXT = {"p": OWN_LINES, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
OUTSIDE_ELEMENTS = set("nav aside footer dialog menu".split())
REGION_ELEMENTS = set("article main".split())
OUTSIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising alert announcement banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies "
    "copyright discussion disclaimer disqus footer form gdpr legal login masthead menu modal nav navbar navigation navigator newsletter notice "
    "notification pager pagination paging popup promo promoted promotion recommendations related replies reply respond responses search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription teaser toc toolbar topnav topbar widget widgets".split()
)
WEAK_NAMES = set("header head complementary".split())
REGION_NAMES = set("article articlebody content entry main maincontent post story".split())
SWITCHES = set("has no with without".split())

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"""(?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+>""")
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """A run of text without an element of its own lines in between."""

    region: int
    outside: bool
    heading: bool
    main: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    words: int = 0
    text: str = ""


def _mark(name: str, attributes: str, within: bool) -> tuple[int, bool]:
    """(region, outside) of an element: 1 holds an article, -1 does not, 0 says nothing."""
    names = [n.lower() for found in _NAMED.findall(attributes) for n in _NAME.findall(" ".join(found))]
    # "with-sidebar" tells of another element.
    names = {n for n, before in zip(names, ["", *names], strict=False) if before not in SWITCHES}
    if name in OUTSIDE_ELEMENTS or names & OUTSIDE_NAMES:
        return -1, True
    if name in REGION_ELEMENTS or names & REGION_NAMES:
        return 1, False
    if name == "form" or not within and (name == "header" or names & WEAK_NAMES):
        return -1, False
    return 0, False


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold words, in page order."""
    out: list[Block] = []
    # Open elements as (name, region, outside, main, unseen), what holds at the top, and how many of each name.
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    open_, link, now, quoted, at = {"": 1}, 0, None, True, 0

    def add(text: str) -> None:
        nonlocal now
        if not text or stack[-1][4]:
            return
        if now is None:
            name, region, outside, main, _ = stack[-1]
            now = Block(region, outside, name in HEADINGS, main)
        if "&" in text:
            text = unescape(text)
        now.parts.append(text)
        if link:
            now.linked += len(text.split())

    def end() -> None:
        nonlocal now
        if now is not None:
            words = "".join(now.parts).split()
            if words:
                now.text, now.words, now.parts = " ".join(words), len(words), []
                now.linked = min(now.linked, now.words)
                out.append(now)
            now = None

    def pop() -> None:
        nonlocal link
        open_[stack.pop()[0]] -= 1
        # A link ends with the element it was opened in.
        link = link if link <= len(stack) else 0

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        add(html[at:start])
        opened = _OPEN.match(html, start)
        if opened is None:
            add("<")
            at = start + 1
            continue
        if opened[2] is None:
            mark = "-->" if opened[0] == "<!--" else ">"
            found = html.find(mark, start + 2)
            if found < 0:
                break
            at = found + len(mark)
            continue
        rest = _REST.match(html, opened.end()) if quoted else None
        if rest is None:
            # No end outside quotes: quotes are no guide from here on.
            quoted, found = False, html.find(">", start)
            if found < 0:
                break
            at = found + 1
        else:
            at = rest.end()
        closing, name, attributes = opened[1], opened[2].lower(), html[opened.end() : at - 1]
        if name == "a":
            link = 0 if closing else len(stack)
        elif name in RAW:
            if not closing:
                last = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                if last is None:
                    break
                at = last.end()
        elif name == "br":
            add(" ")
        elif closing and open_.get(name) and (name in OWN_LINES or name in UNSEEN):
            end()
            while stack[-1][0] != name:
                pop()
            pop()
        elif closing:
            if name in OWN_LINES:
                end()
        elif name in OWN_LINES or name in UNSEEN:
            end()
            while name in CLOSED_BY_NEXT.get(stack[-1][0], ()):
                pop()
            if name != "hr" and not (name in UNSEEN and attributes.endswith("/")):
                _, region, outside, main, unseen = stack[-1]
                own, out_there = (0, False) if name in ("html", "body") else _mark(name, attributes, region > 0)
                # What interrupts an article is outside it, an article in a form is not.
                stack.append((name, own or region, outside or out_there, main or "data-main" in attributes, unseen or name in UNSEEN))
                open_[name] = open_.get(name, 0) + 1
    end()
    return out


def features(page: list[Block]) -> np.ndarray:
    """A row of FEATURES for every block."""
    words = np.array([b.words for b in page], dtype=float)
    linked = np.array([b.linked for b in page], dtype=float) / np.maximum(words, 1)
    region, outside = np.array([b.region for b in page], dtype=float), np.array([b.outside for b in page], dtype=float)
    inside = words[(region > 0) & (outside == 0)].sum() / max(words.sum(), 1)

    def beside(values: np.ndarray, by: int) -> np.ndarray:
        moved = np.zeros_like(values)
        if by < 0:
            moved[1:] = values[:-1]
        else:
            moved[:-1] = values[1:]
        return moved

    columns = [
        words, linked, beside(words, -1), beside(linked, -1), beside(words, 1), beside(linked, 1), region, outside,
        np.full(len(page), float(inside > 0)), np.array([b.heading for b in page], dtype=float),
        np.array(["©" in b.text for b in page], dtype=float),
    ]
    return np.stack(columns, axis=1) if page else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class Tree:
    """Nodes in order of reading: the feature (-1 in a leaf), its bound, the child beyond the bound, the answer."""

    feature: tuple[int, ...]
    bound: tuple[float, ...]
    beyond: tuple[int, ...]
    answer: tuple[bool, ...]

    def keeps(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        feature, bound, beyond = np.array(self.feature), np.array(self.bound), np.array(self.beyond)
        while len(at) and (feature[at] >= 0).any():
            over = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] > bound[at]
            at = np.where(feature[at] < 0, at, np.where(over, beyond[at], at + 1))
        return np.array(self.answer)[at]


def _read_tree(shown: str) -> Tree:
    """A tree from Spark's own listing of it: If and Else lines with the bound, Predict lines."""
    nodes: list[list] = []
    open_: list[int] = []
    for line in shown.splitlines():
        if found := re.search(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line):
            open_.append(len(nodes))
            nodes.append([int(found[1]), float(found[2]), -1, False])
        elif "Else (" in line:
            nodes[open_.pop()][2] = len(nodes)
        elif found := re.search(r"Predict: ([\d.]+)", line):
            nodes.append([-1, 0.0, -1, float(found[1]) > 0])
    return Tree(*map(tuple, zip(*nodes, strict=True)))


def labelled(spark: SparkSession) -> DataFrame:
    """(html) of the labelled pages that come with the library."""
    return spark.createDataFrame([(p,) for p in pages()], "html string")


def labelled_blocks(marked: DataFrame) -> DataFrame:
    """(features, label) of every block of pages whose main text is marked by ``data-main``."""

    def run(batches):
        for batch in slices(batches, "html"):
            for html in batch["html"].to_pylist():
                page = blocks(html or "")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(features(page).tolist(), pa.list_(pa.float64())), pa.array([float(b.main) for b in page], pa.float64())], ["features", "label"]
                )

    return marked.select("html").mapInArrow(run, "features array<double>, label double")


def train(marked: DataFrame, depth: int = DEPTH) -> Tree:
    """A decision tree from a small table of pages with marked main text."""
    rows = labelled_blocks(marked).select(array_to_vector("features").alias("features"), "label").persist()
    try:
        if not rows.head(1):
            return Tree((-1,), (0.0,), (-1,), (False,))
        model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=1).fit(rows)
    finally:
        rows.unpersist()
    return _read_tree(model.toDebugString)


def main_text(html: str | None, tree: Tree) -> str:
    page = blocks(html or "")
    return " ".join(b.text for b, kept in zip(page, tree.keeps(features(page)), strict=True) if kept)


def extract(table: DataFrame, tree: Tree) -> DataFrame:
    """(page_id, url, text, n_chars) of every page, without a shuffle."""

    def run(batches):
        for batch in slices(batches, "html"):
            texts = [main_text(html, tree) for html in batch["html"].to_pylist()]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = table.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
