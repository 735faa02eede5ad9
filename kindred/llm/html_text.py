"""HTML extraction: flat text blocks, shallow features of a block and its neighbours, a decision tree.

A page becomes a flat list of text blocks. Each block has its number of words and link density, those of the
blocks before and after (after Kohlschuetter, Fankhauser and Nejdl, 2010), where the page's own elements put it
(inside or outside an article, inside navigation and the like, in a form that is not the whole page, heading, list),
and what the labelled table says of the class and id names around it. A decision tree grown on the blocks of that
small labelled table, real markup cut by the same code, says which blocks are text.

Scale: one narrow pass; a page never leaves its task.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr mi mn mo mrow msup msub mfrac msqrt mtext map area embed input link meta param source track".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text; all but the head stand inside a line of text without ending it.
_SILENT = frozenset(
    "script style noscript template head title iframe object svg canvas audio video select textarea button datalist".split())
_RAW = frozenset("script style textarea title iframe noscript".split())
_IN_HEAD = frozenset("base link meta title style script noscript template head".split())
#: Open elements, on top of the stack, that the start of another one ends; any block ends a paragraph.
_ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("td", "th", "tr", "p"),
         "option": ("option",)}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ASIDE = frozenset("nav footer aside menu dialog".split())
#: ARIA roles that say the same as an element.
_ROLES = {"main": "main", "article": "article", "navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside",
          "search": "form", "form": "form", "menu": "menu", "menubar": "menu", "dialog": "dialog", "alertdialog": "dialog"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "main", "aside", "form", "heading", "list", "names")


def _names(value: str) -> list[str]:
    """What class or id names call an element: each whole name and, as its head noun, its last part."""
    out = []
    for name in value.split():
        parts = [p for p in _PARTS.split(_CAMEL.sub("-", name).lower()) if p]
        if parts:
            out += ["-".join(parts), parts[-1]] if len(parts) > 1 else parts
    return out


class _Open:
    """An open element with all that holds inside it."""

    __slots__ = ("article", "aside", "form", "in_list", "main", "names", "silent", "tag")

    def __init__(self, tag, main=False, article=0, aside=False, form=0, in_list=False, names=(), silent=False):
        self.tag, self.main, self.article, self.aside, self.form, self.in_list, self.names, self.silent = tag, main, article, aside, form, in_list, names, silent


class Block:
    """A run of text: its words, linked words, and the open elements' marks."""

    __slots__ = ("article", "aside", "form", "heading", "in_list", "linked", "main", "names", "text", "words")

    def __init__(self, text: str, linked: int, inside: _Open, heading: bool):
        self.text, self.words, self.linked, self.heading = text, text.count(" ") + 1, linked, heading
        self.main, self.article, self.aside, self.form, self.in_list, self.names = inside.main, inside.article, inside.aside, inside.form, inside.in_list, inside.names


_ROOT = _Open("")


def _inside(outer: _Open, tag: str, attributes: str, number: int) -> _Open:
    """``tag`` opened inside ``outer``; ``number``: its own, if it is an article or a form."""
    silent, names, means = outer.silent or tag in _SILENT, outer.names, tag
    if attributes and not attributes.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id") and tag not in ("html", "body"):
                names = (*names, *_names(value))
            elif name == "role":
                means = _ROLES.get(value.strip().lower(), means)
            elif name == "hidden" or (name == "style" and _HIDDEN.search(value)) or (name == "aria-hidden" and value.lower() == "true"):
                silent = True
    main, article, aside, form = outer.main, outer.article, outer.aside, outer.form
    if means in ("article", "main"):
        if not main and not outer.in_list:  # what stands around the page's text says nothing about it
            aside, form, names = False, 0, names[len(outer.names):]
        main, article = True, number if means == "article" else article
    elif means in _ASIDE or (means == "header" and not main):
        aside = True
    elif means == "form":
        form = number
    return _Open(tag, main, article, aside, form, outer.in_list or tag in ("ul", "ol", "dl"), names, silent)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[_Open] = []
    opened: Counter[str] = Counter()
    top = _ROOT
    heading = False
    links = number = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                n_linked = len(html.unescape(" ".join(linked)).split())
                out.append(Block(text, n_linked, top, heading))
            parts, linked = [], []

    def push(inner: _Open) -> None:
        nonlocal top
        stack.append(inner)
        opened[inner.tag] += 1
        top = inner

    def cut(n: int) -> None:
        """Closes all but the ``n`` outermost open elements."""
        nonlocal top
        while len(stack) > n:
            opened[stack.pop().tag] -= 1
        top = stack[-1] if stack else _ROOT

    def close(tag: str) -> bool:
        """Closes the innermost open ``tag`` and all inside it."""
        if not opened[tag]:
            return False
        n = len(stack) - 1
        while stack[n].tag != tag:
            n -= 1
        cut(n)
        return True

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            if top.tag == "head" and not page[at:stop].isspace():
                close("head")
            if not top.silent:
                parts.append(page[at:stop])
                if links:
                    linked.append(page[at:stop])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1], m[3]
        if not closing and top.tag == "head" and tag not in _IN_HEAD:
            close("head")  # its end tag may be left out
        if tag in _RAW and not closing:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br" and not top.silent:
            parts.append(" ")
        if tag in _INLINE or (tag in _SILENT and tag != "head"):
            if closing and tag in _SILENT:
                close(tag)
            elif closing:
                n = len(stack)
                while n and stack[n - 1].tag in _INLINE and stack[n - 1].tag != tag:
                    n -= 1  # left open inside it
                if n and stack[n - 1].tag == tag:
                    cut(n - 1)
            elif tag not in _VOID and not attributes.rstrip().endswith("/") and _inside(top, tag, attributes, 0).silent:
                push(_Open(tag, silent=True))  # what else an inline element says does not make it a block of its own
            continue
        flush()
        if closing:
            if tag in _HEADINGS:
                heading = False
            if close(tag):
                links = 0
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            n = len(stack)
            while n and stack[n - 1].tag in _INLINE:  # a block ends an inline element left open
                n -= 1
            while n and stack[n - 1].tag in _ENDS.get(tag, ("p",)):
                n -= 1
            cut(n)
            heading = tag in _HEADINGS
            number += 1
            push(_inside(top, tag, attributes, number))
    flush()
    return out


def features(found: list[Block], weights: dict[str, float]) -> list[tuple]:
    """FEATURES of every block.

    main, on a page with articles: the words of the block's own article over those of the longest, -0.5 outside them but in a main
    element, -1 elsewhere; with a main element alone 1 and -1; 0 on a page that has neither. form: 1 minus the share of the page's
    words that stand in the block's form, 0 outside forms. names: summed weights of the names around it, between -3 and 3.
    """
    total = sum(b.words for b in found) or 1
    per_form: Counter[int] = Counter()
    per_article: Counter[int] = Counter()
    for b in found:
        per_form[b.form] += b.words
        per_article[b.article] += b.words
    longest = max((n for a, n in per_article.items() if a), default=0)
    any_main = any(b.main for b in found)
    density = [b.linked / b.words for b in found]
    out = []
    for i, b in enumerate(found):
        before = (found[i - 1].words, density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1].words, density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        names = sum(weights.get(n, 0.0) for n in set(b.names)) if b.names else 0.0
        if longest:
            main = per_article[b.article] / longest if b.article else -0.5 if b.main else -1.0
        else:
            main = 0.0 if not any_main else 1.0 if b.main else -1.0
        out.append((
            b.words, density[i], *before, *after, main, b.aside, 1 - per_form[b.form] / total if b.form else 0.0,
            b.heading, b.in_list, max(-3.0, min(3.0, names))))
    return out


class Tree:
    """Classification tree by Gini impurity; midpoints split, ties go to the first feature and lowest cut."""

    def __init__(self, rows: list[tuple], depth: int = 8, least: int = 2):
        table = np.array(rows, dtype=float)
        self.least = least
        self.root = self._grow(table[:, :-1], table[:, -1], depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        p = y.mean()
        if not depth or p in (0.0, 1.0):
            return float(p)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                if min(low.sum(), (~low).sum()) < self.least:
                    continue
                cost = sum(z.size * z.mean() * (1 - z.mean()) for z in (y[low], y[~low]))
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, cut)
        if best is None:
            return float(p)
        _, f, cut = best
        low = x[:, f] <= cut
        return (f, float(cut), self._grow(x[low], y[low], depth - 1), self._grow(x[~low], y[~low], depth - 1))

    def chance(self, row) -> float:
        node = self.root
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    def used(self) -> set[str]:
        """Names of the features that it splits on."""
        def walk(node):
            return {FEATURES[node[0]]} | walk(node[2]) | walk(node[3]) if isinstance(node, tuple) else set()

        return walk(self.root)


class Extractor:
    """Weights of names and the tree, both learned from labelled pages (see ``labelled_pages``)."""

    def __init__(self, pages: list[str]):
        found = [blocks(p) for p in pages]
        marked = [[b.text.startswith("+") for b in page] for page in found]
        seen: dict[str, Counter] = {}
        for page, marks in zip(found, marked, strict=True):
            for name, keep in {(n, k) for b, k in zip(page, marks, strict=True) for n in b.names}:
                seen.setdefault(name, Counter())[keep] += 1
        # Log odds by pages, with half a page added to either side.
        self.weights = {n: math.log((c[True] + 0.5) / (c[False] + 0.5)) for n, c in seen.items()}
        rows = [(*x, k) for page, marks in zip(found, marked, strict=True) for x, k in zip(features(page, self.weights), marks, strict=True)]
        self.tree = Tree(rows)

    def text(self, page: str | None) -> str:
        """Text blocks of the article, in page order, joined by an empty line."""
        found = blocks(page or "")
        return "\n\n".join(b.text for b, x in zip(found, features(found, self.weights), strict=True) if self.tree.chance(x) >= 0.5)


_extractor: Extractor | None = None


def extractor() -> Extractor:
    global _extractor
    if _extractor is None:
        from kindred.llm.html_labels import labelled_pages

        _extractor = Extractor(labelled_pages())
    return _extractor


def main_text(page: str | None) -> str:
    return extractor().text(page)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``: the main text of the whole ``html``, empty if it has none.

    Null and empty html give empty text; broken and cut-off markup is read as far as it goes. A column
    named text is replaced; all others, repeated rows included, pass through. An empty table gives no rows.
    """
    bounded_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def text(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([main_text(p) for p in part.to_pylist()], pa.string())

    return pages.withColumn("text", text(F.col("html").cast("string")))
