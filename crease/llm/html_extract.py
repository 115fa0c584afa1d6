"""Main-text extraction by tag-path ratios.

A page is read into text nodes in page order, each with its tag path (the block-level
tags from the root down to it).  Per tag path the text length and the punctuation are
summed and divided by the path's nodes: the path's ratios.  Node by node the
ratios are smoothed along the page with a Gaussian, fused into one score (length
times punctuation), and the scores summed into every container the nodes stand in.
The innermost container path that keeps most of the page's score, or one above it
that holds further paths of like ratios, gives the content: from its first block over
a threshold to its last one, the headings before, and what stands beside these in the
same element (a byline, a closing list), but for blocks at its ends that are nothing but
links.  ``article`` and ``main`` get a bonus in the
score and stand for the containers in them; they decide nothing by themselves.

Furniture takes no part: menus, headers, footers, asides, scripts and styles by their
tag; sidebars, notices, adverts, forms, reader comments by role, class or id, unless
the element holds several blocks and most of the page's score.  Inline elements are none
by a name, single blocks (paragraphs, tables, headings) only by an unmistakable one.  Of a
header inside an article the headings stay.  Nor do comments and the head take part.

Blocks: the text between two block-level tags is a block; character references are
decoded, white space runs become one space, blocks without text go, and blocks are
joined by an empty line.  Nothing else is dropped or cut.

Edge cases: null, empty and tag-only pages have the empty text; a page without
tags is one path, all of it content; unclosed and stray tags are tolerated (a
block-level start closes an open ``p``, stray ends are ignored; a quote opens a value
only after ``=``; a tag without its ``>`` before the next ``<`` is text), in time linear
in the page; repeated rows are read one by one; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import ship

SMOOTH = 2.0                 # standard deviation of the Gaussian, in nodes
CONTAINER_SHARE = 0.6        # of the page's score, that the container keeps
WRAPPER_SHARE = 0.5          # of the page's score; what holds more is no furniture by its name
THRESHOLD = 0.25             # of the container's mean score, for a block or a further path
NAMED = 2.0                  # times the score, in article and main

# fixed values: HTML element names
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul"
    .split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
SKIPPED = RAW | frozenset(
    "head nav header footer aside menu button select option input dialog object".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# stand beside others of their kind: their parent is the container
PARTS = HEADINGS | frozenset("p li td th tr tbody thead table ul ol dl dt dd blockquote pre".split())
ONE_BLOCK = PARTS - frozenset("ul ol dl".split())
P_WITHIN = frozenset("button td th table".split())
# a start tag on the left closes these when they are open, up to the nearest of the others
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar side "
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead footer notice notices "
    "cookie cookies consent alert comment comments reply replies respond disqus share sharing "
    "social related newsletter subscribe popup modal widget form login".split())
# words that leave the meaning of a furniture word as it is, and words before it that turn it
PLAIN = frozenset(
    "site page top bottom left right main global primary secondary list container wrapper wrap inner "
    "outer section box bar block area item items group button buttons link links content".split())
# the furniture words that hold for a single block too
PLAINLY = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo breadcrumb breadcrumbs "
    "notice notices cookie cookies consent newsletter subscribe share sharing".split())
# fixed values: HTML elements inside a line
INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong "
    "sub sup time tt u var".split())
TURNS = frozenset("has with no without is".split())
HEADERS = frozenset("header masthead banner".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

_REACH = math.ceil(2 * SMOOTH)
_KERNEL = np.exp(-np.arange(-_REACH, _REACH + 1) ** 2 / (2 * SMOOTH * SMOOTH))
_NODE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>"
    r"|(?P<text>[^<]+|<)", re.S)
_NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?]")


def named_furniture(tag: str, attrs: str) -> bool:
    """Furniture by role, class or id (or a form)."""
    if tag == "form":
        return True
    if tag in ("html", "body", "article", "main") or tag in INLINE or "=" not in attrs:
        return False
    sure = PLAINLY if tag in ONE_BLOCK else FURNITURE
    for name, *values in _NAMES.findall(attrs):
        for token in "".join(values).lower().split():
            if name.lower() == "role":
                if token in ROLES:
                    return True
            elif _says_furniture(_WORDS.findall(token), sure):
                return True
    return False


def _says_furniture(words: list[str], sure: frozenset[str]) -> bool:
    """``sidebar``, ``site-header``, ``post-comments``; not ``has-sidebar``,
    ``article-header``, ``social-science``.  One word must be a sure one."""
    if not sure.intersection(words) or words[0] in TURNS:
        return False
    return words[-1] in FURNITURE - HEADERS or all(w in FURNITURE or w in PLAIN for w in words)


class TagPaths:
    """The page's tag paths as numbers: a path is its parent's number and a tag.
    Number 0 is the root; parents come before their children.  ``wrapper`` gives
    the enclosing one of every element that is furniture by name (0: none)."""

    def __init__(self):
        self.parent, self.tag, self.wrapper = [0], [""], [0]
        self._numbers: dict[tuple[int, str], int] = {}

    def child(self, parent: int, tag: str) -> int:
        n = self._numbers.setdefault((parent, tag), len(self.tag))
        if n == len(self.tag):
            self.parent.append(parent)
            self.tag.append(tag)
        return n


class Node(NamedTuple):
    """A text node: its tag path, block number, text, the furniture by name and the
    element (other than single blocks and lists) that it stands in, and whether it is
    part of a link."""
    path: int
    block: int
    text: str
    wrapper: int
    element: int
    link: bool


class _Stack:
    """Open elements: tag, inside furniture by tag (1; 2: a header in an article, whose
    headings stay), path number, furniture by name, number of the element."""

    def __init__(self, paths: TagPaths):
        self.paths = paths
        self.open: list[tuple[str, int, int, int, int]] = [("", 0, 0, 0, 0)]
        self.count: dict[str, int] = {}
        self.elements = 0

    def push(self, tag: str, attrs: str) -> None:
        _, inside, path, wrapper, element = self.open[-1]
        if named_furniture(tag, attrs):
            self.paths.wrapper.append(wrapper)
            wrapper = len(self.paths.wrapper) - 1
        if tag in BLOCK:
            path = self.paths.child(path, tag)
            if tag not in PARTS and not (tag == "header" and self.count.get("article")):
                self.elements += 1
                element = self.elements
        if inside != 1 and tag in SKIPPED:
            inside = 2 if tag == "header" and self.count.get("article") else 1
        elif inside == 2 and tag in HEADINGS:
            inside = 0
        self.open.append((tag, inside, path, wrapper, element))
        self.count[tag] = self.count.get(tag, 0) + 1

    def close(self, tags, within=frozenset()) -> None:
        """Close the innermost open element of ``tags``, and what is open in it,
        unless one of ``within`` stands between."""
        if not any(self.count.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                for tag, *_ in self.open[i:]:
                    self.count[tag] -= 1
                del self.open[i:]
                return
            if self.open[i][0] in within:
                return


def text_nodes(page: str, paths: TagPaths) -> list[Node]:
    """Every text node outside furniture by tag."""
    out: list[Node] = []
    stack = _Stack(paths)
    block = 0
    scan = _NODE.scanner(page)
    while m := scan.match():
        text, tag = m["text"], m["tag"]
        _, furniture, path, wrapper, element = stack.open[-1]
        if text is not None:
            if not furniture:
                out.append(Node(path, block, text, wrapper, element, bool(stack.count.get("a"))))
            continue
        if tag is None:                              # a comment or declaration
            continue
        tag = tag.lower()
        block += tag in BLOCK
        if m["end"]:
            stack.close((tag,))
        elif tag in RAW:                             # its text is not markup
            end = _RAW_END[tag].search(page, m.end())
            scan = _NODE.scanner(page, end.end() if end else len(page))
        elif tag in VOID:
            if tag == "br" and not furniture:
                out.append(Node(path, block, " ", wrapper, element, False))
        else:
            if tag in BLOCK:
                stack.close(("p",), P_WITHIN)
            if tag in CLOSES:
                stack.close(*CLOSES[tag])
            stack.push(tag, m["attrs"])
    return out


def path_scores(nodes: list[Node], paths: TagPaths) -> tuple[list[float], list[float]]:
    """The fused tag-path ratio at every node: smoothed, and the path's own."""
    sums: dict[int, list[float]] = {}
    for path, _, text, *_ in nodes:
        s = sums.setdefault(path, [0, 0, 0])
        s[0] += 1
        s[1] += len(text.strip())
        s[2] += len(_PUNCTUATION.findall(text))
    named = [False]
    for p in range(1, len(paths.tag)):
        named.append(named[paths.parent[p]] or paths.tag[p] in ("article", "main"))
    bonus = np.array([NAMED if named[n[0]] else 1.0 for n in nodes])
    length = np.array([sums[n[0]][1] / sums[n[0]][0] for n in nodes])
    points = np.array([(1 + sums[n[0]][2]) / sums[n[0]][0] for n in nodes])
    return (_smoothed(length) * _smoothed(points) * bonus).tolist(), (length * points * bonus).tolist()


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean of the nodes around each node, as far as the page goes."""
    full = slice(_REACH, _REACH + len(values))
    return (np.convolve(values, _KERNEL)[full] / np.convolve(np.ones(len(values)), _KERNEL)[full])


def without_furniture(nodes: list[Node], paths: TagPaths) -> list[Node]:
    """The nodes outside furniture by name.  What holds several blocks and most of the
    page's score is none, nor is what holds all of it."""
    n = len(paths.wrapper)
    if n == 1:
        return nodes
    held, blocks, seen = [0.0] * n, [0] * n, -1
    for node, s in zip(nodes, path_scores(nodes, paths)[1]):
        held[node[3]] += s
        if node[2].strip() and node[1] != seen:
            seen = node[1]
            blocks[node[3]] += 1
    for w in range(n - 1, 0, -1):
        held[paths.wrapper[w]] += held[w]
        blocks[paths.wrapper[w]] += blocks[w]
    out = [False] * n
    for w in range(1, n):
        most = blocks[w] > 1 and held[w] > held[0] * WRAPPER_SHARE
        out[w] = out[paths.wrapper[w]] or not most and blocks[w] < blocks[0]
    return [node for node in nodes if not out[node[3]]]


def container(nodes: list[Node], scores: list[float], own: list[float], paths: TagPaths) -> int:
    """The path that holds the main text."""
    n = len(paths.tag)
    held, raw, count = [0.0] * n, [0.0] * n, [0] * n  # by container path
    at, times = [0.0] * n, [0] * n                    # by the path itself
    for (path, _, text, *_), s, o in zip(nodes, scores, own):
        held[path] += s
        if text.strip():
            at[path] += o
            times[path] += 1
    raw[:], count[:] = at, times
    children: list[list[int]] = [[] for _ in range(n)]
    for p in range(n - 1, 0, -1):
        up = paths.parent[p]
        held[up] += held[p]
        raw[up] += raw[p]
        count[up] += count[p]
        children[up].append(p)
    most = held[0] * CONTAINER_SHARE
    best = max(p for p in range(n) if held[p] >= most)
    while best and paths.tag[best] in PARTS:
        best = paths.parent[best]
    like = THRESHOLD * raw[best] / max(1, count[best])
    # up to the highest container with further paths like these, or with the page's title
    p, top = best, best
    while p:
        p, below = paths.parent[p], p
        if (paths.tag[p] in ("article", "main") or times[p] and at[p] >= like * times[p]
                or any(count[c] and (raw[c] >= like * count[c] or paths.tag[c] == "h1")
                       for c in children[p] if c != below)):
            top = p
    return top


def content_nodes(nodes: list[Node], paths: TagPaths) -> list[bool]:
    """Which nodes belong to the main text."""
    scores, own = path_scores(nodes, paths)
    best = container(nodes, scores, own, paths)
    inside = [False] * len(paths.tag)
    for p in range(best, len(paths.tag)):
        inside[p] = p == best or inside[paths.parent[p]]
    chosen = [s for (p, *_), s in zip(nodes, scores) if inside[p]]
    least = THRESHOLD * sum(chosen) / max(1, len(chosen))
    # a block counts by its best node; headings go with what they head, and short blocks
    # between two that count (lists, captions) with these
    best_of: dict[int, float] = {}
    heading: dict[int, bool] = {}
    element: dict[int, int] = {}
    links: dict[int, bool] = {}
    for node, s in zip(nodes, scores):
        if inside[node.path] and node.text.strip():
            best_of[node.block] = max(best_of.get(node.block, 0.0), s)
            heading[node.block] = paths.tag[node.path] in HEADINGS
            element[node.block] = node.element
            links[node.block] = links.get(node.block, True) and node.link
    blocks = list(best_of)
    over = [k for k, block in enumerate(blocks) if best_of[block] >= least]
    if not over:
        return [False] * len(nodes)
    first, last = over[0], over[-1]
    # what stands in the same element as the first and the last of them
    beside = [k for k in range(first) if element[blocks[k]] == element[blocks[first]] and not links[blocks[k]]]
    first = min([first, *beside])
    beside = [k for k in range(last + 1, len(blocks))
              if element[blocks[k]] == element[blocks[last]] and not links[blocks[k]]]
    last = max([last, *beside])
    while first and heading[blocks[first - 1]]:
        first -= 1
    while first < last < len(blocks) - 1 and heading[blocks[last]]:
        last -= 1                                    # what it heads is cut
    return [inside[n.path] and blocks[first] <= n.block <= blocks[last] for n in nodes]


def main_text(page: str | None) -> str:
    paths = TagPaths()
    nodes = without_furniture(text_nodes(page or "", paths), paths)
    if not nodes:
        return ""
    blocks: dict[int, list[str]] = {}
    for node, keep in zip(nodes, content_nodes(nodes, paths)):
        if keep:
            blocks.setdefault(node.block, []).append(node.text)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks.values())
    return "\n\n".join(x for x in lines if x)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(pages.sparkSession)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(x.as_py()) for x in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"),
                         F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
