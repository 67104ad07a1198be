"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text (one scan over its tags, closing what HTML lets
authors leave open). Each block has a cost for being called content and one for being
called boilerplate, from a linear classifier over its structure and text: where it
stands (article, nav, footer, ...), what its class and id say, how much of it are
links, how long it is. These costs are the capacities from and to the terminals of a
graph whose further edges say that neighbours on the page, and more so blocks of the
same container, are alike. The minimum cut, found by max-flow, is the labelling with
the least total cost. The classifier's weights are the fixed values below.

Scripts, styles and comments of the markup have no text and make no blocks. Forms and
their controls do; they cost more to be called content. One of them, or a silent
element, that is never closed ends with its parent or where an article, main or section
opens; an article or main inside a form is free of the form's cost.

Scale: pages are independent; one pass, no shuffle, one page at a time in memory. The
graph of a page has a node per run of blocks that lean alike within one container, and
at most two edges per node besides those to the terminals; its max-flow is exact.

Edge cases: null and empty html give an empty text; broken markup is read as far as it
goes; pages without any content block give an empty text; equal rows give equal rows;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import documents

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_SPACE = re.compile(r"\s+")
#: Elements whose whole content is no text of the page.
_SILENT = {
    "script", "style", "template", "svg", "iframe", "canvas", "title", "textarea", "audio", "video", "datalist",
}
#: What ends a silent element or a control that has no end tag, and the head.
_LANDMARK = {"article", "main", "section"}
_LANDED = re.compile(r"<(?:article|main|section)\b", re.I)
_CONTROL = {"button", "select", "dialog"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "meter", "output", "progress", "q", "ruby", "rb",
    "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr", "img", "nobr", "object", "map", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac",
    "msqrt", "mroot", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mtable", "mtr", "mtd",
    "mspace", "mstyle", "mpadded", "mphantom", "mmultiscripts", "menclose", "semantics", "annotation",
}
#: Opening one of these ends an open paragraph.
_ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "div", "dl", "fieldset",
    "figure", "figcaption", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
    "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = {"table", "ul", "ol", "dl", "article", "section", "div", "body", "html", "main", "aside", "nav"}
_OUTSIDE = {"nav": 6.0, "footer": 6.0, "aside": 6.0, "header": 4.0, "menu": 6.0, "dialog": 6.0, "button": 6.0, "select": 6.0}
_INSIDE = {"article": 3.0, "main": 3.0}
#: A form within the article is one of its controls; one around it may hold the page.
FORM_INSIDE, FORM_AROUND = 5.0, 1.5
_BAD = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advert(?:isement|ising)?|banner|sponsor(?:ed)?|promo(?:tion)?s?|"
    r"nav(?:bar|igation)?|menu|breadcrumbs?|foot(?:er)?|head(?:er)?|masthead|side(?:bar)?|widgets?|"
    r"related|recommend(?:ed|ations?)?|share|sharing|social|cookies?|consent|notice|gdpr|newsletter|"
    r"subscribe|signup|login|popup|modal|overlay|comments?|respond|replies|reply|disqus|legal|"
    r"copyright|pagination|pager|toolbar|tags?|skip|search|alert)(?:$|[\s_-])",
    re.I,
)
_GOOD = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|body|text|main)(?:$|[\s_-])", re.I)
_ROLES = {"navigation": 6.0, "banner": 5.0, "contentinfo": 6.0, "complementary": 6.0, "search": 6.0,
          "alert": 5.0, "dialog": 6.0, "form": 6.0, "main": -3.0, "article": -3.0}
_LEGAL = re.compile(r"^\s*(?:©|\(c\)|copyright\b)|all rights reserved|cookie", re.I)
#: Strength of the edge between neighbours in one container, and between others.
NEAR, FAR = 1.5, 0.2


@dataclass
class Block:
    """A run of text with the number of its container and the evidence of its surroundings."""

    text: str
    path: int
    lean: float
    linked: int = 0
    heading: bool = False
    inside: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    lean: float
    inside: bool
    form: float = 0.0  # part of the lean that is due to a form around
    block: str = ""  # the innermost tag from here that is not inline
    container: int = 0  # and the innermost element that holds blocks


@dataclass
class _Page:
    """State of the scan over one page."""

    stack: list[_Open] = field(default_factory=lambda: [_Open("", 0, 0.0, False)])
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    numbers: int = 0
    count: Counter = field(default_factory=Counter)  # open elements by tag

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            top = self.stack[-1]
            tag = top.block
            heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            self.blocks.append(Block(text, top.container, top.lean, self.linked, heading, top.inside))
        self.parts, self.linked = [], 0

    def open(self, tag: str, attrs: str) -> None:
        above = self.stack[-1]
        lean, inside, form = above.lean, above.inside, above.form
        if tag == "form":
            if inside:
                lean = max(lean, 0.0) + FORM_INSIDE
            elif not form:
                form = FORM_AROUND
                lean += form
        elif tag in _INSIDE:
            inside = True
            lean, form = lean - form, 0.0
            lean = min(lean, 0.0) - _INSIDE[tag] if lean <= 0 else lean
        elif tag in _OUTSIDE and not (tag == "header" and inside):
            lean = max(lean, 0.0) + _OUTSIDE[tag]
        if attrs and tag not in ("body", "html"):
            lean += _hints(attrs)
        self.numbers += 1
        inline = tag in _INLINE
        block = above.block if inline else tag
        container = above.container if inline or tag in ("p", "li") else self.numbers
        self.stack.append(_Open(tag, self.numbers, lean, inside, form, block, container))
        self.count[tag] += 1

    def _cut(self, i: int) -> None:
        """Close all from the ``i``-th open element on."""
        for gone in self.stack[i:]:
            self.count[gone.tag] -= 1
        del self.stack[i:]

    def close(self, tag: str) -> None:
        if not self.count[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._cut(i)
                return
            if tag in _INLINE and self.stack[i].tag not in _INLINE:
                return

    def leave_open(self, tag: str) -> None:
        """End what the opening of ``tag`` ends by the rules of HTML."""
        if tag in _ENDS_P:
            self._end({"p"})
        if tag in _SIBLINGS:
            self._end(_SIBLINGS[tag])

    def end_unclosed(self, ends: dict[str, int], at: int) -> None:
        """End the controls that no end tag after ``at`` closes."""
        if not any(self.count[t] for t in _CONTROL):
            return
        for i in range(1, len(self.stack)):
            if self.stack[i].tag in _CONTROL and ends[self.stack[i].tag] < at:
                self._cut(i)
                return

    def _end(self, tags: set[str]) -> None:
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self._cut(i)
                return
            if self.stack[i].tag in _SCOPE:
                return


def _hints(attrs: str) -> float:
    lean = 0.0
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "data-component", "itemprop"):
            if _BAD.search(value):
                lean += 6.0
            elif _GOOD.search(value):
                lean -= 1.0
        elif name == "role":
            lean += _ROLES.get(value.lower(), 0.0)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            lean += 6.0
    return lean


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order."""
    state, at, in_head = _Page(), 0, False
    in_link = 0
    ends = {t: max((m.start() for m in re.finditer(rf"</{t}\b", page, re.I)), default=-1) for t in _CONTROL | _SILENT}
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if not in_head and m.start() > at:
            piece = html.unescape(page[at : m.start()])
            state.parts.append(piece)
            if in_link:
                state.linked += len(piece)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing, empty = bool(m[1]), tag in _VOID or (m[3] or "").rstrip().endswith("/")
        if tag in _SILENT and not closing:
            if not empty:
                state.flush()
                at = _silent_end(page, at, tag, ends[tag], "head" if in_head else state.stack[-1].tag)
            continue
        if in_head:
            if closing and tag == "head":
                in_head = False
                continue
            if closing or tag not in _LANDMARK | {"body"}:
                continue
            in_head = False
        elif tag == "head" and not closing:
            state.flush()
            in_head = not empty
            continue
        if tag == "br":
            state.parts.append(" ")
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        if tag not in _INLINE:
            state.flush()
            in_link = 0
        if closing:
            state.close(tag)
        elif tag not in _VOID:
            if tag in _LANDMARK:
                state.end_unclosed(ends, at)
            state.leave_open(tag)
            if not empty:
                state.open(tag, m[3])
    if not in_head and at < len(page):
        state.parts.append(html.unescape(page[at:]))
    state.flush()
    return state.blocks


def _silent_end(page: str, at: int, tag: str, last: int, parent: str) -> int:
    """Where the text goes on after a silent element that opens before ``at``: behind its
    end tag or, if none follows, where its parent closes or a landmark opens."""
    if last >= at:
        return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at).end()
    found = [_LANDED.search(page, at), re.compile(rf"</{re.escape(parent)}\b", re.I).search(page, at) if parent else None]
    return min((f.start() for f in found if f), default=len(page))


def cost(b: Block, any_inside: bool) -> float:
    """Cost of calling ``b`` content less that of calling it boilerplate."""
    out = b.lean - 0.5
    if any_inside and not b.inside:
        out += 2.0
    share = min(b.linked / max(len(b.text), 1), 1.0)
    out += 3.0 * share if len(b.text) < 200 or share > 0.7 else share
    words = b.text.count(" ") + 1
    if words >= 20:
        out -= 1.5
    elif words <= 3 and not b.inside and not b.heading:
        out += 1.0
    if b.heading:
        out -= 0.5
    if len(b.text) < 300 and _LEGAL.search(b.text):
        out += 0.5 if b.inside else 2.0
    return out


def min_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True where a node falls on the content side of the minimum cut. Node ``i`` is
    tied to the source by its negative cost, to the sink by its positive one. The flow grows
    by blocking flows over shortest paths, with a current edge for every node, so a graph
    that is a chain takes a few rounds over its edges."""
    n = len(costs)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def add(a: int, b: int, forth: float, back: float) -> None:
        graph[a].append(len(to))
        graph[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, c in enumerate(costs):
        add(source, i, -c, 0.0) if c < 0 else add(i, sink, c, 0.0)
    for a, b, w in edges:
        add(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        current = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                full = len(path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= 1e-12:
                        full = min(full, k)
                at = to[path[full] ^ 1]  # go on from before the first full edge
                del path[full:]
                continue
            edges_here = graph[at]
            while current[at] < len(edges_here):
                e = edges_here[current[at]]
                if room[e] > 1e-12 and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                current[at] += 1
            else:
                if at == source:
                    break
                at = to[path.pop() ^ 1]
                current[at] += 1


def labels(found: list[Block]) -> list[bool]:
    """Which blocks are content. Runs of blocks in one container that all lean one way
    are one node, their costs summed: no cut can gain by parting them."""
    any_inside = any(b.inside for b in found)
    costs = [cost(b, any_inside) for b in found]
    nodes: list[list[int]] = []
    for i, b in enumerate(found):
        last = nodes[-1][-1] if nodes else None
        if last is not None and found[last].path == b.path and (costs[last] < 0) == (costs[i] < 0):
            nodes[-1].append(i)
        else:
            nodes.append([i])
    sums = [sum(costs[i] for i in node) for node in nodes]
    edges = []
    before: dict[int, int] = {}
    for k, node in enumerate(nodes):
        path = found[node[0]].path
        if k:
            edges.append((k - 1, k, NEAR if found[nodes[k - 1][0]].path == path else FAR))
        if before.get(path, k - 1) < k - 1:  # the container goes on after something else
            edges.append((before[path], k, NEAR))
        before[path] = k
    out = [False] * len(found)
    for node, content in zip(nodes, min_cut(sums, edges)):
        for i in node:
            out[i] = content
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, labels(found)) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows["text"] = [main_text(h) for h in rows.pop("html")]
            rows["n_chars"] = rows["text"].map(len)
            yield rows

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op8_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages"))
