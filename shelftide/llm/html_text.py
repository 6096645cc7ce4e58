"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A linear classifier on a block's length, links, element and
ancestors gives the cost of each label: a block with a positive score hangs on the source (content)
by that capacity, one with a negative score on the sink (boilerplate). Blocks next to each other,
and blocks that follow each other under the same parent, are joined by smoothness edges that weaken
with their distance in the element tree. The minimum cut, found by maximum flow, labels all blocks
of the page at once; the blocks on the source's side are the text.

What speaks against an element (its kind, the words of its class, id and role) holds for all text in
it, unless it wraps the text: html, body, main and article are never held to be boilerplate, nor is
what holds main, an article longer than all other text, or nearly all text (``against``).

Text that nothing speaks against is content, however short: list items and cells of a table as well as
bare words. The classifier's weights are fixed: no table labels pages. What is not text for a reader (scripts,
styles, the head, form controls, drawings, what stands in for media) makes no blocks; math does.

Defined results: a null or empty page, and one without blocks of content, give an empty text;
a page of any length is read whole;
unclosed and misnested elements, an unfinished last tag and unknown references are read as browsers
read them, as far as text goes; a block tied at 0 goes where the cut puts it, to the
boilerplate if both sides cost the same; repeated rows are handled row by row; an empty table gives no rows;
an added column takes the place of a carried one of its name, others are not looked at.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame

from shelftide.llm.common import strings, with_columns

#: A comment, a declaration, or a tag with its quoted attribute values; an unfinished one to the end.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
#: Every attribute, so that names are met at their start and values are not read for names.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
#: Elements whose content is read up to their end tag, or to the end of the page, as no markup.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
END_OF = {t: re.compile(rf"</{t}\s*(?:>|\Z|/)", re.I) for t in RAW}
#: Elements without text for a reader; what they are not closed by, their parents' end tags close.
SILENT = {"head", "button", "datalist", "option", "optgroup", "dialog", "noscript", "template", "svg",
          "select", "object", "canvas", "audio", "video", "annotation", "annotation-xml"}
#: Of these, the ones in which a block starts without closing a paragraph around them.
APART = {"noscript", "template", "select", "object"}
#: Elements of svg and math in which HTML goes on.
HTML_IN = {"foreignobject", "desc", "title", "mi", "mo", "mn", "ms", "mtext", "annotation-xml"}
#: Start tags that end svg or math left open, beside those of blocks.
LEAVES = {"b", "big", "br", "code", "em", "embed", "i", "img", "listing", "meta", "nobr", "ruby", "s",
          "small", "span", "strong", "strike", "sub", "sup", "tt", "u", "var"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
         "h4", "h5", "h6", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "ol",
         "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
         "ul", "hr", "head", "search"}
#: A start tag of the left closes an open element of the right, up to a container.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"ul", "ol", "dl", "menu", "table", "tbody", "thead", "tfoot", "select"}
AWAY = {"nav", "aside", "footer", "form", "menu", "search", "fieldset"}
NO_WRAPPER = {"nav", "aside", "footer", "menu", "search"}
TOWARD = {"article", "main"}
WORDS_AWAY = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "consent", "contentinfo", "complementary", "cookie",
    "cookies", "copyright", "disclaimer", "disqus", "footer", "form", "gdpr", "login", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply",
    "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "topbar", "widget", "widgets"}
WORDS_TOWARD = {"article", "body", "content", "entry", "main", "post", "story", "text"}
NAME = re.compile(r"[a-z]+", re.I)
#: A class with one of these says what a page has (has-sidebar, no-comments), not what the element is.
STATES = {"has", "no", "not", "with", "without"}
#: What an element that is named or made as boilerplate adds to the score of the text in it, and the
#: capacity of an edge between next neighbours: two of them outweigh a block that only looks unlike text,
#: none outweighs what is named as boilerplate.
AGAINST, SMOOTH = -12.0, 1.0
#: Without main or an article, an element holds nearly all text if it has so many times the rest's words.
NEARLY_ALL = 3


def leaning(tag: str, attributes: str, within: bool) -> tuple[float, float, float, str]:
    """How far an element speaks against the text in it by what it is and by being hidden, how far for
    it, and whether it is the page's "main" or an "article" that is not named otherwise."""
    away, hidden, toward = AGAINST if tag in AWAY else 0.0, 0.0, 3.0 if tag in TOWARD else 0.0
    kind, seen = tag if tag in TOWARD else "", set()
    if tag in ("html", "body"):
        return 0.0, 0.0, 0.0, ""
    if tag == "header" and not within:
        away = AGAINST
    for name, value in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name in seen:
            continue
        seen.add(name)
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
            hidden -= 8.0
        elif name == "aria-hidden" and value == "true":
            away -= 8.0
        elif name in ("class", "id", "role"):
            if name == "role" and value.strip() in TOWARD:
                kind = value.strip()
            words = set()
            for part in value.split():
                own = set(NAME.findall(part))
                words |= set() if own & STATES else own
            if words & WORDS_AWAY or "header" in words and not within:
                away += AGAINST
            elif words & WORDS_TOWARD:
                toward = max(toward, 1.5)
    if tag in TOWARD or kind:
        return 0.0, hidden, toward, "" if kind == "article" and away else kind
    return away, hidden, toward, ""


class Elements:
    """The elements of a page by number: 0 is the page, and each comes after its parent."""

    def __init__(self):
        self.parent, self.away, self.hidden, self.words = [0], [0.0], [0.0], [0]
        self.main, self.article, self.apart = [0], [0], [False]

    def add(self, parent: int, away: float, hidden: float, kind: str, apart: bool = False) -> int:
        number = len(self.parent)
        self.parent.append(parent)
        self.away.append(away)
        self.hidden.append(hidden)
        self.words.append(0)
        self.main.append(self.main[parent] or number * (kind == "main"))
        self.article.append(self.article[parent] or number * (kind == "article"))
        self.apart.append(apart)
        return number

    def against(self) -> list[float]:
        """What speaks against the text of each element: the sum over it and what it is in.

        Left out are the elements that hold main, and one after the other those that hold an article
        of more words than all text in no such element, or ``NEARLY_ALL`` times its words; the words
        of main are counted where there is one, else those of articles may speak for what holds them
        and without any article all may. What is no wrapper by its kind (a menu, an aside, a footer) only main
        can speak for. Words in links and in hidden elements are not counted; where
        all is hidden, nothing is. Each round at least doubles the text, so there are few.
        """
        n, parent, away, hidden = len(self.parent), self.parent, list(self.away), list(self.hidden)

        def free(e, any_kind=False):
            while e:
                if any_kind or not self.apart[e]:
                    away[e] = 0.0
                e = parent[e]

        buried = [False] * n
        for e in range(1, n):
            buried[e] = buried[parent[e]] or hidden[e] < 0
        if not any(w for w, b in zip(self.words, buried) if not b):
            hidden, buried = [0.0] * n, [False] * n
        holds = [e for e in range(n) if self.words[e] and not buried[e]]
        mains = {self.main[e] for e in holds} - {0}
        for e in mains:
            free(e, any_kind=True)
        for e in range(1, n):
            buried[e] = buried[e] or buried[parent[e]] or self.apart[e] and away[e] < 0
        holds = [e for e in holds if not buried[e]]
        if mains:
            holds = [e for e in holds if self.main[e]]
        core = set(not mains and [e for e in holds if self.article[e]] or holds)
        while any(away):
            nearest = [0] * n
            for e in range(1, n):
                nearest[e] = e if away[e] else nearest[parent[e]]
            open_words, weight, parts = 0, {}, {}
            for e in holds:
                at, article = nearest[e], self.article[e]
                if not at:
                    open_words += self.words[e]
                elif e in core:
                    weight[at] = weight.get(at, 0.0) + self.words[e] / NEARLY_ALL
                    if article and nearest[article] == at:
                        parts[at, article] = parts.get((at, article), 0) + self.words[e]
            for (at, _), words in parts.items():
                weight[at] = max(weight[at], words)
            best = max(weight, key=weight.get, default=0)
            if not best or weight[best] <= open_words:
                break
            free(best)
        out = [0.0] * n
        for e in range(1, n):
            out[e] = out[parent[e]] + away[e] + hidden[e]
        return out


def self_closing(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not the end of an attribute value without quotes."""
    at = 1 + max(attributes.rfind(c) for c in " \t\n\r\f\"'")
    return (attributes.endswith("/") and "=" not in attributes[at:]
            and not attributes[:at].rstrip().endswith("="))


def blocks_of(page: str) -> list[tuple[str, tuple[int, ...], float]]:
    """Text, path of element numbers, and classifier score of every block, in page order."""
    # open elements: (tag, number, most that speaks for, silent, whether svg or math go on in it)
    stack = [("", 0, 0.0, False, False)]
    elements, done = Elements(), []
    pieces: list[str] = []
    links: list[str] = []
    anchor = 0

    def close_block():
        nonlocal pieces, links
        if pieces:
            raw = "".join(pieces)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                holder = next((e for e in reversed(stack) if e[0] in BLOCK), stack[0])
                share = len(" ".join("".join(links).split())) / len(text) if links else 0.0
                words = text.count(" ") + 1
                # links are what menus are made of, less so in an article, where they may be references
                score = (0.3 + 0.8 * log1p(words / 3) - (3.0 if stack[-1][2] >= 3 else 4.0) * min(1.0, share)
                         + stack[-1][2]
                         + (1.0 if holder[0] in ("p", "blockquote", "pre") else 0.0)
                         + (0.5 if holder[0] in ("h1", "h2", "h3") else 0.0)
                         + (0.5 if text[-1] in ".!?:\"”。" else 0.0)
                         - (2.0 if text[0] == "©" else 0.0))
                elements.words[stack[-1][1]] += round(words * max(0.0, 1.0 - share))
                done.append((text, tuple(e[1] for e in stack if e[0] in BLOCK), score, stack[-1][1]))
            pieces, links = [], []

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            raw = page[at:]
            at = size
        else:
            raw = page[at:m.start()]
            at = m.end()
        if raw and not stack[-1][3]:
            pieces.append(raw)
            if anchor:
                links.append(raw)
        if m is None or m.group(2) is None:
            continue
        tag, attributes = m.group(2).lower(), m.group(3)
        if not m.group(1) and stack[-1][4] and (tag in BLOCK or tag in LEAVES):
            while stack[-1][4]:
                stack.pop()
            anchor = sum(e[0] == "a" for e in stack)
        if tag == "br":
            pieces.append(" ")
        if m.group(1):
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if tag in BLOCK and not stack[k or -1][3]:
                close_block()
            if k:
                anchor -= sum(e[0] == "a" for e in stack[k:])
                del stack[k:]
            continue
        foreign = stack[-1][4] or tag in ("svg", "math")
        if foreign and self_closing(attributes):
            continue
        if tag in ("select", "input", "textarea") and any(e[0] == "select" for e in stack):
            while stack.pop()[0] != "select":
                pass
            anchor = sum(e[0] == "a" for e in stack)
            if tag == "select":
                continue
        if tag in RAW and not foreign:
            end = END_OF[tag].search(page, at)
            if end is None:
                at = size
            else:
                at = page.find(">", end.start()) + 1 or size
            continue
        if tag in BLOCK:
            # a block start ends a paragraph, and with it what was left open inside
            ends = len(stack)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    ends = k
                    break
                if stack[k][0] in BLOCK or stack[k][0] in APART:
                    break
            if not stack[ends - 1][3]:
                close_block()
            if ends < len(stack) and tag not in VOID:
                del stack[ends:]
                anchor = sum(e[0] == "a" for e in stack)
        if tag in VOID or not foreign and attributes.endswith("/") and tag not in BLOCK:
            continue
        for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if stack[k][0] in CLOSES[tag]:
                del stack[k:]
                anchor = sum(e[0] == "a" for e in stack)
                if tag != "tr":
                    break
            elif stack[k][0] in HOLDS:
                break
        _, parent, most, silent, _ = stack[-1]
        silent = silent or tag in SILENT or tag in RAW
        # text before a silent element left open must not be judged by it
        away, hidden, toward, kind = (0.0, 0.0, 0.0, "") if silent else leaning(tag, attributes, most >= 3)
        stack.append((tag, elements.add(parent, away, hidden, kind, tag in NO_WRAPPER), max(most, toward), silent,
                      foreign and tag not in HTML_IN))
        anchor += tag == "a"
    close_block()
    against = elements.against()
    return [(text, path, score + against[e]) for text, path, score, e in done]


def edges_of(paths: list[tuple[int, ...]]) -> dict[tuple[int, int], float]:
    """Smoothness: neighbours in the page, and neighbours under one parent, by tree distance."""
    edges: dict[tuple[int, int], float] = {}

    def join(a: int, b: int) -> None:
        p, q = paths[a], paths[b]
        common = 0
        for x, y in zip(p, q):
            if x != y:
                break
            common += 1
        distance = max(0, len(p) + len(q) - 2 * common - 2)
        edges[a, b] = edges.get((a, b), 0.0) + SMOOTH / (1 + distance)

    last: dict[tuple[int, ...], int] = {}
    for i, p in enumerate(paths):
        if i:
            join(i - 1, i)
        parent = p[:-1]
        if parent in last:
            join(last[parent], i)
        last[parent] = i
    return edges


def minimum_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay on the source's side: shortest augmenting paths, level by level."""
    n = len(scores)
    if not edges or all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        return [s > 0 for s in scores]
    source, sink = n, n + 1
    graph: list[dict[int, float]] = [{} for _ in range(n + 2)]
    for i, s in enumerate(scores):
        if s > 0:
            graph[source][i], graph[i][source] = s, 0.0
        elif s < 0:
            graph[i][sink], graph[sink][i] = -s, 0.0
    for (a, b), w in edges.items():
        graph[a][b] = graph[a].get(b, 0.0) + w
        graph[b][a] = graph[b].get(a, 0.0) + w
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for v, c in graph[u].items():
                if c > 1e-12 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return [i in level for i in range(n)]
        nexts = {u: iter(list(graph[u])) for u in level}
        path = [source]
        while path:  # a blocking flow along the levels
            u = path[-1]
            if u == sink:
                flow = min(graph[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    graph[a][b] -= flow
                    graph[b][a] += flow
                keep = next(k for k, (a, b) in enumerate(zip(path, path[1:]))
                            if graph[a][b] <= 1e-12)
                del path[keep + 1:]
                u = path[-1]
                continue
            for v in nexts[u]:
                if level.get(v) == level[u] + 1 and graph[u][v] > 1e-12:
                    path.append(v)
                    break
            else:
                level[u] = -1
                path.pop()


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    keep = minimum_cut([b[2] for b in blocks], edges_of([b[1] for b in blocks]))
    return " ".join(b[0] for b, k in zip(blocks, keep, strict=True) if k)


def extracted(pages: DataFrame, html: str = "html", carry=("page_id", "url")) -> DataFrame:
    """Adds text, the page's main text."""
    def start():
        def work(column):
            return [pa.array([main_text(h) for h in strings(column)], pa.string())]
        return work

    return with_columns(pages, [html], "text string", start, carry)
