"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of blocks (text between the borders of block-level elements) and the tree of
containers around them. A linear classifier over tag names, class words, link share, length and
position gives each block a cost of being content and a cost of being boilerplate; these are the
capacities to the two terminals. A container that holds most of the page's text around a content container
is a wrapper, whatever its class. Neighbouring blocks and blocks of one container are tied by
smoothness edges; containers take part as nodes, so the number of edges is linear in the blocks.
The minimum cut, found by max-flow, splits content from boilerplate at the least total cost.

Scripts, styles, form controls and hidden elements are never blocks. Character references are
decoded, white space inside a block becomes one space, blocks are joined in page order by a line
break. Null, empty and text-free pages give an empty text; a page without any markup is one block.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import map_batches

OUTPUT = "page_id long, url string, text string, n_chars long"

# Fixed values of HTML: elements whose content is no text of the page, elements without an end,
# and elements that begin and end a block.
SILENT = frozenset("script style noscript template iframe svg object canvas audio video head title "
                   "select option button textarea datalist input dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul".split())
# An open element of the first kind ends where one of the second begins.
CLOSED_BY = {
    "p": BLOCK - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"},
}
# A start tag looks no further up than these for an element that it ends.
SCOPES = frozenset("table td th ul ol dl div section article aside nav form main body html".split())
RAW = frozenset("script style textarea title".split())  # no tags inside
DEEPEST = 512  # elements nested deeper count as part of the one at this depth
HEAD = frozenset("title meta link script style noscript base template basefont bgsound".split())  # all that a head holds
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# The classifier: weights in favour of content, documented parameters and not fitted to any page.
TAG_WEIGHT = {
    "article": 3.0, "main": 2.0, "nav": -8.0, "footer": -6.0, "aside": -6.0, "form": -6.0, "fieldset": -6.0,
    "menu": -6.0, "address": -1.0,
}
PAGE_HEADER = -6.0  # a header outside the article; inside, it holds the article's title
WORD_WEIGHT = {
    "article": 2.0, "content": 2.0, "entry": 1.5, "post": 1.5, "story": 2.0, "main": 1.5, "body": 1.0, "text": 1.0,
    "ad": -8.0, "ads": -8.0, "advert": -8.0, "adverts": -8.0, "advertisement": -8.0, "sponsor": -8.0,
    "sponsored": -8.0, "promo": -8.0, "promotion": -8.0, "banner": -8.0, "comment": -8.0, "comments": -8.0,
    "disqus": -8.0, "reply": -8.0, "replies": -8.0, "cookie": -8.0, "cookies": -8.0, "consent": -8.0, "gdpr": -8.0,
    "notice": -8.0, "popup": -8.0, "modal": -8.0, "overlay": -8.0, "newsletter": -8.0, "subscribe": -8.0,
    "signup": -8.0, "login": -8.0, "sidebar": -8.0, "rail": -6.0, "widget": -8.0, "menu": -8.0, "nav": -8.0,
    "navbar": -8.0, "navigation": -8.0, "breadcrumb": -8.0, "breadcrumbs": -8.0, "pagination": -8.0, "pager": -8.0,
    "footer": -8.0, "foot": -6.0, "header": -3.0, "masthead": -8.0, "topbar": -8.0, "share": -8.0, "sharing": -8.0,
    "social": -8.0, "related": -8.0, "recommended": -8.0, "tags": -4.0, "legal": -6.0, "copyright": -8.0,
    "search": -8.0, "toolbar": -8.0, "skip": -8.0, "alert": -6.0, "outbrain": -8.0, "taboola": -8.0,
    "complementary": -8.0, "contentinfo": -8.0, "form": -6.0,
}
# A class that begins or ends with one of these tells of other parts of the page, or of its subject or state.
NOT_ITSELF = frozenset("has no with without is not category tag type format status".split())
STATE = frozenset("open opened closed enabled disabled active inactive on off visible hidden left right".split())
# On an article or main element only these words speak against it, and a container named by one of
# them, or of the tags below, is boilerplate however much of the page it holds.
FIRM_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo promotion comment comments disqus reply "
                       "replies related recommended".split())
FIRM_TAGS = frozenset("nav footer aside menu".split())
ARTICLE_WORDS = frozenset("article post entry story".split())
MOST = 0.5  # share of a page's unlinked text from which a container is a wrapper of the page
BIAS, LINK_SHARE, LONG_TEXT, HEADING = 0.5, -4.0, 1.5, 0.5
ADJACENT, TOGETHER = 0.6, 0.8  # smoothness: next blocks, and block or container to its container
# A strong word or tag ties its content to boilerplate; smoothness does not reach out of it.
BARRIER = -5.0

_TAG_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
_ATTRIBUTES = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden)\b(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Node:
    """A container: `own` is its weight, `weight` that of all around it, `firm` that it can't be a wrapper."""

    __slots__ = ("tag", "parent", "weight", "inside", "own", "firm", "chars", "holds")

    def __init__(self, tag, parent, inside, own, firm):
        self.tag, self.parent, self.inside, self.own, self.firm = tag, parent, inside, own, firm
        self.weight, self.chars, self.holds = 0.0, 0.0, False


def _class_words(value: str) -> set[str]:
    """Words of class, id or role, but for classes that tell of something else."""
    found: set[str] = set()
    for name in value.split():
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        if len(words) > 1 and (words[0] in NOT_ITSELF or words[-1] in STATE):
            continue
        found.update(words)
    return found


class _Reader:
    """Blocks `(text, container, share of characters in links, heading)` of a page, in one pass.

    Every construct that never ends is looked for once, so broken pages take linear time as well.
    """

    def __init__(self):
        self.stack = [_Node("html", None, False, 0.0, True)]
        self.nodes = list(self.stack)  # outer ones first
        self.silent = 0  # depth in the stack below which nothing is text, 0 for none
        self.in_link = False
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, _Node, float, bool]] = []

    def read(self, html: str) -> None:
        at, quoted = 0, True
        while at < len(html):
            lt = html.find("<", at)
            if lt < 0:
                lt = len(html)
            if lt > at:
                self.data(html[at:lt])
                at = lt
                continue
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = len(html) if end < 0 else end + 3
                continue
            name = _TAG_NAME.match(html, lt)
            if not name:
                if html.startswith(("<!", "<?", "</"), lt):
                    end = html.find(">", lt)
                    at = len(html) if end < 0 else end + 1
                else:
                    self.data("<")
                    at = lt + 1
                continue
            inner = _ATTRIBUTES.match(html, name.end()) if quoted else None
            if inner:
                attributes, at = inner.group(1), inner.end()
            else:
                quoted = False  # a quote that never ends; from here on a tag ends at the next >
                end = html.find(">", name.end())
                attributes, at = ("", len(html)) if end < 0 else (html[name.end():end], end + 1)
            tag = name.group(2).lower()
            if name.group(1):
                self.end(tag)
                continue
            self.start(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                stop = re.compile(rf"</{tag}\b", re.I).search(html, at)
                at = stop.start() if stop else len(html)
        self.flush()

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                box = self.stack[-1]
                self.blocks.append((text, box, min(1.0, self.linked / len(text)), box.tag in HEADINGS))
            self.parts = []
        self.linked = 0

    def leave_head(self) -> None:
        """A head ends where something begins that it can't hold; its end tag may be left out."""
        if self.silent and len(self.stack) == self.silent and self.stack[-1].tag == "head":
            self._pop_to(self.silent - 1)

    def data(self, text: str) -> None:
        if self.silent and text.strip():
            self.leave_head()
        if not self.silent:
            text = unescape(text) if "&" in text else text
            self.parts.append(text)
            if self.in_link:
                self.linked += len(text)

    def _pop_to(self, depth: int) -> None:
        del self.stack[depth:]
        if self.silent > len(self.stack):
            self.silent = 0

    def start(self, tag: str, attributes: str) -> None:
        hidden, words = False, set()
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
                if name in ("class", "id", "role"):
                    words |= _class_words(value)
                elif name == "hidden" or name == "style" and _HIDDEN.search(value):
                    hidden = True
        if self.silent and tag not in HEAD:
            self.leave_head()
        controls = tag == "label" and any(n.tag in ("form", "fieldset") for n in self.stack)
        hidden = (hidden or controls or tag in SILENT) and tag not in VOID
        if tag == "a":
            self.in_link = True
        elif tag == "br" and not self.silent:
            self.parts.append(" ")
        if tag not in BLOCK and not hidden:
            return  # inline: part of the block around it
        if tag in BLOCK and not self.silent:
            self.flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            over = self.stack[depth].tag
            if tag in CLOSED_BY.get(over, ()):
                self._pop_to(depth)
                break
            if over in SCOPES or over in SILENT:
                break
        if tag in VOID or len(self.stack) >= DEEPEST:
            return
        top = self.stack[-1]
        own = TAG_WEIGHT.get(tag, 0.0)
        if tag == "header" and not top.inside:
            own = PAGE_HEADER
        words = {w for w in words if w in WORD_WEIGHT} if tag != "body" else set()
        if tag in ("article", "main"):
            words = {w for w in words if WORD_WEIGHT[w] > 0 or w in FIRM_WORDS}
        weights = [WORD_WEIGHT[w] for w in words]
        if weights:
            own += min(weights) if min(weights) < 0 else max(weights)
        inside = top.inside or tag in ("article", "main") or (own > 0 and bool(words & ARTICLE_WORDS))
        self.stack.append(_Node(tag, top, inside, own, tag in FIRM_TAGS or bool(words & FIRM_WORDS)))
        self.nodes.append(self.stack[-1])
        if hidden and not self.silent:
            self.silent = len(self.stack)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag not in BLOCK and tag not in SILENT and tag != "label" or tag in VOID:
            return
        if tag in BLOCK and not self.silent:
            self.flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                self._pop_to(depth)
                return
            if tag not in BLOCK and self.stack[depth].tag in BLOCK:
                return  # an inline end tag does not end a block


def read_blocks(html: str) -> list[tuple[str, _Node, float, bool]]:
    reader = _Reader()
    reader.read(html)
    _settle(reader.nodes, reader.blocks)
    return reader.blocks


def _settle(nodes: list[_Node], blocks: list[tuple[str, _Node, float, bool]]) -> None:
    """Weigh the containers by what they hold.

    One that speaks against itself by a word or a tag, but holds most of the page's unlinked text and in
    it a container that speaks for content, is a wrapper of the page: its own weight doesn't count.
    """
    for text, box, links, _ in blocks:
        box.chars += len(text) * (1.0 - links)
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.holds |= node.holds or node.own > 0
    total = nodes[0].chars
    for node in nodes:
        if node.own < 0 and not node.firm and node.holds and node.chars > MOST * total:
            node.own = 0.0
        node.weight = (node.parent.weight if node.parent is not None else 0.0) + node.own


def content_score(text: str, box: _Node, links: float, heading: bool) -> float:
    """Above 0 in favour of content."""
    return BIAS + box.weight + LINK_SHARE * links + LONG_TEXT * min(1.0, len(text) / 400) + HEADING * heading


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side: those with scores above 0 pull to it, smoothness ties.

    A score is the difference of the two terminal capacities, since the common part of both is cut
    in any case. Max-flow by Dinic's method from all pulling nodes to all others.
    """
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        cap.append(there)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            edge(source, i, s, 0.0)
        elif s < 0:
            edge(i, sink, -s, 0.0)
    for a, b, c in edges:
        edge(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(cap[e] for e in path)
                for k, e in enumerate(path):
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            for i in range(at[a], len(out[a])):
                e = out[a][i]
                if cap[e] > tiny and level[to[e]] == level[a] + 1:
                    at[a] = i
                    path.append(e)
                    a = to[e]
                    break
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]


def label_blocks(blocks: list[tuple[str, _Node, float, bool]]) -> list[bool]:
    """True for content."""
    scores = [content_score(*b) for b in blocks]
    edges: list[tuple[int, int, float]] = []
    number: dict[int, int] = {}

    def node(box: _Node) -> int:
        """The container as a node without a pull of its own, tied to the one around it."""
        path = []
        while box is not None and id(box) not in number:
            number[id(box)] = len(scores)
            scores.append(0.0)
            path.append(box)
            box = box.parent if box.own > BARRIER else None
        for b in path:
            if b.parent is not None and b.own > BARRIER and id(b.parent) in number:
                edges.append((number[id(b)], number[id(b.parent)], TOGETHER))
        return number[id(path[0])] if path else number[id(box)]

    boxes = [b[1] for b in blocks]
    for i, box in enumerate(boxes):
        edges.append((i, node(box), TOGETHER))
        if i and boxes[i - 1].parent is box.parent:
            edges.append((i - 1, i, ADJACENT))
    return minimum_cut(scores, edges)[:len(blocks)]


def extract(html: str) -> str:
    blocks = read_blocks(html)
    return "\n".join(b[0] for b, keep in zip(blocks, label_blocks(blocks)) if keep)


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row `page_id, url, text, n_chars`, whole pages, one pass and no shuffle."""
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )

    def run(batches):
        for b in batches:
            texts = [extract(h) for h in b["html"]]
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(rows, run, OUTPUT)
