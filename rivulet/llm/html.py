"""Main text of HTML pages by minimum-cut labelling of text blocks.

A lenient parse cuts a page into text blocks (runs of text between block-level tags), each with
its chain of ancestors.  A linear classifier over tag, class, link and length features gives
the cost of calling a block content or boilerplate; the two costs become the capacities from
the source and to the sink.  Neighbouring blocks, and the last block under the same parent, are
joined by smoothness edges whose capacity falls with their distance in the DOM.  The minimum cut
(Dinic) is the labelling of least total cost; blocks on the source side are the text.

Pages are independent: one Arrow pass, no shuffle, memory in proportion to one page.  The graph
has at most two edges per block.

Edge cases: a null or empty page has no text; malformed, nested and truncated markup is parsed
as far as it goes; ids are never read and repeated rows get equal texts; further columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
SILENT = frozenset("script style noscript template head title svg annotation annotation-xml iframe object select textarea button datalist".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
CLOSES_P = BLOCK - {"option", "html", "body"}
ALIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}, "p": {"p"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

# Classifier: what an ancestor's tag, role, class or id says of a block (score towards content).
TAG_SCORE = {"nav": -12, "aside": -12, "form": -12, "footer": -12, "header": -8, "menu": -12, "dialog": -12, "fieldset": -8,
             "article": 6, "main": 4}
ROLE_SCORE = {"navigation": -12, "banner": -12, "contentinfo": -12, "complementary": -12, "search": -12, "form": -12, "alert": -12,
              "dialog": -12, "menu": -12, "menubar": -12, "main": 4, "article": 6}
NAME_SCORE = {w: -12 for w in (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu sidebar "
    "aside widget footer cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup "
    "login form search comment comments commentlist disqus reply replies respond discussion share sharing social breadcrumb "
    "breadcrumbs pagination pager related recommended teaser toolbar masthead topbar bottombar copyright disclaimer skip"
).split()} | {"header": -8, "head": -4} | {w: 4 for w in "article content post entry story body main text".split()}
LAYOUT_WORDS = frozenset("wrap wrapper container layout".split())
# Words that articles use themselves, in slugs and styles; words that make a known compound with a name;
# prefixes of classes that file an article under a topic.
PLAIN_WORDS = frozenset(
    "form search comment reply replies respond discussion share sharing social related recommended alert notice notification "
    "skip disclaimer copyright consent promotion advertising navigation banner menu cookie cookies signup login subscribe".split())
COMPOUND_WORDS = frozenset(
    "site page box bar block list links link posts articles section area thread inner outer top bottom left right buttons button "
    "icons icon title item items module component embed inline unit slot feed cta js".split()) | LAYOUT_WORDS | NAME_SCORE.keys()
TOPIC_PREFIXES = frozenset("category tag topic type format".split())
TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
TITLE_INSIDE = -1  # a header within the article holds its title
LINK_WEIGHT, LENGTH_WEIGHT, PARAGRAPH, HEADING, BIAS = -5.0, 0.9, 0.8, 1.5, -2.2
SMOOTH = 1.2  # capacity between neighbours that are siblings


class Node:
    """An open block element: its place in the tree and what its ancestors say of content."""

    __slots__ = ("parent", "number", "tag", "depth", "standing")

    def __init__(self, parent: Node | None, number: int, tag: str, score: float):
        self.parent, self.number, self.tag = parent, number, tag
        self.depth = parent.depth + 1 if parent else 0
        self.standing = next_standing(parent.standing, score) if parent else 0.0


class Block:
    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: Node, linked: int):
        self.text, self.node, self.linked = text, node, linked


class _Page(HTMLParser):
    """Work per tag does not grow with the number of open elements: the places of every kind of open
    element and of open blocks are kept beside the stack, ancestors as parent links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, Node]] = []  # (tag, silent ones before it, its or the next outer block)
        self.places: dict[str, list[int]] = {}  # by tag
        self.open_blocks: list[int] = []
        self.root = Node(None, 0, "body", 0.0)
        self.blocks: list[Block] = []
        self.buffer: list[str] = []
        self.linked = self.silent = self.number = 0

    def _node(self) -> Node:
        return self.stack[-1][2] if self.stack else self.root

    def _last(self, tag: str) -> int:
        """Place of the innermost open element of this kind (-1: none)."""
        return self.places[tag][-1] if self.places.get(tag) else -1

    def flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            self.blocks.append(Block(text, self._node(), self.linked))
        self.buffer, self.linked = [], 0

    def _close_to(self, at: int) -> None:
        for tag, _, _ in self.stack[at:]:
            self.silent -= tag in SILENT
            self.places[tag].pop()
            if tag in BLOCK:
                self.open_blocks.pop()
        del self.stack[at:]

    def _close_head(self, tag: str) -> None:
        """An open head ends at <body> and, outside its own elements, at any tag it cannot hold."""
        at = self.places["head"][0] if self.places.get("head") else -1
        if at >= 0 and (tag == "body" or self.silent - self.stack[at][1] <= 1):
            self._close_to(at)

    def _close_implied(self, tag: str) -> None:
        ends = ALIKE.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        stop = HOLDERS.get(tag)
        while ends:
            if stop:
                at = max(map(self._last, ends))
                barrier = max(map(self._last, stop))
            else:  # any block that is not to be closed
                at = self.open_blocks[-1] if self.open_blocks else -1
                barrier = -1 if at >= 0 and self.stack[at][0] in ends else at
            if at <= barrier:
                break
            self._close_to(at)
            ends = ends - {"p"}

    def handle_starttag(self, tag, attrs) -> None:
        if self.silent and tag not in IN_HEAD:
            self._close_head(tag)
        if tag in BLOCK:
            self.flush()
            self._close_implied(tag)
        elif tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        self.number += 1
        node, at = self._node(), len(self.stack)
        if tag in BLOCK:
            inside = self._last("article") >= 0 or self._last("main") >= 0
            node = Node(node, self.number, tag, _score(tag, dict(attrs), inside))
            self.open_blocks.append(at)
        self.stack.append((tag, self.silent, node))
        self.places.setdefault(tag, []).append(at)
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag) -> None:
        if tag in BLOCK:
            self.flush()
        at = self._last(tag)
        # an inline end tag does not close blocks
        if at >= 0 and (tag in BLOCK or not self.open_blocks or self.open_blocks[-1] < at):
            self._close_to(at)

    def handle_data(self, data) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._close_head("")
        if not self.silent:
            self.buffer.append(data)
            if any(t == "a" for t, _, _ in self.stack[-4:]):
                self.linked += len(data.strip())


_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _tells(tag: str, words: set, name: str, is_id: bool) -> bool:
    """Whether a name within an article, as part of the token ``words``, speaks against content."""
    if tag in ("article", "main"):
        return False  # the tag says what it is
    if name not in PLAIN_WORDS and not is_id:
        return not words & TOPIC_PREFIXES
    if not words <= COMPOUND_WORDS:
        return False  # a slug
    return name not in PLAIN_WORDS or tag not in TEXT_TAGS and (len(words) > 1 or not is_id)


def _score(tag: str, attrs: dict, inside: bool) -> float:
    """What an element says of content; ``inside``: it is within an article."""
    score = TAG_SCORE.get(tag, 0)
    if tag == "header" and inside:
        score = TITLE_INSIDE
    score += ROLE_SCORE.get((attrs.get("role") or "").lower(), 0)
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        score -= 12
    if tag in ("html", "body"):
        return score  # their names describe the whole page
    own = [(x, False) for x in (attrs.get("class") or "").split()]
    if not (tag in TEXT_TAGS and tag[0] == "h"):  # the id of a heading is made of its title
        own += [(x, True) for x in (attrs.get("id") or "").split()]
    own = [({p.lower() for p in _NAME_PARTS.findall(x)}, is_id) for x, is_id in own]
    names = {n for words, _ in own for n in words}
    counted = {n for words, is_id in own for n in words if n in NAME_SCORE
               and (NAME_SCORE[n] > -12 or not (inside or tag in ("article", "main")) or _tells(tag, words, n, is_id))}
    found = [NAME_SCORE[n] for n in counted]
    if names & LAYOUT_WORDS and max(found, default=0) > 0 or names & {"has", "with", "no"}:
        found = [s for s in found if s > 0]  # a frame around the content and something else
    if inside or max(found, default=0) > 0:
        found = [TITLE_INSIDE if s in (-8, -4) else s for s in found]
    return score + min(found, default=0) + (max(found, default=0) if min(found, default=0) >= TITLE_INSIDE else 0)


def next_standing(standing: float, score: float) -> float:
    """What the ancestors say of content, taken on by one element, from the outermost inwards: a strong
    word against content wins over what stands around it, and nothing within it speaks for content
    any more (an advert in an article, an article in a sidebar)."""
    if score <= -4:
        return min(standing, 0.0) + score
    if score < 0:
        return standing + score
    return max(standing, score) if standing >= TITLE_INSIDE else standing


def block_score(block: Block, bias: float = BIAS) -> float:
    """Log odds of content: ancestors, share of linked text, length, own tag."""
    n, tag = len(block.text), block.node.tag
    return (bias + block.node.standing + LINK_WEIGHT * min(1.0, block.linked / n)
            + LENGTH_WEIGHT * min(4.0, math.log(n) - 1) + PARAGRAPH * (tag in ("p", "pre", "blockquote"))
            + HEADING * (tag[0] == "h" and tag[1:].isdigit()))


def _tree_distance(a: Node, b: Node) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of a minimum cut; ``edges`` are undirected."""
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(there)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i in range(n):  # what both terminals could push through a node at once is cut off first
        through = min(source[i], sink[i])
        if source[i] > through:
            link(s, i, source[i] - through, 0.0)
        elif sink[i] > through:
            link(i, t, sink[i] - through, 0.0)
    for a, b, c in edges:
        link(a, b, c, c)

    while True:
        level = [-1] * (n + 2)
        level[s], queue = 0, [s]
        for a in queue:
            for e in out[a]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:  # blocking flow, one augmenting path after the other
            if a == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                first = next(k for k, e in enumerate(path) if cap[e] <= 1e-12)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if cap[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == s:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def label(blocks: list[Block], bias: float = BIAS) -> list[bool]:
    scores = [block_score(b, bias) for b in blocks]
    soft = lambda x: math.log1p(math.exp(-abs(x))) + max(x, 0.0)
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, SMOOTH / max(1, _tree_distance(blocks[i - 1].node, b.node) - 1)))
        parent = b.node.parent.number if b.node.parent else 0
        if last.get(parent, i - 1) != i - 1:
            edges.append((last[parent], i, SMOOTH / 2))
        last[parent] = i
    return minimum_cut([soft(x) for x in scores], [soft(-x) for x in scores], edges)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    parser = _Page()
    parser.feed(page)
    parser.close()
    parser.flush()
    blocks = parser.blocks
    kept = label(blocks)
    if not any(kept):  # a short page without any mark of content: a cut of what no ancestor speaks against
        blocks = [b for b in blocks if b.node.standing > -4]
        kept = label(blocks, 0.0)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def main_text_column(page: Column) -> Column:
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], type=pa.string())

    return F.arrow_udf(extract, "string")(page)


def extract_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` plus the main text of each page."""
    return df.withColumn(out, main_text_column(F.col(html)))
