"""Operator 8: HTML extraction by minimum cut.

A page is read into blocks of text (a tolerant tokeniser; unclosed and stray tags are fine). A linear
classifier gives each block a cost of being called content or boilerplate from its own element, its length and
its share of links, and each box around blocks one from its element and the words in its class and id; the
costs are their capacities to the two terminals. Edges of DOM proximity join a block to the box that
speaks strongest for content and to that which speaks strongest for boilerplate; neighbouring blocks, and
blocks that follow each other under one parent, are joined by edges that are weaker the farther apart they
are in the DOM. The minimum cut labels all blocks and boxes of the page at once: a short line within an
article stays with it, a long advert goes with its box, and a box whose name only partly sounds like
boilerplate (``related-work``) is outvoted by its text.

A block whose own capacity outweighs all its edges has its label in every minimum cut; such blocks are
fixed first and their edges become capacities of their neighbours. A max-flow labels what remains. Each
page is one row and needs no other, so the work is one map over the pages.

Results for odd inputs: a null or empty html, or one without content, gives an empty text; pages of any
length are read whole, a quote or tag that never ends costs only its tag (after ``BROKEN_TAGS`` of them tags end at
the next angle bracket, quoted or not); repeated rows give repeated results; an empty table gives an empty table; a column
called like the result is replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import without

# Names of elements and words in class, id and role attributes, and the weights they carry.
SKIPPED = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title",
           "select", "button", "textarea", "canvas", "audio", "video")
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
                   "p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: a start tag of the key ends an open element of these names
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: elements beyond which an implied end does not reach
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
          "th": ("table", "tr"), "p": tuple(BLOCKS - {"p"}), "option": ("select",)}
ELEMENT_WEIGHT = {"nav": -9.0, "menu": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "fieldset": -9.0,
                  "dialog": -9.0, "header": -5.0, "article": 6.0, "main": 5.0}
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted "
    "banner cookie cookies consent gdpr notice notices notification alert popup overlay modal newsletter "
    "subscribe subscription sidebar aside widget widgets related recommended recommendations share sharing "
    "social breadcrumb breadcrumbs menu nav navbar navigation topbar masthead footer copyright disclaimer legal comment "
    "comments commentlist reply replies respond disqus login signin signup register search toolbar pagination "
    "pager skip hidden form".split())
#: words that say nothing beside a boilerplate word
LAYOUT_WORDS = frozenset(
    "area bar block box button buttons col column container footer global group header inner item items layout left "
    "links list menu outer page panel policy post posts right row section site slot top bottom unit wrap wrapper".split())
CONTENT_WORDS = frozenset("article post entry content main story body text prose".split())
BOILER_WORD_WEIGHT, CONTENT_WORD_WEIGHT, HEADER_WORD_WEIGHT = -9.0, 3.0, -3.0
#: a boilerplate word among others in one name: the box is joined by edges of this weight and can be outvoted
MIXED_NAME_WEIGHT = -2.5
#: capacity of a box that is not outvoted
FIRM = 1e6
BROKEN_TAGS = 16
SMOOTH_NEXT, SMOOTH_SIBLING = 1.0, 0.8

ASIDE = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
TAG = re.compile(r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
BROKEN_TAG = re.compile(r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/<>]*)(?P<rest>[^<>]*)>?")
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[A-Za-z][a-z]*")
UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


@dataclass(slots=True)
class Element:
    name: str
    #: the strongest weights of the element and its ancestors, each with the number of the box that has it; ``firm`` is
    #: the part of ``boiler`` that comes from names of elements and hidden ones, ``own`` the element's own part
    boiler: tuple[float, int]
    content: tuple[float, int]
    firm: tuple[float, int]
    own: float
    depth: int
    number: int
    link: bool
    #: place in the stack of the innermost block element
    holder: int


@dataclass(slots=True)
class Block:
    text: str
    parent: Element
    #: the element around ``parent``
    around: int
    linked: int


def _named_weight(rest: str) -> tuple[float, float, bool]:
    """Weights of the words in an element's attributes, and whether it is hidden."""
    boiler = content = 0.0
    for m in NAMED.finditer(rest):
        for name in (m.group(1) or m.group(2) or m.group(3) or "").split():
            words = {w.lower() for w in NAME_WORD.findall(name)}
            whole = {w for w in re.split(r"[\d_\-]+", name.lower()) if w}
            if (words | whole) & BOILER_WORDS:
                known = BOILER_WORDS | CONTENT_WORDS | LAYOUT_WORDS
                boiler = min(boiler, BOILER_WORD_WEIGHT if words <= known or whole <= known else MIXED_NAME_WEIGHT)
            elif "header" in words | whole:
                boiler = min(boiler, HEADER_WORD_WEIGHT)
            elif (words | whole) & CONTENT_WORDS:
                content = max(content, CONTENT_WORD_WEIGHT)
    unseen = UNSEEN.search(rest) is not None
    if unseen:
        boiler = BOILER_WORD_WEIGHT
    return boiler, content, unseen


def read_blocks(page: str) -> list[Block]:
    """The blocks of visible text of a page in order."""
    root = Element("", (0.0, 0), (0.0, 0), (0.0, 0), 0.0, 0, 0, False, 0)
    stack, blocks, parts = [root], [], []
    linked = made = broken = 0
    opened: Counter[str] = Counter()

    def close_from(i: int) -> None:
        opened.subtract(e.name for e in stack[i:])
        del stack[i:]

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                at = stack[-1].holder
                blocks.append(Block(text, stack[at], stack[max(0, at - 1)].number, linked))
            parts, linked = [], 0

    def text(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if stack[-1].link:
            linked += len(piece.strip())

    at, size = 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin != at:
            text(page[at:begin] if begin > 0 else page[at:])
        if begin < 0:
            break
        if aside := ASIDE.match(page, begin):
            at = aside.end()
            continue
        m = TAG.match(page, begin) if broken < BROKEN_TAGS else None
        if m is None:
            m = BROKEN_TAG.match(page, begin)
            if m is None:
                text("<")
                at = begin + 1
                continue
            broken += 1
        at, name = m.end(), m.group("name")
        name = name.lower()
        if m.group("close"):
            if opened[name] > 0:
                i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name)
                if any(e.name in BLOCKS for e in stack[i:]):
                    flush()
                close_from(i)
            continue
        rest = m.group("rest") or ""
        if name in SKIPPED:
            if rest.endswith("/"):
                continue
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            # an unclosed head ends where the body begins, any other where the page ends
            if end is None and name in ("head", "title"):
                end = re.compile(r"(?=<body\b)" if name == "head" else r"(?=<)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCKS:
            flush()
        if name in VOID:
            continue
        if any(opened[x] > 0 for x in CLOSES.get(name, ())):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in CLOSES[name]:
                    close_from(i)
                    break
                if stack[i].name in FENCES[name]:
                    break
        if rest.endswith("/") and name not in BLOCKS:
            continue
        # words on html and body tell of the page's layout, not of its text
        boiler, content, unseen = (_named_weight(rest) if ("=" in rest or "hidden" in rest)
                                   and name not in ("html", "body") else (0.0, 0.0, False))
        own = ELEMENT_WEIGHT.get(name, 0.0)
        up = stack[-1]
        if name == "header" and up.content[0] >= 5.0:
            own = 0.0  # the head of an article holds its title
        # an article begins anew, unless it is a child of a boilerplate box
        inherited = up.firm if name in ("article", "main") and not up.own < 0 else up.boiler
        made += 1
        stack.append(Element(
            name, min(inherited, (min(boiler, own), made)), max(up.content, (max(content, own), made), key=lambda x: x[0]),
            min(up.firm, (min(own, boiler if unseen else 0.0), made)), min(boiler, own), up.depth + 1, made,
            up.link or name == "a", len(stack) if name in BLOCKS else up.holder))
        opened[name] += 1
    flush()
    return blocks


def log_odds(block: Block) -> float:
    """The classifier of a block by itself: over 0 for content."""
    words = block.text.count(" ") + 1
    density = min(1.0, block.linked / len(block.text))
    at = -0.8 + min(words, 40) * 0.06 - 3.0 * density
    name = block.parent.name
    if name in ("p", "blockquote", "pre"):
        at += 0.8
    elif name in ("h1", "h2", "h3"):
        at += 0.5
    elif name in ("li", "td", "th", "tr"):
        at -= 0.3
    elif name in ("", "body", "html"):
        at -= 0.5
    if block.text[0] in "©":
        at -= 4.0
    return at


def smoothness(blocks: Sequence[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours and between followers under one parent's parent."""
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            steps = abs(a.parent.depth - b.parent.depth) + (a.around != b.around) + (a.parent is not b.parent)
            edges.append((i - 1, i, SMOOTH_NEXT / (1 + steps)))
        if b.around in last:
            edges.append((last[b.around], i, SMOOTH_SIBLING / (i - last[b.around])))
        last[b.around] = i
    return edges


def boxes(blocks: Sequence[Block]) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Costs of the boxes that speak for content or boilerplate, as nodes after the blocks, and their edges."""
    place: dict[tuple[int, bool], int] = {}
    odds, edges = [], []
    for i, b in enumerate(blocks):
        for weight, number in (b.parent.content, b.parent.boiler):
            if weight:
                at = place.setdefault((number, weight > 0), len(blocks) + len(odds))
                if at == len(blocks) + len(odds):
                    odds.append(weight if weight == MIXED_NAME_WEIGHT else FIRM if weight > 0 else -FIRM)
                edges.append((i, at, abs(weight)))
    return odds, edges


def labels_of(blocks: Sequence[Block]) -> list[bool]:
    """Which blocks are content, by the minimum cut over blocks and boxes."""
    named, near = boxes(blocks)
    return min_cut([log_odds(b) for b in blocks] + named, smoothness(blocks) + near)[:len(blocks)]


def min_cut(odds: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of least cost: capacity of wrong terminals plus that of edges cut."""
    n = len(odds)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    own = list(odds)
    reach = [sum(w for _, w in x) for x in near]
    label: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if label[i] is None and abs(own[i]) > reach[i]:
            label[i] = own[i] > 0
            for j, w in near[i]:
                if label[j] is None:
                    own[j] += w if label[i] else -w
                    reach[j] -= w
                    waiting.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        left = [(place[a], place[b], w) for a, b, w in edges if a in place and b in place]
        for i, content in zip(rest, _flow_side([own[i] for i in rest], left)):
            label[i] = content
    return [bool(x) for x in label]


def _flow_side(odds: Sequence[float], edges: Sequence[tuple[int, int, float]]) -> list[bool]:
    """Blocks on the content side of the minimum cut, by Dinic's max-flow."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            join(source, i, x, 0.0)
        elif x < 0:
            join(i, sink, -x, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                path, a = [], source
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] > 1e-12 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break


def main_text(page: str | None) -> str:
    """Content blocks of a page, one per line."""
    if not page:
        return ""
    blocks = read_blocks(page)
    return "\n".join(b.text for b, k in zip(blocks, labels_of(blocks)) if k)


def extract(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``source`` in ``out``."""
    return without(pages, *([out] if out != source else [])).withColumn(out, extracted(F.col(source)))


def extracted(source: Column) -> Column:
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None).astype(object)

    return texts(F.coalesce(source, F.lit("")))
