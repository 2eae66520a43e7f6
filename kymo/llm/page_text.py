"""Main text of web pages as a minimum cut.

A page becomes a list of text blocks. A linear classifier gives every block a cost for either
label; the costs are capacities to source and sink. Neighbouring blocks and blocks near each
other in the document tree are tied by smoothness edges. The minimum cut keeps what stays on
the source's side.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import batched, rows

_OUT = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_kept", pa.int64())]
)

_HEAD = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
_RAW = re.compile(r"<(script|style|noscript|template|svg|textarea|select|iframe|title)\b", re.I)
_MARK = re.compile(r"[>\"']")
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HREF = re.compile(r"\bhref\b", re.I)

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p "
    "pre section summary table tbody td tfoot th thead tr ul label".split()
)
VOID = frozenset("hr".split())
AGAINST = frozenset("aside button dialog footer form head header menu nav fieldset label option".split())
FOR = frozenset("article main".split())
AGAINST_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|promo|sponsor(?:ed)?|cookies?|consent|notice|alert|popup|modal|"
    r"comments?|disqus|replies|respond|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|foot|footer|head|header|"
    r"masthead|share|sharing|social|related|recommended|widget|subscribe|newsletter|signup|login|search|toolbar|"
    r"pagination|pager|legal|copyright|tags)(?:$|[\s_-])",
    re.I,
)
FOR_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|text|body)(?:$|[\s_-])", re.I)


@dataclass(frozen=True)
class Settings:
    """Weights of the block classifier and of the ties; capacities are rounded to 1 / scale."""

    bias: float = -0.4
    against: float = -6.0
    within: float = 3.0
    named: float = 1.0
    heading: float = 0.3
    link: float = -3.0
    length: float = 0.5
    sentence: float = 0.4
    next_block: float = 0.5
    near_block: float = 1.0
    scale: int = 100


@dataclass(slots=True, eq=False)
class Element:
    """An open element: its marks include those of what encloses it."""

    name: str
    parent: Element | None
    depth: int
    against: bool = False
    within: bool = False
    named: bool = False


@dataclass(slots=True)
class Block:
    text: str
    element: Element
    heading: bool
    linked: int


def _following(page: str, mark: re.Pattern[str]):
    """Where the next mark stands, the page's length if nowhere; for places asked in page order."""
    place = -1

    def following(at: int) -> int:
        nonlocal place
        if place < at:
            found = mark.search(page, at)
            place = found.start() if found else len(page)
        return place

    return following


def _tag_ends(page: str):
    """Where a tag's ``>`` outside quotes stands, -1 if it never comes; for places in page order.

    What follows an opening quote is looked up once, however many broken tags run into it.
    """
    known: dict[int, int] = {}
    first = _following(page, _MARK)

    def end(at: int) -> int:
        passed = []
        here = first(at)
        while here < len(page) and page[here] != ">":
            if here in known:
                here = known[here]
                break
            passed.append(here)
            close = page.find(page[here], here + 1)
            found = _MARK.search(page, close + 1) if close >= 0 else None
            here = found.start() if found else len(page)
        if here == len(page):
            here = -1
        for quote in passed:
            known[quote] = here
        return here

    return end


def tags(page: str):
    """(start, end, name, closing, attributes) of every tag in page order, in one pass.

    The name is None for comments, declarations and broken end tags, and "raw" for elements
    whose content is not text. A tag that does not end is text.
    """
    tag_end, next_end = _tag_ends(page), _following(page, re.compile(">"))
    start = page.find("<")
    while start >= 0:
        end, name, closing, attributes = -1, None, False, ""
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            end = close + 3 if close >= 0 else len(page)
        elif (raw := _RAW.match(page, start)) and next_end(raw.end()) < len(page):
            close = re.compile(rf"</{raw[1]}\s*>", re.I).search(page, next_end(raw.end()) + 1)
            end, name = close.end() if close else len(page), "raw"
        elif (head := _HEAD.match(page, start)) and (last := tag_end(head.end())) >= 0:
            end, name, closing, attributes = last + 1, head[2].lower(), bool(head[1]), page[head.end() : last]
        elif page[start + 1 : start + 2] in ("!", "?", "/") and next_end(start + 2) < len(page):
            end = next_end(start + 2) + 1
        if end >= 0:
            yield start, end, name, closing, attributes
        start = page.find("<", end if end >= 0 else start + 1)


def blocks(page: str | None) -> list[Block]:
    """Text blocks in page order, with what encloses them. Broken markup is read as browsers do:
    an end tag closes up to its start tag, one without start is ignored, a new paragraph or list
    item closes the one before. Time and memory grow with the page's length, however it is nested."""
    out: list[Block] = []
    if not page:
        return out
    top = Element("", None, 0)
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    in_link = False

    def is_heading(element):
        return element is not None and element.name[:1] == "h" and element.name[1:].isdigit()

    def flush():
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, top, is_heading(top) or is_heading(top.parent), min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop():
        nonlocal top
        open_names[top.name] -= 1
        top = top.parent

    at = 0
    for start, end, name, closing, attributes in tags(page):
        if start > at:
            piece = page[at:start]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        at = end
        if name is None:
            continue
        if name == "a":
            in_link = not closing and bool(_HREF.search(attributes))
        elif name in BLOCKS:
            flush()
            if closing:
                in_link = False
                if open_names[name]:
                    while top.name != name:
                        pop()
                    pop()
            elif name not in VOID:
                if top.name == "p" or top.name == name in ("li", "dd", "dt", "td", "tr", "option"):
                    pop()
                top = Element(name, top, top.depth + 1, top.against, top.within, top.named)
                open_names[name] += 1
                if name in FOR:
                    top.within = True
                elif name in AGAINST:
                    top.against = True
                if attributes:
                    marks = " ".join(m.strip("\"'") for m in _NAMES.findall(attributes))
                    if marks and name not in ("html", "body"):
                        if AGAINST_NAMES.search(marks):
                            top.against = True
                        elif FOR_NAMES.search(marks):
                            top.named = True
        elif name in ("raw", "br", "img", "input", "wbr"):
            parts.append(" ")
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def cost(block: Block, s: Settings) -> float:
    """How much better the block does as content than as boilerplate."""
    n = len(block.text)
    value = s.bias + s.length * min(4.0, (n / 50) ** 0.5) + s.link * block.linked / n
    if block.text[-1] in ".!?:;\"')":
        value += s.sentence
    if block.heading:
        value += s.heading
    if block.element.named:
        value += s.named
    if block.element.within:
        value += s.within
    if block.element.against:
        value += s.against
    return value


def ties(found: list[Block], s: Settings):
    """(i, j, weight): neighbours in the page, the weaker the further apart in the tree, and the
    last blocks right below the same element and right below a sibling of it, where others lie
    between. At most three for a block."""
    below: dict[Element, int] = {}
    beside: dict[Element, int] = {}
    for j, block in enumerate(found):
        here, around = block.element, block.element.parent
        if j:
            yield j - 1, j, s.next_block / (1 + _apart(found[j - 1].element, here))
        same, sibling = below.get(here), beside.get(around) if around else None
        if same is not None and same != j - 1:
            yield same, j, s.near_block
        if sibling is not None and sibling not in (j - 1, same):
            yield sibling, j, s.near_block / 3
        below[here] = j
        if around:
            beside[around] = j


def _apart(a: Element, b: Element) -> int:
    """Steps from one element to the other; few in all for neighbours, since tags lie between."""
    steps = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a = a.parent
        steps += 1
    return steps


def source_side(terminal: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut.

    ``terminal`` is the capacity from the source if positive, to the sink if negative; edges
    carry their capacity both ways. Flow is pushed along shortest paths, level by level.
    """
    n = len(terminal)
    source, sink = n, n + 1
    to: list[int] = []
    left: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a, b, there, back):
        out[a].append(len(to))
        to.append(b)
        left.append(there)
        out[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, c in enumerate(terminal):
        if c > 0:
            link(source, i, c, 0)
        elif c < 0:
            link(i, sink, -c, 0)
    for i, j, c in edges:
        if c > 0:
            link(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if left[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                amount = min(left[e] for e in path)
                for e in path:
                    left[e] -= amount
                    left[e ^ 1] += amount
                first = next(k for k, e in enumerate(path) if not left[e])
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if left[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif a == source:
                break
            else:
                level[a] = -1
                a = to[path.pop() ^ 1]
                turn[a] += 1


def main_blocks(page: str | None, settings: Settings = Settings()) -> tuple[list[str], int]:
    """Texts of the content blocks, and the number of all blocks."""
    found = blocks(page)
    terminal = [round(settings.scale * cost(b, settings)) for b in found]
    if all(c > 0 for c in terminal):
        return [b.text for b in found], len(found)
    edges = [(i, j, round(settings.scale * w)) for i, j, w in ties(found, settings)]
    side = source_side(terminal, edges)
    return [b.text for b, kept in zip(found, side, strict=True) if kept], len(found)


def main_text(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_kept.

    Null or empty html, and pages of boilerplate only, give an empty text. Repeated rows give
    repeated results; further columns are ignored. A block with equal costs goes to boilerplate.
    """

    def run(batches):
        def each():
            for page, url, source in rows(batches):
                kept, total = main_blocks(source, settings)
                text = "\n\n".join(kept)
                yield page, url, text, len(text), total, len(kept)

        yield from batched(_OUT, each())

    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
