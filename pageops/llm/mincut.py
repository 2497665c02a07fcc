"""Main-text extraction by minimum cut.

A page's tags cut it into text blocks.  Each block's features (its containers'
names, classes and roles, links, length, punctuation) give a classifier cost
for either label; these become its edges to the terminals.  Blocks that follow
each other, and blocks whose containers are close in the DOM, share smoothness
edges, weaker the more container borders lie between them.  The minimum cut, by
blocking flows, separates content from boilerplate.  A class, id or form that
says boilerplate counts for nothing around the page's article or most of its text.

Spark deals the pages out, and a page is one row.  Null or empty html has no
text.  A page without tags is one block.  Blocks' references are decoded, white
space becomes one space, and kept blocks are joined by one space in page order.
Repeated rows give the same text each time.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only

# Element names of HTML by how they lay out or end.
RAW = frozenset("script style noscript template textarea select svg math iframe object canvas audio video head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var img wbr ruby rt rp nobr".split())
CLOSES = {  # an open tag that ends an open element of these names, up to the nearest of BOUNDARY
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                   "menu nav ol p pre section table ul".split())
BOUNDARY = frozenset("ul ol menu dl table article section div body html td th aside main nav footer header".split())

# Costs, in units of 1/8 nat: what a container says about the text in it.
AWAY = {"nav": 64, "footer": 64, "aside": 56, "header": 40, "menu": 56, "button": 56, "dialog": 56, "fieldset": 48, "address": 24,
        "figcaption": 8, "label": 8}
TOWARDS = {"article": 32, "main": 24}
_BAD = re.compile(
    r"(?:^|[\s_\-])(?:ads?|adverts?|advert\w*|banners?|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
    r"side-?bar|widget|nav|navbar|navigation|menu|breadcrumbs?|share|sharing|social|related|recommend\w*|trending|comments?|disqus|repl(?:y|ies)|"
    r"respond|footer|foot|masthead|site-?header|topbar|copyright|legal|newsletter|subscri\w*|signup|login|search|paywall|pager|pagination|tags?|"
    r"toolbar|skip|meta)(?=$|[\s_\-])", re.I)
#: Parts of a class name that tell of a state or a topic, not of what the container is.
_STATE = re.compile(
    r"(?:^|[_\-])(?:has|no|not|non|is|with|without|show|hide)[_\-].*|"
    r"^(?:tag|category)[_\-](?!(?:cloud|lists?|links?|nav|navigation|menu|widget)$).*|"
    r"^.*[_\-](?:enabled|disabled|allowed|opened|open|closed|active|visible|hidden|on|off|loaded|ready)$", re.I | re.S)
FORM, NAMED = 56, 48     # costs that the page's text can undo: of a form, of a class or id
FEW = 200                # characters of text that are no page's content
_GOOD = re.compile(r"(?:^|[\s_\-])(?:article|content|main|entry|post|story|body|text)(?=$|[\s_\-])", re.I)
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form menu dialog alert alertdialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^<>]*>|[^<]+|<", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


class Box:
    """A container: its parent, depth and what it says, its parents' included.

    ``hard`` is the cost that its and its parents' elements and roles set,
    ``soft`` the one that its own class, id or form sets; ``_settle`` makes
    ``away`` of both.  ``size`` counts its text without links, its parts'
    included, ``own`` that without a further soft container in between;
    ``titles`` and ``articles`` count the h1 and the articles and mains in it."""

    __slots__ = ("name", "parent", "depth", "away", "towards", "hard", "soft", "bare", "says", "size", "own", "titles", "articles")

    def __init__(self, name: str, parent: Box | None, hard: int, soft: int, bare: bool, says: int) -> None:
        self.name, self.parent, self.bare, self.says = name, parent, bare, says
        self.depth = parent.depth + 1 if parent else 0
        self.hard, self.soft = max(hard, parent.hard if parent else 0), soft
        self.away = self.towards = self.size = self.own = self.articles = 0
        self.titles = int(name == "h1")


def _bad(value: str) -> bool:
    return any(_BAD.search(_STATE.sub("", v)) for v in value.split())


def _open(name: str, tag: str, parent: Box) -> Box:
    hard, soft, towards, named = AWAY.get(name, 0), FORM if name == "form" else 0, TOWARDS.get(name, 0), 0
    if "=" in tag or "hidden" in tag:
        for key, a, b, c in _ATTR.findall(tag):
            key, value = key.lower(), a or b or c
            if key in ("hidden", "aria-hidden"):
                hard = max(hard, 64 if key == "hidden" or value == "true" else 0)
            elif key == "role":
                hard = max(hard, 56 if value.lower() in _BAD_ROLE else 0)
                towards = max(towards, 24 if value.lower() in ("main", "article") else 0)
            elif name not in ("body", "html"):
                named = max(named, NAMED if _bad(value) else 0)
                towards = max(towards, 12 if _GOOD.search(value) else 0)
    if name in ("article", "main", "body", "html"):
        return Box(name, parent, 0, 0, not named and not hard, towards)
    # What stands inside a container outweighs what the container stands in.
    return Box(name, parent, hard, max(soft, named), not hard, 0 if hard else towards)


def _settle(boxes: list[Box], found: list[tuple[str, int, Box]]) -> None:
    """Sets each box's ``away`` and ``towards``.

    A soft cost is void where the container has most of the page's text, no
    article or main stands outside, and it has an h1 or all but ``FEW`` characters
    outside are boilerplate: it is the page's frame then.  In an article or main whose own
    class isn't boilerplate's, and with half the text of the longest one or
    more, the soft costs of the containers around it don't count."""
    nearest: dict[int, Box] = {}
    for box in boxes:
        nearest[id(box)] = box if box.soft or not box.parent else nearest[id(box.parent)]
    for text, links, box in found:
        if not box.hard:
            box.size += len(text) - links
            nearest[id(box)].own += len(text) - links
    for box in reversed(boxes):
        if box.parent and not box.hard:
            box.articles += box.name in ("article", "main") and box.bare and box.size > 0
            box.parent.size += box.size
            box.parent.titles += box.titles
            box.parent.articles += box.articles
    root = boxes[0]
    clear = root.own
    for box in boxes:       # containers with most of the text stand in each other
        if box.soft and box.size * 2 > root.size:
            if box.articles < root.articles or (clear >= FEW and not box.titles):
                break
            box.soft = 0
            clear += box.own
    longest = max((b.size for b in boxes if b.name in ("article", "main") and b.bare), default=0)
    soft: dict[int, int] = {}
    for box in boxes:
        around = soft[id(box.parent)] if box.parent else 0
        if box.name in ("article", "main") and box.bare and box.size and box.size * 2 >= longest:
            around = 0
        soft[id(box)] = max(around, box.soft)
        box.away = max(box.hard, soft[id(box)])
        up = box.parent.towards if box.parent else 0
        box.towards = up + box.says if not box.soft and (box.bare or box.name in ("article", "main", "body", "html")) else 0


def blocks(html: str) -> list[tuple[str, int, Box]]:
    """(text, link characters, container) of each text block in page order."""
    out: list[tuple[str, int, Box]] = []
    stack = [Box("", None, 0, 0, True, 0)]
    boxes = stack[:]
    text: list[str] = []
    links = in_link = 0
    raw_until = 0                                   # where a skipped element ends

    def flush() -> None:
        nonlocal links
        if text:
            got = " ".join(unescape("".join(text)).split())
            if got:
                out.append((got, min(links, len(got)), stack[-1]))
            text.clear()
        links = 0

    for m in _TOKEN.finditer(html):
        tok = m[0]
        if m.start() < raw_until:
            continue
        if tok[0] != "<" or tok == "<":
            text.append(tok)
            if in_link:
                links += len(tok)
            continue
        named = _NAME.match(tok)
        if not named:
            continue
        closing, name = named[1], named[2].lower()
        if name in RAW:
            if closing or tok.endswith("/>"):
                continue
            if name != "head":
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, m.end())
                raw_until = end.end() if end else len(html)
                if name not in ("svg", "math"):
                    flush()
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        in_link = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name in ENDS_P and stack[-1].name == "p":
            stack.pop()
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in CLOSES.get(name, ()):
                del stack[k:]
                break
            if stack[k].name in BOUNDARY:
                break
        if name not in VOID:
            stack.append(_open(name, tok, stack[-1]))
            boxes.append(stack[-1])
    flush()
    _settle(boxes, out)
    return out


def costs(text: str, links: int, box: Box) -> tuple[int, int]:
    """(cost of calling the block boilerplate, cost of calling it content)."""
    content = 6 + box.towards + min(len(text) // 16, 24)
    if text[-1] in ".!?:…\"»”":
        content += 6
    if box.name in ("h1", "h2", "h3", "p", "blockquote", "pre"):
        content += 6
    boiler = box.away * 2
    boiler += 40 * links // len(text)
    if len(text) < 25 and box.name in ("li", "td", "div", ""):
        boiler += 6
    if box.away:
        content = min(content, 24)
    return content, boiler


def _apart(a: Box, b: Box) -> int:
    """Container borders between two blocks."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def edges(boxes: list[Box]) -> list[tuple[int, int, int]]:
    """Smoothness edges: blocks next to each other, and each block with the
    last one before it under the same parent."""
    out = []
    last: dict[int, int] = {}
    for i, box in enumerate(boxes):
        up = id(box.parent or box)
        if i:
            same = boxes[i - 1].away == box.away and boxes[i - 1].towards == box.towards
            out.append((i - 1, i, max(1, 8 - 2 * _apart(boxes[i - 1], box)) if same else 1))
        if last.get(up, i - 1) != i - 1:
            out.append((last[up], i, 4 if boxes[last[up]].away == box.away else 1))
        last[up] = i
    return out


def min_cut(source: list[int], sink: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each node stays with the source in a minimum cut (ties go to the
    source), by blocking flows along shortest paths."""
    n = len(source)
    excess = [a - b for a, b in zip(source, sink)]       # after the flow source-node-sink
    to: list[int] = []
    room: list[int] = []                                 # an edge's reverse has its number with the last bit turned
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in links:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += (b, a)
        room += (w, w)
    while True:
        # Distances from the nodes with a surplus, then as much flow as fits
        # along edges that lead one step on; an edge that leads nowhere is
        # passed over for the rest of the round.
        starts = [i for i in range(n) if excess[i] > 0]
        level = [-1] * n
        for i in starts:
            level[i] = 0
        queue, reached = deque(starts), False
        while queue:
            a = queue.popleft()
            reached = reached or excess[a] < 0
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if not reached:
            break
        tried = [0] * n
        for start in starts:
            path: list[int] = []
            a = start
            while excess[start] > 0:
                if excess[a] < 0:
                    flow = min(excess[start], -excess[a], *(room[e] for e in path))
                    excess[start] -= flow
                    excess[a] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    # Back to where the path still has room.
                    full = next((k for k, e in enumerate(path) if not room[e]), len(path))
                    if full < len(path):
                        a = to[path[full] ^ 1]
                        del path[full:]
                    continue
                edges_of, k = out[a], tried[a]
                while k < len(edges_of) and not (room[edges_of[k]] and level[to[edges_of[k]]] == level[a] + 1):
                    k += 1
                tried[a] = k
                if k < len(edges_of):
                    path.append(edges_of[k])
                    a = to[edges_of[k]]
                elif path:
                    a = to[path.pop() ^ 1]
                    tried[a] += 1
                else:
                    break
    # The sink's side: what can still reach a node with open room to the sink.
    lost = deque(i for i in range(n) if excess[i] < 0)
    away = set(lost)
    while lost:
        b = lost.popleft()
        for e in out[b]:
            if room[e ^ 1] and to[e] not in away:
                away.add(to[e])
                lost.append(to[e])
    return [i not in away for i in range(n)]


def main_text(html: str) -> str:
    found = blocks(html)
    if not found:
        return ""
    both = [costs(*b) for b in found]
    stay = min_cut([a for a, _ in both], [b for _, b in both], edges([b for _, _, b in found]))
    return " ".join(t for (t, _, _), keep in zip(found, stay) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    frame = only(pages, "page_id", "url", "html")
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema[:2])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                got = [main_text(h) if h else "" for h in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array(map(len, got), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return frame.mapInArrow(run, f"{head}, text string, n_chars long")
