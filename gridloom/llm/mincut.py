"""Main text of web pages by a minimum cut.

The page is read into blocks: runs of text between block-level tags, each with the
tags it lies in. Text that is hidden, by its own element or one around it, is no text. A classifier gives every block a cost of being called content and a
cost of being called boilerplate, from where it lies, how much of it is link text, how
long it is and how it is punctuated. The costs are the capacities of the block's edges
to the two terminals. Smoothness edges join neighbours in the page and siblings in the
tree, heavier the more ancestors they share. The minimum cut, found by maximum flow, is
the labelling of the least total cost. No block is tied to a side: an element that is seldom content (navigation, footers,
forms and so on) and a class, id or role that names a part outside the article are costs, and so
is lying in what the page marks as its article. A block on its own may be doubtful, such as a short
heading, a list of links in an article, or a caption; its neighbours decide. A form around most of the page's text is no form here.

Edge cases: null, empty and text-free pages give an empty text; open tags are closed
where HTML says so, or at the end; unknown character references stay as they are; equal pages have equal texts; pages of any
length and depth take time in proportion; columns of other names stay, whatever they are called.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

# Elements of HTML by their role here.
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp svg math canvas object audio video select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose text is seldom the article's; forms are looked at by what they hold.
OUTSIDE = frozenset("nav footer header aside button menu head dialog search fieldset legend label".split())
CLOSES_P = BLOCK - frozenset("button option optgroup html head body".split())
#: An opening tag ends these open elements, up to the named bounds.
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words in class, id or role that name parts outside the article.
_AWAY = re.compile(
    r"(?:^|(?<!\bhas)(?<!\bwith)(?<!\bno)(?<!\bwithout)[\s_-])(?:ad|ads|advert|adverts|advertisement|adsense|banner|sponsor|sponsored|promo|promotion|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|footer|header|masthead|sidebar|aside|widget|related|recommended|share|sharing|social|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|subscribe|newsletter|signup|login|comment|comments|respond|reply|disqus|pagination|pager|tags|toolbar|search|hidden|skip|copyright|legal|complementary|contentinfo|dialog|alert)(?:$|[\s_-]|\d)"
)
_HERE = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|text|body)(?:$|[\s_-])")
_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$))|[^>])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=>/]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]+)))?")
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SPACE = re.compile(r"\s+")
_END = re.compile(r"[.!?…。！？:;][\"'”’)\]]*$")


#: Log odds of an element that is seldom content, of the marked article and of a copyright line; weights of edges to the
#: next block, which fall with the elements that the two don't share, and to the sibling before; a factor where kinds of elements differ.
AWAY, MARKED, RIGHTS, NEXT, SIBLING, APART = 7.0, 2.0, 4.4, 5.0, 0.4, 0.25


@dataclass
class Node:
    tag: str
    gone: bool  # it or an ancestor is hidden
    away: bool  # it or an ancestor is seldom content
    form: int  # number of the outermost form around it, 0 if none
    doubt: int  # number of the nearest element with a name of a part outside the article, 0 if none
    inside: bool  # it or an ancestor is marked as the article
    here: bool  # within the element of doubt, one is marked as the article
    number: int
    up: int  # number of the element above
    depth: int  # elements above, and itself
    home: Node | None  # the innermost block element that it is or lies in

    @property
    def kind(self) -> tuple[bool, int, int]:
        return self.away, self.form, self.doubt


@dataclass
class Piece:
    text: str
    node: Node
    linked: int  # characters within links
    shared: int  # elements above both this block's element, itself included, and that of the block before


def attributes_of(text: str) -> dict[str, str]:
    """Name -> value of a tag's attributes; the first of equal names counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), next((v for v in values if v), ""))
    return out


def gone(has: dict[str, str]) -> bool:
    """Whether the attributes hide their element."""
    return "hidden" in has or has.get("aria-hidden", "").strip().lower() == "true" or bool(_NONE.search(has.get("style", "")))


def named(has: dict[str, str]) -> tuple[bool, bool]:
    """Whether a name in the attributes is of a part outside the article, and one of the article itself."""
    names = [n for a in ("class", "id", "role") for n in has.get(a, "").lower().split()]
    outside = [bool(_AWAY.search(n)) for n in names]
    return any(outside), any(not o and _HERE.search(n) for n, o in zip(names, outside, strict=True))


class Open:
    """The open elements of a page, and where the last one of each tag, and of all block elements, stands."""

    def __init__(self) -> None:
        root = Node("", False, False, 0, 0, False, False, 0, -1, 1, None)
        root.home = root
        self.stack = [root]
        self.at: dict[str, list[int]] = {}
        self.block: list[int] = []

    def last(self, *tags: str) -> int:
        """The place of the innermost of such elements, 0 if none is open."""
        return max((places[-1] for t in tags if (places := self.at.get(t))), default=0)

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.block.append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> int:
        """Close the elements from a place on; how many links they were."""
        links = 0
        while len(self.stack) > place:
            node = self.stack.pop()
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.block.pop()
            links += node.tag == "a"
        return links


def _ended_by(tag: str, now: Open) -> int:
    """The place of the open element that an opening tag ends, 0 if it ends none."""
    if tag in CLOSES_P:
        p = now.last("p")
        if p and p > now.last("button", "table", "td", "th"):
            return p
    if tag in SIBLINGS:
        alike = next(({*pair} for pair in (("dt", "dd"), ("td", "th")) if tag in pair), {tag})
        place = now.last(*alike)
        if place > now.last(*SIBLINGS[tag]):
            return place
    return 0


def _below(above: Node, tag: str, attributes: str, number: int) -> Node:
    """The element that a tag opens."""
    has = attributes_of(attributes) if attributes else {}
    away = above.away or tag in OUTSIDE and not (tag == "header" and above.inside)
    doubt, here = above.doubt, above.here
    out_of, part_of = named(has)
    part_of = part_of or tag in ("article", "main") and not out_of
    if out_of and not part_of and tag not in ("html", "body", "article", "main"):
        doubt, here = number, False
    elif tag in ("article", "main") and part_of:
        doubt, here = 0, False
    elif part_of and doubt:
        here = True
    inside = above.inside or part_of or tag in ("article", "main")
    node = Node(tag, above.gone or gone(has), away, above.form or number * (tag == "form"), doubt, inside, here, number, above.number, above.depth + 1, above.home)
    if tag in BLOCK:
        node.home = node
    return node


def blocks(page: str) -> list[Piece]:
    """The page's text blocks in order."""
    now, made = Open(), 1
    words: list[str] = []
    out: list[Piece] = []
    linked, home, links = 0, now.stack[0], 0
    low = 1  # the least depth since the last block

    def flush() -> None:
        nonlocal linked, low
        if words:
            text = _SPACE.sub(" ", "".join(words)).strip()
            if text:
                before = out[-1].node.depth if out else 0
                out.append(Piece(text, home, min(linked, len(text)), min(low, before, home.depth)))
                low = len(now.stack)
            words.clear()
            linked = 0

    def add(raw: str) -> None:
        nonlocal linked, home
        if not raw or now.stack[-1].gone:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not any(w != " " for w in words):
            home = now.stack[-1].home
        words.append(text)
        if links:
            linked += len(text.strip())

    def close(place: int) -> None:
        nonlocal links, low
        low = min(low, place)
        links -= now.close(place)

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            place = now.last(tag)
            # an inline end tag does not reach out of its block
            if place and (tag in BLOCK or not now.block or now.block[-1] <= place):
                close(place)
            continue
        if tag == "br":
            words.append(" ")
        elif tag in BLOCK:
            flush()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            continue
        for _ in range(2):  # a paragraph, then a sibling
            place = _ended_by(tag, now)
            if place:
                close(place)
        now.push(_below(now.stack[-1], tag, m[3], made))
        made += 1
        links += tag == "a"
    flush()
    return out


def costs(piece: Piece, marked: bool, held: int, away: bool) -> tuple[float, float]:
    """What calling the block boilerplate costs, and calling it content.

    marked: the page marks an article; held: unlinked characters of the blocks that
    share the block's element of doubt; away: it lies in an element that is seldom content.
    """
    n, node = len(piece.text), piece.node
    score = 0.3 - AWAY * away  # log odds of content
    own = node.inside and not node.doubt
    score += MARKED if own else -1.2 if marked else 0.0
    if node.doubt:
        score -= 7.0 - min(held, 2000) / 400 - min(n, 300) / 300 - 1.5 * node.here
    score += 2.5 if re.fullmatch("h[1-6]", node.tag) else 1.5 if node.tag in ("p", "pre", "blockquote") else -0.5 if node.tag in ("li", "td", "div", "") else 0.0
    score += min(n, 200) / 100 - 0.6
    score += 0.8 if _END.search(piece.text) else -0.2
    score -= (1.5 if own else 3.5) * piece.linked / n
    if "©" in piece.text or "all rights reserved" in piece.text.lower():
        score -= RIGHTS
    return max(score, 0.0), max(-score, 0.0)


def _flow(capacity: list[dict[int, float]], source: int, sink: int) -> set[int]:
    """Nodes on the source's side of a minimum cut; capacity holds what is left and changes.

    Levels by breadth-first search, then blocking flow along them, until the sink is cut off.
    """
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for v, c in capacity[u].items():
                if c > 1e-9 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return set(level)
        rest = {u: list(capacity[u]) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                least = min(capacity[a][b] for a, b in zip(path, path[1:], strict=False))
                back = 0
                for i, (a, b) in enumerate(zip(path, path[1:], strict=False)):
                    capacity[a][b] -= least
                    capacity[b][a] = capacity[b].get(a, 0.0) + least
                    if capacity[a][b] <= 1e-9 and not back:
                        back = i + 1
                del path[back:]
                continue
            arcs = rest[u]
            while arcs and not (capacity[u].get(arcs[-1], 0) > 1e-9 and level.get(arcs[-1]) == level[u] + 1):
                arcs.pop()
            if arcs:
                path.append(arcs[-1])
            else:
                path.pop()
                if path:
                    rest[path[-1]].pop()


def page_form(pieces: list[Piece]) -> int:
    """The number of the form that holds over half of the page's unlinked text, 0 if none does."""
    held: Counter[int] = Counter()
    for p in pieces:
        if not p.node.away or p.node.form:
            held[p.node.form] += len(p.text) - p.linked
    whole = sum(held.values())
    return next((f for f, n in held.items() if f and 2 * n > whole), 0)


def content(pieces: list[Piece], smooth: float = 1.0) -> list[bool]:
    """Which blocks are content: the minimum cut. smooth: a factor of all smoothness edges."""
    n = len(pieces)
    source, sink = n, n + 1
    capacity: list[dict[int, float]] = [{} for _ in range(n + 2)]
    last: dict[int, int] = {}
    around = page_form(pieces)
    marked = any(p.node.inside and not p.node.doubt for p in pieces)
    held: Counter[int] = Counter()
    for p in pieces:
        held[p.node.doubt] += len(p.text) - p.linked

    def join(a: int, b: int, c: float) -> None:
        capacity[a][b] = capacity[a].get(b, 0.0) + c
        capacity[b][a] = capacity[b].get(a, 0.0) + c

    for i, p in enumerate(pieces):
        away = p.node.away or p.node.form not in (0, around)
        lost, wrong = costs(p, marked, held[p.node.doubt], away)
        if lost:
            capacity[source][i] = lost
        if wrong:
            capacity[i][sink] = wrong
        if i:
            join(i - 1, i, smooth * NEXT * (p.shared / max(pieces[i - 1].node.depth, p.node.depth)) ** 3 * (1.0 if p.node.kind == pieces[i - 1].node.kind else APART))
        up = max(p.node.up, 0)
        if up in last and last[up] != i - 1:
            join(last[up], i, smooth * SIBLING)
        last[up] = i
    side = _flow(capacity, source, sink)
    return [i in side for i in range(n)]


def main_text(page: str | None) -> str:
    pieces = blocks(page or "")
    return "\n".join(p.text for p, keep in zip(pieces, content(pieces), strict=True) if keep)


def extract(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """df with the column out, the main text of the column page; a column of that name is replaced."""
    names = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(page).to_pylist()
            for a, b in slices(pages):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array([main_text(p) for p in pages[a:b]], pa.string())], [*names, out])

    return df.mapInArrow(run, T.StructType([*(df.schema[n] for n in names), T.StructField(out, T.StringType())]))
