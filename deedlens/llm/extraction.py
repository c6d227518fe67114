"""Main text of web pages by minimum cut.

A page is cut into blocks of text. A classifier gives each block a cost for
being content and one for being boilerplate; they are the capacities to the two
terminals. Blocks next to each other, and blocks that follow each other in one
container, are joined by edges, the stronger the more of their ancestors they
share. The minimum cut separates content from boilerplate.

The classifier is a logistic regression over text features of blocks. It learns
from the pages themselves: blocks that their markup places (within an article
or main element, or within navigation, footers and the like) are its labels,
taken from a bounded sample of ``SAMPLE`` pages. What the markup says enters the
cost of a block beside the regression.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType, StringType

from deedlens.llm.arrow import texts

#: Pages that the classifier is fitted on, at most.
SAMPLE = 2_000
SEED = 42
#: What markup adds to the log odds of content, and the edges of the graph.
MARKUP = 8.0
NEIGHBOUR = 1.0
CONTAINER = 1.0
#: Log odds are cut to this size, so that no single feature outweighs all markup.
MOST_ODDS = 6.0

# Elements whose whole content is no text of the page.
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "noembed", "noframes"}
_DROPPED = {"head", "svg", "select", "button", "canvas", "audio", "video", "datalist", "map"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
_CONTENT = {"article", "main"}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mpadded mphantom "
    "mfenced menclose mmultiscripts mprescripts mspace merror maction semantics annotation annotation-xml".split()
)
# Symbols of a formula, which stand apart.
_SYMBOL = {"mi", "mn", "mo", "ms", "mtext", "annotation", "annotation-xml"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# An open element of the first kind ends where one of the second begins.
_ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
}
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
# A class, id, role or label says boilerplate if it is one of the first words as a whole, or is joined from words of
# the first and second kind alone: cookie-notice and site-footer do, has-sidebar and category-legal do not. Names that
# begin with tag- are topics.
_BAD = (
    r"(?:ad|ads|adv|advert[^\W_]*|sponsor[^\W_]*|promo[^\W_]*|banner|nav[^\W_]*|menu[^\W_]*|breadcrumb[^\W_]*|footer|sidebar[^\W_]*|side|"
    r"widget[^\W_]*|related|recommend[^\W_]*|share|sharing|social[^\W_]*|comment[^\W_]*|disqus[^\W_]*|repl(?:y|ies)|respond|cookie[^\W_]*|consent|"
    r"gdpr|notice[^\W_]*|alert[^\W_]*|popup[^\W_]*|modal[^\W_]*|overlay|newsletter[^\W_]*|subscri[^\W_]*|signup|login|search[^\W_]*|pagination|pager|"
    r"copyright|legal|disclaimer|skip[^\W_]*|toolbar|masthead|topbar|tags?|meta)"
)
_NEUTRAL = (
    r"(?:site|page|main|global|primary|secondary|top|bottom|left|right|upper|lower|header|head|foot|body|inner|outer|mobile|"
    r"desktop|sticky|fixed|post|posts|entry|article|articles|bar|box|block|area|list|item|items|container|wrapper|wrap|"
    r"section|content|contents|row|col|column|panel|slot|unit|zone|group|holder|module|component|link|links|button|buttons|"
    r"btn|icon|icons|form|field|input|title|text|message|dialog|to|the|this|by|us|more|and|in|\d+)"
)
_BAD_NAME = re.compile(rf"(?!tags?[\s_-])(?:{_NEUTRAL}[\s_-]+)*{_BAD}(?:[\s_-]+(?:{_BAD}|{_NEUTRAL}))*|tags?", re.I)
_COMMENT = re.compile(r"comment|repl(?:y|ies)\b|disqus", re.I)
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ENDS = re.compile(r"[.!?…:;»”\"')\]]*[.!?…]")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)


@dataclass
class Block:
    """A run of text without a block border, and where it stands."""

    text: str
    linked: int
    tag: str
    #: Numbers of the open containers, outermost first.
    path: tuple[int, ...]
    #: 1 within content markup, -1 within boilerplate markup, 0 otherwise.
    place: int
    in_list: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    #: Number of the element that holds it, 0 at the top.
    above: int
    dropped: bool
    #: A name that says boilerplate, and one that says comment.
    named: bool = False
    comment: bool = False
    #: Whether it holds an article or main element.
    holds: bool = False


def _names(attributes: str) -> tuple[list[str], bool]:
    """Class tokens, id, role and label of an element, and whether it is hidden."""
    names: list[str] = []
    hidden = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "class":
            names += value.split()
        elif name in ("id", "role", "aria-label"):
            names.append(value.strip())
        elif name == "hidden":
            hidden = True
        elif name == "style":
            hidden = hidden or _NO_DISPLAY.search(value) is not None
        elif name == "aria-hidden":
            hidden = hidden or value.strip().lower() == "true"
    return names, hidden


def _places(opened: list[_Open]) -> list[int]:
    """What markup says of each element: 1 content, -1 boilerplate, 0 nothing.

    The name of an article or main element, or of one that holds such an
    element, says nothing.
    """
    places = [0]
    for o in opened:
        place = places[o.above]
        if place >= 0 and (o.tag in _BOILERPLATE or (o.named and not o.holds and o.tag not in _CONTENT)):
            place = -1
        elif place == 0 and o.tag == "header":
            place = -1
        elif place == 0 and o.tag in _CONTENT:
            place = 1
        places.append(place)
    return places


def _mark_holders(stack: list[_Open], opened: list[_Open], tag: str, comment: bool) -> None:
    """Note an article or main element that opens; articles within an article, or comments among comments, do not count."""
    if tag == "article" and any(o.tag == "article" or (comment and o.comment) for o in stack):
        return
    above = stack[-1].number if stack else 0
    while above and not opened[above - 1].holds:
        opened[above - 1].holds = True
        above = opened[above - 1].above


def blocks(page: str) -> list[Block]:
    """Blocks of a page in its order, character references decoded and white space collapsed."""
    found: list[Block] = []
    stack: list[_Open] = []
    opened: list[_Open] = []
    parts: list[str] = []
    linked, links, at = 0, 0, 0

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            inner = [o for o in stack if o.tag not in _INLINE]
            found.append(
                Block(
                    text,
                    min(linked, len(text)),
                    inner[-1].tag if inner else "",
                    tuple(o.number for o in inner),
                    # The element's number, until all are known.
                    stack[-1].number if stack else 0,
                    any(o.tag == "li" for o in inner),
                )
            )
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1].dropped):
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text)

    def close(depth: int) -> None:
        nonlocal links
        closed = stack[depth:]
        if any(o.tag not in _INLINE for o in closed):
            end_block()
        links -= sum(o.tag == "a" for o in closed)
        del stack[depth:]

    for mark in _MARK.finditer(page):
        if mark.start() < at:
            continue  # inside raw text
        add(page[at : mark.start()])
        at = mark.end()
        if mark[3] is None:
            if mark[1]:
                add(html.escape(mark[1]))
            continue
        tag, attributes = mark[3].lower(), mark[4]
        if mark[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            else:
                if tag not in _INLINE:
                    end_block()
            continue
        if tag in _RAW:
            # Nothing within is markup until the element's own end.
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = len(page) if end is None else end.start()
            if end is not None:
                close_at = page.find(">", at)
                at = len(page) if close_at < 0 else close_at + 1
            continue
        if tag == "br":
            add(" ")
            continue
        names, hidden = _names(attributes) if attributes else ([], False)
        if tag == "xmp":
            end = re.compile(r"</xmp[\s/>]", re.I).search(page, at)
            stop = len(page) if end is None else end.start()
            end_block()
            if not hidden:
                add(html.escape(page[at:stop]))
            end_block()
            at = stop
            continue
        if tag in _SYMBOL:
            add(" ")
        if tag not in _INLINE:
            for depth in range(len(stack) - 1, -1, -1):
                if (stack[depth].tag == "p" and tag in _CLOSES_P) or tag in _ENDED_BY.get(stack[depth].tag, ()):
                    close(depth)
                    break
                if stack[depth].tag not in _INLINE and stack[depth].tag != "p":
                    break
            end_block()
        if tag in _VOID or attributes.rstrip().endswith("/") and tag not in _CLOSES_P:
            continue
        above = stack[-1] if stack else _Open("", 0, 0, False)
        named = tag not in ("html", "body") and any(map(_BAD_NAME.fullmatch, names))
        comment = named and any(map(_COMMENT.search, names))
        if tag in _CONTENT:
            _mark_holders(stack, opened, tag, comment)
        dropped = above.dropped or tag in _DROPPED or hidden
        opened.append(_Open(tag, len(opened) + 1, above.number, dropped, named, comment))
        stack.append(opened[-1])
        links += tag == "a"
    add(page[at:])
    end_block()
    places = _places(opened)
    for block in found:
        block.place = places[block.place]
    return found


def features(found: list[Block]) -> np.ndarray:
    """Text features of a page's blocks: what they say on a page whose markup does not help."""
    rows = []
    for b in found:
        words = b.text.count(" ") + 1
        rows.append(
            (
                1.0,
                np.log1p(words),
                b.linked / len(b.text),
                _ENDS.search(b.text[-3:]) is not None,
                min(1.0, (b.text.count(".") + b.text.count(",")) / words),
                b.tag in ("p", "pre", "blockquote"),
                b.tag in ("h1", "h2", "h3", "h4", "h5", "h6"),
                b.in_list,
            )
        )
    return np.array(rows, float).reshape(-1, 8)


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton steps; rows stand for ``n`` equal ones.

    Both classes weigh the same.
    """
    weight = n * np.where(y > 0, 1 / n[y > 0].sum(), 1 / n[y == 0].sum()) * n.sum() / 2
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return w


def _edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges of neighbours, by how many ancestors they share, and of followers in one container."""
    edges = []
    last_in: dict[tuple[int, ...], int] = {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1].path
            shared = sum(1 for _ in _common(before, b.path))
            edges.append((i - 1, i, NEIGHBOUR * shared / max(len(before), len(b.path), 1)))
        parent = b.path[:-1]
        if parent in last_in and last_in[parent] != i - 1:
            edges.append((last_in[parent], i, CONTAINER))
        last_in[parent] = i
    return [e for e in edges if e[2] > 0]


def _common(a: tuple, b: tuple):
    for x, y in zip(a, b, strict=False):
        if x != y:
            return
        yield x


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels with the smallest cut: odds above 0 speak for True, an edge costs its weight where labels differ.

    A node whose own odds outweigh all its edges keeps its side in some minimum
    cut; such nodes are settled first, and their edges become odds of their
    neighbours. What is left goes through augmenting paths. Ties go to False.
    """
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if label[i] is None and (abs(odds[i]) > sum(near[i].values()) or not near[i]):
            label[i] = odds[i] > 0
            for j, w in near[i].items():
                odds[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        source, sink = n, n + 1
        capacity: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
        capacity[source], capacity[sink] = {}, {}
        for i in rest:
            if odds[i] > 0:
                capacity[source][i], capacity[i][source] = odds[i], 0.0
            elif odds[i] < 0:
                capacity[i][sink], capacity[sink][i] = -odds[i], 0.0
        reached = _max_flow(capacity, source, sink)
        for i in rest:
            label[i] = i in reached
    return [bool(x) for x in label]


def _max_flow(capacity: dict[int, dict[int, float]], source: int, sink: int) -> set[int]:
    """Push flow along shortest augmenting paths; the nodes that the source still reaches at the end."""
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            u = queue.popleft()
            for v, c in capacity[u].items():
                if c > 1e-9 and v not in came:
                    came[v] = u
                    queue.append(v)
        if sink not in came:
            return set(came)
        path, v = [], sink
        while v != source:
            path.append((came[v], v))
            v = came[v]
        flow = min(capacity[u][v] for u, v in path)
        for u, v in path:
            capacity[u][v] -= flow
            capacity[v][u] += flow


def main_text(page: str, weights: np.ndarray) -> str:
    """Content blocks of a page, joined by one space."""
    found = blocks(page)
    if not found:
        return ""
    odds = np.clip(features(found) @ weights, -MOST_ODDS, MOST_ODDS) + MARKUP * np.array([b.place for b in found])
    keep = minimum_cut(odds.tolist(), _edges(found))
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


#: Weights where no page is marked up: long blocks with sentences are content, links and lists are not.
UNTRAINED = np.array([-2.0, 1.0, -4.0, 1.0, 1.0, 1.0, 1.0, -1.0])


def fit(pages: DataFrame, page_id: str = "page_id", page: str = "html") -> np.ndarray:
    """Weights of the classifier from a sample of pages; ``UNTRAINED`` where markup places no block on either side.

    Takes the ``SAMPLE`` pages with the smallest hashes of id and content. Only
    features of blocks reach the driver, as sums over equal rows.
    """

    @arrow_udf(ArrayType(ArrayType(DoubleType())))
    def rows(column: pa.Array) -> pa.Array:
        found = []
        for value in texts(column):
            placed = [b for b in blocks(value) if b.place]
            x = features(placed).round(2).tolist()
            found.append([[*r, float(b.place > 0)] for r, b in zip(x, placed, strict=True)])
        return pa.array(found, pa.list_(pa.list_(pa.float64())))

    body = F.col(f"`{page}`")
    ranked = pages.select(body.alias("page"), F.xxhash64(F.lit(SEED), F.col(f"`{page_id}`"), body).alias("h"))
    border = ranked.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h").alias("most")).first()["most"]
    sample = ranked.where(F.col("h") <= F.lit(border)).select(F.explode(rows("page")).alias("r"))
    table = np.array([[*r["r"], r["n"]] for r in sample.groupBy("r").agg(F.count("*").alias("n")).collect()], float)
    if not len(table) or len(set(table[:, -2])) < 2:
        return UNTRAINED
    return fit_logistic(table[:, :-2], table[:, -2], table[:, -1])


def extract(page: Column, weights: np.ndarray) -> Column:
    """The main text of each whole page; NULL, empty and text-free pages give an empty string."""

    @arrow_udf(StringType())
    def extracted(column: pa.Array) -> pa.Array:
        return pa.array([main_text(value, weights) for value in texts(column)], pa.string())

    return extracted(page)
