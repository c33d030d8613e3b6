"""Main text of web pages by minimum-cut labelling (operator 10).

A page is read into text blocks (runs of text between block-level tags) with
their place in the element tree.  A logistic classifier over what a block's text
looks like (words, sentence end, links, heading, rights) gives log odds of
content; what the elements, classes and roles around it say is added.  These are
the capacities from the source or to the sink of a graph whose other edges join
neighbouring blocks and blocks of the same parent.  An edge is the log odds that
two such blocks have one label, by how much of the tree they share, and so
comparable with the blocks' own.  The minimum cut, found by maximum flow, labels
all blocks at once: a short line among paragraphs is content, a sentence among
links isn't.  Blocks whose own capacity exceeds all their edges are settled
first, which doesn't change the cut.

Classifier and edges are fitted on weak labels from the markup (inside an article
without a mark: content; marked, framed or outside of the page's article: not) of
a bounded sample, ``FIT_PAGES`` pages in the mean, those with the least hashes;
they are drawn to hand-set starting weights, which alone hold without a sample.

Defined results: a null or empty html gives the empty text; markup that is cut
off or never closed ends with the page; repeated rows each come back; where both
sides of a cut cost the same, a block is not content; very long pages are read in
full, in time about proportional to their length; extra columns pass through
(one named ``text`` is replaced); an empty table gives an empty table.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

#: Elements of HTML by role.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style template noscript svg math canvas object select option datalist button textarea title iframe audio video map xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: A start tag of the first closes an open element of the second, up to the barrier.
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary", "li", "dd", "dt"}
SELF_CLOSING = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

#: Words of class, id and role that speak against content, and for it.
BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert newsletter subscribe subscription popup modal "
    "overlay nav navbar navigation menu menus breadcrumb breadcrumbs masthead sidebar aside widget widgets related recommended recommendations share sharing social comment comments reply replies respond "
    "disqus discussion feedback login signup signin register search toolbar pagination pager skip contentinfo complementary dialog form".split()
)
FRAME = frozenset("header footer head foot top bottom".split())
GOOD = frozenset("article content main post entry story maincontent articlebody".split())
BAD_TAGS = frozenset("nav footer aside form dialog menu".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE = re.compile(r"=\s*([\"'])")
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
_SENTENCE = re.compile(r"[.!?…]['\"”»)]*$")
_RIGHTS = re.compile(r"©|\(c\)\s|copyright|all rights reserved", re.I)


@dataclass(slots=True)
class Node:
    """An open element: what holds for all text inside it."""

    name: str
    parent: Node | None
    depth: int
    skipped: bool
    article: bool
    bad: bool
    frame: bool
    heading: bool
    #: The element itself or the nearest around it that has a mark against it; ``hidden`` can't be taken back.
    mark: Node | None
    hidden: bool


@dataclass(slots=True)
class Block:
    text: str
    node: Node
    linked: int


def _tag_end(html: str, at: int, lost: set[str]) -> int:
    """Place of the ``>`` that ends a tag; -1 if none does.  ``lost``: quote marks that don't come again."""
    while True:
        end = html.find(">", at)
        if end < 0:
            return -1
        q = _QUOTE.search(html, at, end)
        if not q or q[1] in lost:
            return end
        close = html.find(q[1], q.end())
        if close < 0:
            lost.add(q[1])
            return end
        at = close + 1


def _child(parent: Node | None, name: str, attrs: str) -> Node:
    p = parent
    inside = p is not None and p.article
    bad, frame = p is not None and p.bad, p is not None and p.frame
    good, hidden, marked = name in ("article", "main"), p is not None and p.hidden, name in BAD_TAGS
    if attrs:
        tokens: set[str] = set()
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
            elif key in ("class", "id", "role"):
                tokens.update(w.lower() for w in _WORDS.findall(value))
        own = tokens & GOOD
        marked = marked or bool(tokens & BAD) and name not in ("body", "html")
        frame = frame or bool(tokens & FRAME) and not own and not inside
        good = good or bool(own) and not tokens & BAD and not tokens & FRAME
    bad = bad or marked or hidden
    frame = frame or name == "header" and not inside
    node = Node(name, p, p.depth + 1 if p else 0, (p is not None and p.skipped) or name in SKIPPED, inside or good, bad, frame, name in ("h1", "h2", "h3", "h4", "h5", "h6") or (p is not None and p.heading and name not in BLOCK), p.mark if p else None, hidden)
    if marked:
        node.mark = node
    return node


def blocks(html: str) -> list[Block]:
    """Text blocks in page order."""
    root = Node("#root", None, 0, False, False, False, False, False, None, False)
    stack, count, out = [root], {}, []
    parts: list[str] = []
    owner, links, linked = root, 0, 0
    lost: set[str] = set()
    at, n = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((_html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, owner, linked))
            parts.clear()
        linked = 0

    def block_of(node: Node) -> Node:
        while node.parent is not None and node.name not in BLOCK:
            node = node.parent
        return node

    def pop_to(names, barrier=()) -> None:
        """Closes open elements down to the nearest of these names, unless a barrier comes first."""
        nonlocal links
        if not any(count.get(x) for x in names):
            return
        k = len(stack) - 1
        while k > 0 and stack[k].name not in names:
            if stack[k].name in barrier:
                return
            k -= 1
        if k > 0:
            for x in stack[k:]:
                count[x.name] -= 1
                links -= x.name == "a"
            del stack[k:]

    def text(s: str) -> None:
        nonlocal owner, linked
        top = stack[-1]
        if top.skipped or not s:
            return
        if not parts:
            if s.isspace():
                return
            owner = block_of(top)
        parts.append(s)
        if links:
            linked += len(s.strip())

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        if lt > at:
            text(html[at:lt])
        nxt = html[lt + 1 : lt + 2]
        if nxt == "!" or nxt == "?":
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            if closing:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                text("<")
                at = lt + 1
            continue
        end = _tag_end(html, m.end(), lost)
        name, attrs = m[0].lower(), html[m.end() : end if end >= 0 else n]
        at = n if end < 0 else end + 1
        if end < 0:
            break
        if closing:
            if name == "br":
                text(" ")
                continue
            if name in BLOCK:
                flush()
            if name in count and name not in ("html", "body"):
                pop_to((name,), ("td", "th", "table") if name not in BLOCK else ())
            continue
        if name == "br":
            text(" ")
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES_P:
                pop_to(("p",), ("td", "th", "table", "li", "div", "article", "section"))
            if name in SELF_CLOSING:
                pop_to(ALIKE.get(name, (name,)), SELF_CLOSING[name])
            if name == "body":
                pop_to(("head",))
        if name in VOID:
            continue
        node = _child(stack[-1], name, attrs)
        if name in RAW:
            close = _RAW_END[name].search(html, at)
            at = n if close is None else close.start()
            if close is not None:
                end = html.find(">", at)
                at = n if end < 0 else end + 1
            continue
        if attrs.rstrip().endswith("/") and name in ("path", "g", "use", "circle", "rect"):
            continue
        stack.append(node)
        count[name] = count.get(name, 0) + 1
        links += name == "a"
    flush()
    return out


#: What the markup around a block adds: inside an article, outside of the page's article, marked, framed.
ARTICLE, OUTSIDE, AGAINST, FRAMED = 4.0, -4.0, -10.0, -6.0
#: Least words of each class of length.
WORD_CLASSES = (1, 3, 6, 12, 24, 48)
#: Starting weights: constant, classes of length, sentence end, some and mostly links, heading, a note of rights.
START = (-1.2, 0.1, 0.3, 0.7, 1.5, 2.4, 2.7, 0.8, -1.0, -4.0, 0.8, -3.0)
#: Starting edges: the same parent, much of the tree in common, little.
START_EDGES = (1.2, 0.8, 0.3)
#: Share of the places' depth from which much is in common; part of an edge's weight between blocks of different marks, and between those of one parent that aren't neighbours; the most an edge weighs.
MUCH, UNLIKE, APART, MOST_EDGE = 0.6, 0.1, 0.5, 2.0
#: Pages of the sample that is fitted, in the mean; blocks that its evidence counts as beside the starting weights.
FIT_PAGES, EVIDENCE = 4096, 400.0


@dataclass(frozen=True)
class Weights:
    """Log odds: of the text classifier's columns, and of the edges by relation."""

    text: tuple[float, ...] = START
    edges: tuple[float, ...] = START_EDGES


#: A marked element is a wrapper of the content if it holds over this share of the words in sentences, and the text without a mark less than that share of its own.
MOST, REST = 0.5, 0.25


def settle_marks(found: list[Block]) -> None:
    """Takes back marks of elements that wrap the content; what they hold is judged by its own features and other marks.

    These are elements of a marked class, or forms, around the page's only
    ``main`` or, without one, its only ``article`` that has no mark itself; and
    marked elements that hold most of the page's sentences where little text has
    no mark.  Outer elements come first.
    """
    if not any(b.node.mark for b in found):
        return
    words: dict[int, int] = {}
    nodes: dict[int, Node] = {}
    marks: dict[int, Node] = {}
    for b in found:
        x = b.node
        while x is not None and id(x) not in nodes:
            nodes[id(x)] = x
            if x.mark is x:
                marks[id(x)] = x
            x = x.parent
        if _SENTENCE.search(b.text) and not b.node.hidden:
            words[id(b.node.mark)] = words.get(id(b.node.mark), 0) + b.text.count(" ") + 1
    total, bare = sum(words.values()), words.get(id(None), 0)
    ordered = sorted(marks.values(), key=lambda x: x.depth)
    own = dict(words)
    for x in reversed(ordered):  # with what lies in marked elements inside
        up = x.parent.mark
        if up is not None:
            words[id(up)] = words.get(id(up), 0) + words.get(id(x), 0)
    taken: set[int] = set()
    for name in ("main", "article"):
        core = [x for x in nodes.values() if x.name == name and not x.hidden and x.mark is not x]
        if core:
            x = core[0].mark if len(core) == 1 else None
            while x is not None:
                if x.name not in BAD_TAGS or x.name == "form":
                    taken.add(id(x))
                x = x.parent.mark
            break
    still: dict[int, bool] = {id(None): False}
    for x in ordered:
        around, holds = still[id(x.parent.mark)], words.get(id(x), 0)
        if not around and (id(x) in taken or holds > MOST * total and bare < REST * holds):
            bare += own.get(id(x), 0)
            still[id(x)] = False
        else:
            still[id(x)] = True
    for x in nodes.values():
        x.bad = x.hidden or still[id(x.mark)]


def looks(b: Block) -> tuple[int, ...]:
    """The classifier's columns that a block's text sets; the constant is 0."""
    words = b.text.count(" ") + 1
    linked = b.linked / len(b.text)
    out = [0, bisect_right(WORD_CLASSES, words)]
    if _SENTENCE.search(b.text):
        out.append(7)
    if linked > 0:
        out.append(9 if linked > 0.5 else 8)
    if b.node.heading:
        out.append(10)
    if words < 40 and _RIGHTS.search(b.text):
        out.append(11)
    return tuple(out)


def markup(b: Block, has_article: bool) -> float:
    """What the elements around a block say."""
    node = b.node
    return (ARTICLE if node.article else OUTSIDE if has_article else 0.0) + AGAINST * node.bad + FRAMED * node.frame


def score(b: Block, has_article: bool, weights: Weights = Weights()) -> float:  # noqa: B008
    """Log odds of content: capacity from the source, or to the sink if negative."""
    return sum(weights.text[k] for k in looks(b)) + markup(b, has_article)


def weak_label(b: Block, has_article: bool) -> int | None:
    """By the markup alone; none where it says nothing."""
    m = markup(b, has_article)
    return None if not m else int(m > 0)


def _shared(a: Node, b: Node) -> float:
    """Share of the two places' depth that they have in common."""
    da, db = a.depth, b.depth
    if a is b:
        return 1.0
    x, y = a, b
    while x.depth > y.depth:
        x = x.parent
    while y.depth > x.depth:
        y = y.parent
    while x is not y:
        x, y = x.parent, y.parent
    return (2.0 * x.depth + 1) / (da + db + 1)


def relation(a: Node, b: Node) -> int:
    """Class of an edge by what of the tree its ends share."""
    return 0 if a.parent is b.parent else 1 if _shared(a, b) >= MUCH else 2


def edges(found: list[Block], weights: Weights = Weights()) -> list[tuple[int, int, float]]:  # noqa: B008
    """Smoothness: neighbours, weak where marks differ, and the previous block of the same parent with the same marks."""
    out, last = [], {}

    def add(i: int, j: int, w: float) -> None:
        a, b = found[i].node, found[j].node
        out.append((i, j, w if (a.bad, a.frame, a.article) == (b.bad, b.frame, b.article) else UNLIKE * w))

    for i, b in enumerate(found):
        if i:
            add(i - 1, i, weights.edges[relation(found[i - 1].node, b.node)])
        key = (id(b.node.parent), b.node.bad, b.node.frame, b.node.article)
        j = last.get(key)
        if j is not None and j != i - 1:
            add(j, i, APART * weights.edges[0])
        last[key] = i
    return out


def min_cut(scores: list[float], smooth: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut; a positive score is the source's capacity, a negative the sink's."""
    n = len(scores)
    s = list(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in smooth:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:  # settled where the own capacity exceeds what all edges could take
        i = queue.popleft()
        if label[i] is None and abs(s[i]) >= sum(near[i].values()):
            label[i] = s[i] > 0
            for j, w in near[i].items():
                if label[j] is None:
                    s[j] += w if label[i] else -w
                    del near[j][i]
                    queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        side = _max_flow([s[i] for i in rest], [(number[i], number[j], w) for i in rest for j, w in near[i].items() if i < j and label[j] is None])
        for i, k in number.items():
            label[i] = side[k]
    return [bool(x) for x in label]


def _max_flow(s: list[float], smooth: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's algorithm; True for what the source still reaches."""
    n = len(s)
    src, dst, eps = n, n + 1, 1e-9
    to: list[int] = []
    cap: list[float] = []
    adj: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, c: float, back: float) -> None:
        adj[a].append(len(to))
        to.append(b)
        cap.append(c)
        adj[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, x in enumerate(s):
        if x > 0:
            add(src, i, x, 0.0)
        elif x < 0:
            add(i, dst, -x, 0.0)
    for i, j, w in smooth:
        add(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[src] = 0
        queue = deque([src])
        while queue:
            a = queue.popleft()
            for e in adj[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[dst] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = src
        while True:
            if a == dst:
                f = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= f
                    cap[e ^ 1] += f
                k = next(k for k, e in enumerate(path) if cap[e] <= eps)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[a] < len(adj[a]):
                e = adj[a][turn[a]]
                if cap[e] > eps and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(adj[a]):
                path.append(adj[a][turn[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break


def labelled(html: str | None, weights: Weights = Weights()) -> tuple[list[Block], list[float], list[bool]]:  # noqa: B008
    """A page's blocks, their own log odds, and the labels of the cut."""
    found = blocks(html) if html else []
    if not found:
        return [], [], []
    settle_marks(found)
    has = any(b.node.article and not b.node.bad for b in found)
    own = [score(b, has, weights) for b in found]
    return found, own, min_cut(own, edges(found, weights))


def main_text(html: str | None, weights: Weights = Weights()) -> str:  # noqa: B008
    found, _, keep = labelled(html, weights)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def _cells(column: str):
    """Counts of (columns set, weak label) of blocks, and of (relation, same label) of neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for x in pdf[column]:
                found = blocks(x) if x else []
                if not found:
                    continue
                settle_marks(found)
                has = any(b.node.article and not b.node.bad for b in found)
                labels = [weak_label(b, has) for b in found]
                for i, (b, y) in enumerate(zip(found, labels, strict=True)):
                    if y is not None:
                        seen["block", looks(b), y] += 1
                        if i and labels[i - 1] is not None:
                            seen["edge", (relation(found[i - 1].node, b.node),), int(y == labels[i - 1])] += 1
        if seen:
            yield pd.DataFrame([(kind, list(cols), y, n) for (kind, cols, y), n in seen.items()], columns=["kind", "columns", "y", "n"])

    return run


def fit(pages: DataFrame, html: str = "html", pages_used: int = FIT_PAGES) -> Weights:
    """Weights from a bounded sample; counts of a few hundred kinds of blocks reach the driver."""
    small_batches(pages.sparkSession)
    chance = min(1.0, pages_used / max(pages.count(), 1))
    few = pages.select(html).where(F.shiftrightunsigned(F.xxhash64(F.lit(10), html), 11) <= F.lit(int(chance * 2**53)))
    counted = few.mapInPandas(_cells(html), "kind string, columns array<int>, y int, n long").groupBy("kind", "columns", "y").agg(F.sum("n").alias("n"))
    rows = sorted((r["kind"], tuple(r["columns"]), r["y"], r["n"]) for r in counted.collect())
    return fitted([r[1:] for r in rows if r[0] == "block"], [r[1:] for r in rows if r[0] == "edge"])


def fitted(seen: list[tuple], met: list[tuple], rounds: int = 25) -> Weights:
    """Logistic regression drawn to the starting weights (Newton steps), and log odds of equal labels, from (columns, y, n)."""
    start = np.array(START)
    w = start.copy()
    if seen:
        x = np.zeros((len(seen), len(start)))
        for i, (cols, _, _) in enumerate(seen):
            x[i, list(cols)] = 1
        y, n = np.array([float(r[1]) for r in seen]), np.array([float(r[2]) for r in seen])
        n *= min(1.0, EVIDENCE / n.sum())
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), x.T @ (n * (y - p)) - (w - start))
            w += step
            if np.abs(step).max() < 1e-9:
                break
    total = sum(n for _, _, n in met)
    both = []
    for k, e in enumerate(START_EDGES):
        same, other = (sum(n for (c,), y, n in met if c == k and y == v) * min(1.0, EVIDENCE / max(total, 1)) for v in (1, 0))
        # starting counts have the starting edge as their log odds
        odds = math.log((same + 4 * math.exp(e)) / (other + 4))
        both.append(min(MOST_EDGE, max(0.0, odds)))
    return Weights(tuple(w.tolist()), tuple(both))


def extracted(pages: DataFrame, html: str = "html", weights: Weights | None = None) -> DataFrame:
    """``pages`` with the html replaced by ``text``; without weights, those fitted on these pages."""
    small_batches(pages.sparkSession)
    used = fit(pages, html) if weights is None else weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.drop(columns=[html]).assign(text=[main_text(x, used) for x in pdf[html]])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name not in (html, "text")]
    return pages.drop("text").mapInPandas(run, ", ".join([*kept, "text string"]))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
