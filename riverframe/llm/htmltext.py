"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read once from left to right into text blocks: runs of text between block-level tags, each
with its place in the element tree and how much of it is link text. Markup, comments, scripts, styles and other raw
elements never become text. Every block is a node of a flow network. A linear classifier on
the block (length, links, kind of its element, names of the elements and classes around it) gives the
capacity of its edge from the source (content) or to the sink (boilerplate); neighbouring blocks share an edge
that is the stronger the closer they are in the tree (one parent, one container, another one). The minimum cut, found by
augmenting paths, labels all blocks of a page at once: blocks on the source's side are the main text.

Roles are evidence for the classifier and no verdict: an element whose tag names a role (nav, footer, aside, form, header
outside the article, hidden ones) costs ``BY_TAG``, one whose class, id or role does (adverts, notices, comments, and so on)
``BY_NAME``, a block of an article gains ``IN_ARTICLE`` unless a role is named inside the article. The words of the block and its
neighbours can outweigh each. Names of elements that hold the page's article say nothing about it, names such as
``no-sidebar`` tell what a page has and not what an element is, and a header in an article is part of it.
The cut runs on every page. Entities are decoded, white space inside a block becomes one space, blocks are joined by one
newline in page order.

Defined results: null or empty html, pages without text or with boilerplate alone give an empty text;
unclosed and misnested tags are closed as a browser would at the next block or the end; a page cut off anywhere is
read as far as it goes; repeated rows are extracted one by one; null ids and urls pass through. Other columns are not
read.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")  # a tag whose quotes do not close
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"[a-z]+")
_ABOUT = re.compile(r"(?:no|not|has|have|with|without|show|hide)[-_]")  # a class that tells what the page has

# Elements by role.
RAW = frozenset("script style noscript template textarea iframe object svg math canvas audio video select option datalist title head".split())
HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template head".split())  # anything else ends an open head
VERBATIM = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body main article section div table tbody tr ul ol dl blockquote".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
NEVER = frozenset("nav footer aside form button menu dialog fieldset legend input".split())
BAD_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer foot sidebar side aside ad ads advert adverts advertisement banner sponsor sponsored promo promotion notice notices "
    "cookie cookies consent gdpr newsletter subscribe subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs "
    "comment comments comentarios disqus reply replies widget popup modal overlay copyright legal disclaimer toolbar pagination pager form search alert tags".split()
)
GOOD_NAMES = frozenset("article content main post entry story text body".split())

BY_TAG = 8.0
BY_NAME = 5.0
IN_ARTICLE = 6.0
_NOTHING = 1e-9


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the open containers
    tag: str
    named: frozenset[int]  # elements around it whose names tell a boilerplate role
    tagged: bool  # the tag of an element around it tells one
    articles: tuple[int, ...]  # articles around it, from outside to inside
    good: bool
    links: int = 0

    @property
    def bad(self) -> bool:
        return self.tagged or bool(self.named)


@dataclass
class _Open:
    tag: str
    number: int
    named: frozenset[int] = frozenset()
    tagged: bool = False
    articles: tuple[int, ...] = ()
    good: bool = False
    raw: bool = False


@dataclass
class Reader:
    """Turns a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    count: int = 0
    wrappers: dict[int, frozenset[int]] = field(default_factory=dict)  # elements with bad names around each article

    def flush(self) -> None:
        if not self.parts:
            return
        raw = "".join(self.parts)
        text = _SPACE.sub(" ", entities.unescape(raw) if "&" in raw else raw).strip()
        if text:
            top = self.stack[-1] if self.stack else _Open("", 0)
            tag = next((o.tag for o in reversed(self.stack) if o.tag not in INLINE), "")
            self.blocks.append(Block(text, tuple(o.number for o in self.stack if o.tag in CONTAINERS), tag, top.named, top.tagged, top.articles, top.good, self.linked))
        self.parts, self.linked = [], 0

    def _leave_head(self) -> None:
        if self.stack and self.stack[-1].tag == "head":
            self.stack.pop()

    def text(self, s: str) -> None:
        if s.strip():
            self._leave_head()
        if s and not (self.stack and self.stack[-1].raw):
            self.parts.append(s)
            if any(o.tag == "a" for o in self.stack):
                self.linked += len(s.strip())

    def open(self, tag: str, attributes: str) -> None:
        if tag not in HEAD:
            self._leave_head()
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            if tag in CLOSES_P:
                self._close_until("p", stop=("button", "table", "div", "article", "section", "li", "td", "blockquote", "body"))
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self._close_until(tag, stop=("ul", "ol", "dl", "table", "select"))
        if tag in VOID:
            return
        self.count += 1
        up = self.stack[-1] if self.stack else _Open("", 0)
        names, hidden, kind_is_main = set(), False, False
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                value = (m[2] or m[3] or m[4] or "").lower()
                kind = m[1].lower()
                if kind in ("class", "id", "role"):
                    names.update(n for word in value.split() if not _ABOUT.match(word) for n in _NAMES.findall(word))
                    kind_is_main |= kind == "role" and value.strip() == "main"
                elif kind == "hidden" or kind == "style" and "display:none" in value.replace(" ", ""):
                    hidden = True
        is_article = tag in ("article", "main") or kind_is_main
        if is_article:
            self.wrappers[self.count] = up.named
        articles = (*up.articles, self.count) if is_article else up.articles
        good = bool(names & GOOD_NAMES)
        # A header inside an article holds its headline; names of whole-page wrappers do not condemn them.
        role = names & BAD_NAMES - ({"header"} if articles or good else set())
        named = up.named | {self.count} if role and not is_article and tag not in ("html", "body") else up.named
        tagged = up.tagged or tag in NEVER or hidden or (tag == "header" and not articles)
        self.stack.append(_Open(tag, self.count, named, tagged, articles, up.good or good, up.raw or tag in RAW))

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if tag == "p" and not any(o.tag == "p" for o in self.stack):
            return
        self._close_until(tag)

    def _close_until(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return
            if self.stack[k].tag in stop:
                return


def blocks(page: str) -> list[Block]:
    reader, at = Reader(), 0
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            break
        m = _TOKEN.match(page, begin) or _UNQUOTED.match(page, begin)
        if not m:
            reader.text(page[at : begin + 1])
            at = begin + 1
            continue
        reader.text(page[at:begin])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            reader.close(tag)
            continue
        reader.open(tag, m[3])
        if tag in VERBATIM and not m[3].endswith("/"):
            end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(page, at)
            reader.close(tag)
            at = end.end() if end else len(page)
    reader.text(page[at:])
    reader.flush()
    return _without_wrappers(reader)


def _without_wrappers(reader: Reader) -> list[Block]:
    """The blocks, those of the page's article without the names of the elements that hold it."""
    size: dict[int, int] = {}
    inside: dict[int, set[int]] = {}
    for block in reader.blocks:
        for k, article in enumerate(block.articles):
            size[article] = size.get(article, 0) + len(block.text)
            inside.setdefault(block.articles[k - 1] if k else 0, set()).add(article)
    at = 0
    while at in inside:  # the largest one, and inside it one with most of its text
        largest = max(sorted(inside[at]), key=size.__getitem__)
        if at and 2 * size[largest] <= size[at]:
            break
        at = largest
    if at and reader.wrappers[at]:
        for block in reader.blocks:
            if at in block.articles:
                block.named -= reader.wrappers[at]
    return reader.blocks


def cost(block: Block) -> float:
    """How much a block speaks for content (positive) or boilerplate (negative)."""
    share = min(1.0, block.links / max(1, len(block.text)))
    words = block.text.count(" ") + 1
    weight = -1.0 + min(words, 40) * 0.08 - 4.0 * share
    if block.bad:
        weight -= BY_TAG if block.tagged else BY_NAME
    else:
        weight += 1.5 * block.good + IN_ARTICLE * bool(block.articles)
    weight += {"p": 1.5, "pre": 1.0, "blockquote": 1.0, "h1": 1.5, "h2": 0.5, "h3": 0.5, "td": 0.0, "li": -0.5}.get(block.tag, -0.5)
    return weight + 0.5 * any(c in block.text for c in ".!?")


def closeness(a: Block, b: Block) -> float:
    """Strength of the edge between neighbours: by how far apart their containers are."""
    shared = 0
    for x, y in zip(a.path, b.path, strict=False):
        if x != y:
            break
        shared += 1
    apart = len(a.path) + len(b.path) - 2 * shared
    return (2.0 if a.bad == b.bad else 1.0) / (1 + apart)


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page, and between successive blocks of one container."""
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            edges.append((i - 1, i, closeness(found[i - 1], block)))
        j = last.get(block.path)
        if j is not None and j < i - 1:
            edges.append((j, i, closeness(found[j], block)))
        last[block.path] = i
    return edges


def minimum_cut(weights: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side of the minimum cut.

    ``weights`` are terminal capacities (source edge if positive, sink edge if negative), ``edges``
    join two nodes in both directions. Augmenting paths run from a node with supply along edges with room to a
    node with demand; breadth first, so each saturates a shortest one.
    """
    supply, demand = [max(w, 0.0) for w in weights], [max(-w, 0.0) for w in weights]
    room: list[dict[int, float]] = [{} for _ in weights]
    for i, j, c in edges:
        room[i][j] = room[i].get(j, 0.0) + c
        room[j][i] = room[j].get(i, 0.0) + c
    closed: set[int] = set()  # no demand can be reached from these any more
    for s in range(len(weights)):
        while supply[s] > _NOTHING and s not in closed:
            before, queue, goal = {s: s}, deque([s]), -1
            while queue:
                u = queue.popleft()
                if demand[u] > _NOTHING:
                    goal = u
                    break
                for v, c in room[u].items():
                    if c > _NOTHING and v not in before and v not in closed:
                        before[v] = u
                        queue.append(v)
            if goal < 0:
                closed.update(before)
                break
            path, u = [], goal
            while u != s:
                path.append((before[u], u))
                u = before[u]
            flow = min([supply[s], demand[goal], *(room[a][b] for a, b in path)])
            supply[s] -= flow
            demand[goal] -= flow
            for a, b in path:
                room[a][b] -= flow
                room[b][a] += flow
    out = [x > _NOTHING for x in supply]
    queue = deque(i for i, side in enumerate(out) if side)
    while queue:
        u = queue.popleft()
        for v, c in room[u].items():
            if c > _NOTHING and not out[v]:
                out[v] = True
                queue.append(v)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    weights = [cost(b) for b in found]
    keep = minimum_cut(weights, smoothness(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
