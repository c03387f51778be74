"""Main text of web pages by a minimum cut.

A page becomes text blocks in page order. Costs of a linear classifier over a block's place, length and links become the
capacities to the two terminals; smoothness edges join blocks that follow one another (adjacency) and, stronger, blocks
whose DOM paths share more (proximity). Max-flow then separates content from boilerplate: a short paragraph between long
ones stays, a menu entry between menu entries goes. Each page is a row, so pages spread over tasks as they are read; a
graph has a node for each block and at most two edges for each.

Rules of the text: character references are decoded, white space within a block is one space, ``<br>`` and table cells
are white space, blocks are joined by two line feeds. Scripts, styles, hidden elements, comments and fields of forms are no
text. Elements left open end where an ancestor ends. A skipped element that its tag closes is empty, and one without an end
tag hides nothing, but for script, style, title and textarea, which run to the end of the page. A tag whose quotes do not pair
ends at its first ``>``. An article or main element inside one that only a class name or a form marks as boilerplate is
content again.

Defined results: null and empty pages and pages without content give an empty text; repeated rows are pages of their own;
an empty table gives an empty result; other columns pass through, but for columns named like the two new ones, which
give way.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A tag with its quotes in pairs and not very long, else up to its first ``>``; nothing is tried twice.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]{0,4000}\"|'[^']{0,4000}'){0,2000}+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|((?<![\w-])hidden(?![\w-]))")
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
_TOKEN = re.compile(r"[a-z]+")
#: Class names that say what an element has, or has not, and not what it is.
_LAYOUT = re.compile(r"(?<![\w-])(?:has|no|with|without|not|is|js)[-_][\w-]*")
#: Elements whose content is no text of the page, up to their end tag; of those in the second set, to the end of the page if it is missing.
SKIPPED = frozenset("script style noscript template svg iframe object canvas title select textarea button".split())
TO_THE_END = frozenset("script style title textarea".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr
ul caption""".split())
SPACES = frozenset("br td th option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the first kind ends when one of these begins.
ENDED_BY = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"])}
#: Elements, roles and words of class or id that speak against content, and for it.
AGAINST_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
AGAINST_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
AGAINST_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies
disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification
pagination pager popup promo promotion recommended related replies reply respond search share sharing sidebar signup social
sponsor sponsored subscribe subscription toolbar topbar widget""".split())
FOR_TAGS, FOR_WORDS = frozenset(["article", "main"]), frozenset("article articlebody content entry main post story text".split())

#: Weights of the classifier; of the edges: next block, square of the share of the path in common, and factor where one
#: end alone stands in a place that speaks against content.
PLACE_AGAINST, PLACE_FOR, LINKS, WORDS_FOR, MOST_WORDS, SHORT, PARAGRAPH = 12.0, 4.0, 4.0, 0.12, 3.0, 1.2, 0.5
ADJACENT, PROXIMITY, APART = 0.4, 2.0, 0.25


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    tag: str
    path: tuple[int, ...]  # numbers of the open elements
    against: bool
    favoured: bool


class _Open(NamedTuple):
    tag: str
    number: int
    against: bool
    favoured: bool
    hidden: bool
    pardoned: bool = False  # what speaks against it is a class name or a form, which an article inside takes back


def _opened(tag: str, attributes: str, number: int, parent: _Open) -> _Open:
    against, favoured, hidden = tag in AGAINST_TAGS or (tag == "header" and not parent.favoured), tag in FOR_TAGS, parent.hidden
    by_class = tag in ("form", "fieldset")
    strict = against and not by_class
    if attributes.strip(" /\n\t\r"):
        for name, value, bare in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if bare or name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                hidden = True
            elif name == "role":
                strict |= value in AGAINST_ROLES and value != "form"
                against |= value in AGAINST_ROLES
                favoured |= value in FOR_TAGS
            elif name in ("class", "id") and tag not in ("html", "body"):
                found = set(_TOKEN.findall(_LAYOUT.sub(" ", value)))
                comments = "comment" in found or "comments" in found
                if tag == "header" and parent.favoured:
                    found.discard("header")
                against |= not AGAINST_WORDS.isdisjoint(found) and (tag not in FOR_TAGS or comments)
                strict |= comments
                favoured |= not FOR_WORDS.isdisjoint(found)
    if tag in FOR_TAGS and parent.against and parent.pardoned and not against:
        return _Open(tag, number, False, True, hidden)
    marked = parent.against or against
    return _Open(tag, number, marked, (parent.favoured or favoured) and not against, hidden,
                 marked and not strict and (parent.pardoned or not parent.against))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page."""
    out: list[Block] = []
    stack = [_Open("", 0, False, False, False)]
    parts: list[str] = []
    linked, in_link, number, at = 0, False, 0, 0
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            top = stack[-1]
            if text and not top.hidden:
                out.append(Block(text, min(linked, len(text)), top.tag, tuple(x.number for x in stack), top.against, top.favoured))
            parts.clear()
        linked = 0

    last = page.rfind(">") + 1  # no tag ends behind it
    while True:
        m = _TAG.search(page, at, last) if at < last else None
        text = page[at:m.start()] if m else _UNFINISHED.split(page[at:], maxsplit=1)[0]
        if text:
            parts.append(text)
            linked += in_link and len(text.strip())
        if not m:
            break
        at = m.end()
        closes, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag in SKIPPED and not closes:
            end = None if tag in unclosed or m[3].endswith("/") else re.compile(rf"</{tag}\s*>?", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in TO_THE_END and not m[3].endswith("/"):
                at = len(page)
            elif not m[3].endswith("/"):
                unclosed.add(tag)  # no end tag follows any more: what comes is text
            parts.append(" ")
        elif tag == "a":
            in_link = not closes
        elif tag in SPACES:
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            in_link = False
            if closes:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            elif tag not in VOID:
                if tag in ENDED_BY.get(stack[-1].tag, ()):
                    stack.pop()
                number += 1
                stack.append(_opened(tag, m[3], number, stack[-1]))
        elif tag == "span" or tag not in VOID:  # inline; one that is hidden or an advert is a block of its own
            if not closes and ("class" in m[3] or "hidden" in m[3] or "display" in m[3] or "role" in m[3]):
                inner = _opened(tag, m[3], number + 1, stack[-1])
                if inner.hidden > stack[-1].hidden or inner.against > stack[-1].against:
                    flush()
                    number += 1
                    stack.append(inner)
            elif closes and stack[-1].tag == tag:
                flush()
                stack.pop()
    flush()
    return out


def costs(block: Block) -> tuple[float, float]:
    """For taking the block as boilerplate, and for taking it as content."""
    words = block.text.count(" ") + 1
    lose = min(WORDS_FOR * words, MOST_WORDS) + PLACE_FOR * block.favoured + PARAGRAPH * (block.tag in ("p", "pre", "blockquote", "h1", "h2"))
    keep = PLACE_AGAINST * block.against + LINKS * block.linked / len(block.text) + SHORT * (words < 6)
    return lose, keep


def content(blocks: list[Block]) -> list[bool]:
    """Which blocks lie on the content side of the minimum cut."""
    n = len(blocks)
    flow = _Flow(n + 2)
    source, sink = n, n + 1
    for i, block in enumerate(blocks):
        lose, keep = costs(block)
        if lose > keep:  # what passes straight through changes no cut
            flow.edge(source, i, lose - keep, 0.0)
        else:
            flow.edge(i, sink, keep - lose, 0.0)
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            weight = (ADJACENT + PROXIMITY * _shared(blocks[i - 1], block)) * (APART if blocks[i - 1].against != block.against else 1)
            flow.edge(i - 1, i, weight, weight)
        parent = block.path[-2] if len(block.path) > 1 else 0
        before = None if block.against else last.get(parent)
        if before is not None and before < i - 1:  # siblings with something between
            weight = PROXIMITY * _shared(blocks[before], block)
            flow.edge(before, i, weight, weight)
        if not block.against:
            last[parent] = i
    flow.run(source, sink)
    side = flow.reached(source)
    return side[:n]


def _shared(a: Block, b: Block) -> float:
    same = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        same += 1
    return (same / max(len(a.path), len(b.path))) ** 2


class _Flow:
    """Maximum flow by shortest augmenting paths, level by level."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def reached(self, source: int) -> list[bool]:
        return [x >= 0 for x in self.levels(source)]

    def run(self, source: int, sink: int) -> None:
        while (level := self.levels(source))[sink] >= 0:
            tried = [0] * len(self.out)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    k = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.to[path[k] ^ 1]
                    del path[k:]
                while tried[a] < len(self.out[a]):
                    e = self.out[a][tried[a]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    tried[a] += 1
                if tried[a] < len(self.out[a]):
                    path.append(e)
                    a = self.to[e]
                elif path:
                    level[a] = -1
                    a = self.to[path.pop() ^ 1]
                else:
                    break


def main_text(page: str | None) -> str:
    blocks = blocks_of(page) if page else []
    return "\n\n".join(b.text for b, kept in zip(blocks, content(blocks)) if kept) if blocks else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``main_text`` and ``n_chars``."""
    schema = T.StructType([T.StructField("row", pages.schema), T.StructField("main_text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                texts = [main_text(x.as_py()) for x in rows.column("html")]
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                                 ["row", "main_text", "n_chars"])

    found = pages.select(F.struct(*pages.columns).alias("row"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
    return found.select(*(F.col("row")[c].alias(c) for c in pages.columns if c not in ("main_text", "n_chars")), "main_text", "n_chars")
