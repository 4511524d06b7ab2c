"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree. Its nodes are paths of elements from the body down, each step a tag with
its class and id. A node carries two importances, both from 0 to 1:

* presentation: 0 for what a page is furnished with (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
  reader comments), 1 for what holds an article (``article``, ``main``), else 1/2;
* content: the entropy of the node's texts over the host's pages, to the base of the number of pages that have it. Text
  that comes back on page after page tells nothing; text that is new on every page has entropy 1. A node seen on one
  page has importance 1.

Tags say for certain what is furniture; words of a class, id or role only make a branch suspect, since wrappers of whole
pages carry them too (``has-sidebar``). They do not count on ``html``, ``body``, ``main`` and outer ``article``, nor in
a name that tells a state (``no-sidebar``, ``comments-open``). What is hidden is suspect as well, but not inside an article,
where it is folded away or shown later: a page may hide all it has until its scripts run. A suspect branch is furniture unless the page's text,
each letter counted by its content importance, speaks for it: it must hold more than ``SHARE`` of it, ``SHARE_BESIDE``
where an article stands outside it. Readers' comments are often longer than what they are about, so a branch named
after them must hold more than ``SHARE_READERS`` and no article may stand outside it.

A branch weighs presentation times content, except that an article's weight is 1 whatever its text (a host may hold
copies of one page) and furniture weighs 0 wherever it stands. Of every page those branches go that weigh less than
``KEEP`` of its heaviest branch. So beside an article nothing else stays, unless the plain branches hold more text, by
content importance, than the longest article (a teaser card): then they weigh their content importance. Without an
article, boilerplate goes by its entropy.

Texts: character references are decoded, white space inside a block becomes one space, blocks are trimmed, empty ones
left out, and the rest joined by one line feed in page order. NULL and empty html and pages without text give an empty
text; a page without a host shares the empty host with its like. Unclosed elements, comments, scripts and tags end with
the page. Repeated rows are pages like others; other columns are ignored.

The statistics are counts of (host, node, text). A page gets those of its own nodes, by joins of nodes, so one plan
serves hosts of any size. For that join a page travels as its blocks, compressed: markup, scripts and what is furniture
by tag stay behind. Nesting of any depth costs time in proportion to the page.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormill.llm.urls import host_of
from sensormill.workspace import materialise

KEEP = 0.75
SHARE, SHARE_BESIDE, SHARE_READERS = 0.5, 0.75, 0.9

#: What pages are furnished with: elements, and words of classes, ids and roles.
FURNITURE_TAGS = frozenset(
    "aside button dialog embed footer form frame head header iframe input menu nav noscript script select style template "
    "textarea title".split()
)
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices popup promo promotion related reply replies respond search share sharing sidebar skip social sponsor "
    "sponsored subscribe toolbar widget widgets".split()
)
READERS_WORDS = frozenset("comment comments disqus replies reply respond".split())
#: A name with one of these tells a state or a layout of what is around the furniture.
STATE_WORDS = frozenset("closed disabled enabled has have is no non not off on open opened with without".split())
#: Elements whose classes are the page's or the article's, not a piece of furniture's; an article inside another one is
#: often a comment.
NAMED_BY_PAGE = frozenset({"html", "body", "main"})
#: Inside an article a header holds its title.
TITLE_TAGS, TITLE_WORDS = frozenset({"header"}), frozenset({"header", "masthead"})
ARTICLE_TAGS = frozenset({"article", "main"})
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: An opening tag of the key closes an open element of the values, inside the nearest of the limits.
CLOSED_BY = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
LIMITS = frozenset("ul ol menu dl table select body".split())

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|([^\s=/>"']+)""")
_WORDS = re.compile(r"[a-z0-9]+")


class Suspect:
    """An element named like furniture: its number in the page, whether it is named after readers, and the next suspect
    element around it. Elements point to the innermost one, so deep nesting costs one object per level."""

    __slots__ = ("number", "readers", "outer")

    def __init__(self, number: int, readers: bool, outer: Suspect | None):
        self.number, self.readers, self.outer = number, readers, outer


class Element:
    """``article`` is the number of the outermost article around (0: none), ``post`` whether an ``article`` is around.

    ``suspect`` is the innermost suspect element around, itself included.
    """

    __slots__ = ("tag", "path", "weight", "article", "post", "suspect")

    def __init__(self, tag: str, path: int, weight: float, article: int, post: bool, suspect: Suspect | None):
        self.tag, self.path, self.weight, self.article, self.post, self.suspect = tag, path, weight, article, post, suspect


class Block(NamedTuple):
    node: int
    weight: float
    text: str
    article: int
    suspect: Suspect | None


def _open(tag: str, attributes: str, parent: Element, number: int) -> Element:
    words, hidden, label, is_main = set(), False, "", False
    if attributes:
        for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
            name, value = (name or bare).lower(), a or b or c
            if name in ("class", "id", "role"):
                for one in value.lower().split():
                    parts = _WORDS.findall(one)
                    is_main = is_main or "main" in parts
                    if len(parts) == 1 or STATE_WORDS.isdisjoint(parts):
                        words.update(parts)
                label += f".{value}" if name != "id" else ""
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
    inside = parent.article > 0
    furniture = tag in FURNITURE_TAGS and not (inside and tag in TITLE_TAGS)
    found = words & FURNITURE_WORDS - (TITLE_WORDS if inside else frozenset())
    suspect = parent.suspect
    if (found or hidden and not inside) and tag not in NAMED_BY_PAGE and not (tag == "article" and not parent.post):
        suspect = Suspect(number, not found.isdisjoint(READERS_WORDS), suspect)
    starts = tag in ARTICLE_TAGS or is_main and tag in ("div", "section")
    article = parent.article or (number if starts else 0)
    weight = 0.0 if furniture or parent.weight == 0.0 else 1.0 if article else 0.5
    path = xxhash.xxh64_intdigest(f"{parent.path:x}/{tag}{label}") if tag in BLOCK_TAGS else parent.path
    return Element(tag, path, weight, article, parent.post or tag == "article", suspect)


def blocks(page: str) -> list[tuple[int, float, str]]:
    """(node, presentation importance, text) of the page's blocks that hold text and are no furniture, in page order.

    Suspect branches are judged by the page's own text alone.
    """
    return [(b.node, b.weight, b.text) for b in _furnished(_walk(page), {})]


def _importance(content: dict[int, float], node: int) -> float:
    return content.get(node - (1 << 64) if node >= 1 << 63 else node, 1.0)


def _furnished(found: list[Block], content: dict[int, float]) -> list[Block]:
    """The blocks without those of suspect branches that the page's text does not speak for."""
    if not any(b.suspect for b in found):
        return found
    total, held, known = 0.0, defaultdict(float), {}
    for b in found:
        size = len(b.text) * _importance(content, b.node)
        total += size
        one = b.suspect
        if one is not None:
            held[one.number] += size
        while one is not None and one.number not in known:
            known[one.number] = one
            one = one.outer
    # An element's number is greater than those around it: sums go up in one pass, verdicts down in another.
    for number in sorted(known, reverse=True):
        outer = known[number].outer
        if outer is not None:
            held[outer.number] += held[number]
    beside = any(b.article and not b.suspect for b in found)
    good = {}
    for number in sorted(known):
        readers, outer = known[number].readers, known[number].outer
        share = SHARE_READERS if readers else SHARE_BESIDE if beside else SHARE
        good[number] = (outer is None or good[outer.number]) and not (readers and beside) and held[number] > share * total
    return [b for b in found if b.suspect is None or good[b.suspect.number]]


def main_text(page: str, content: dict[int, float]) -> str:
    """The texts that stay of a page, given the content importance of its host's nodes where it is below 1."""
    return _chosen(_walk(page), content)


def _chosen(walked: list[Block], content: dict[int, float]) -> str:
    found = _furnished(walked, content)
    longest: defaultdict[int, int] = defaultdict(int)
    plain = 0.0
    for b in found:
        if b.weight == 1.0:
            longest[b.article] += len(b.text)
        else:
            plain += len(b.text) * _importance(content, b.node)
    scale = 1.0 if plain > max(longest.values(), default=0) else 0.5
    weighed = [(1.0 if b.weight == 1.0 else scale * _importance(content, b.node), b.text) for b in found]
    least = KEEP * max((w for w, _ in weighed), default=0.0)
    return "\n".join(t for w, t in weighed if w >= least)


def _walk(page: str) -> list[Block]:
    """The blocks that hold text and stand in no furniture by tag, those of suspect branches too, in page order."""
    out: list[Block] = []
    stack = [Element("", 0, 0.5, 0, False, None)]
    open_tags: Counter[str] = Counter()  # so that nobody searches the stack for what is not there
    pieces: list[str] = []
    number = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split()) if pieces else ""
        pieces.clear()
        if text and stack[-1].weight > 0:
            top = stack[-1]
            out.append(Block(top.path, top.weight, text, top.article, top.suspect))

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag in BLOCK_TAGS:
                flush()
            open_tags[stack.pop().tag] -= 1

    at = 0
    while True:
        mark = _MARK.search(page, at)
        text = page[at : mark.start()] if mark else page[at:]
        if text and stack[-1].weight > 0:
            pieces.append(html.unescape(text))
        if not mark:
            break
        at = mark.end()
        closing, tag, attributes = mark[1], (mark[2] or "").lower(), mark[3]
        if not tag:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if stack[depth].tag in BLOCK_TAGS and tag not in BLOCK_TAGS:
                    break  # an inline end tag does not close a block
            continue
        if tag in VOID_TAGS:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr"):
                pieces.append(" " if tag == "br" else "")
            continue
        if tag in BLOCK_TAGS:
            for depth in range(len(stack) - 1, 0, -1) if tag != "html" and open_tags["head"] else ():
                if stack[depth].tag == "head":
                    close(depth)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in BLOCK_TAGS:
                    break
            closers = [t for t in CLOSED_BY.get(tag, ()) if open_tags[t]]
            for depth in range(len(stack) - 1, 0, -1) if closers else ():
                if stack[depth].tag in LIMITS:
                    break
                if stack[depth].tag in closers:
                    close(depth)
                    if not any(open_tags[t] for t in closers):
                        break
        number += 1
        element = _open(tag, attributes, stack[-1], number)
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in BLOCK_TAGS:
            flush()
        stack.append(element)
        open_tags[tag] += 1
    close(1)
    flush()
    return out


def packed(found: list[Block]) -> bytes:
    """The blocks of a page for a shuffle: nodes and suspect elements listed once, texts as they are, compressed."""
    known: dict[int, Suspect] = {}
    for b in found:
        one = b.suspect
        while one is not None and one.number not in known:
            known[one.number] = one
            one = one.outer
    # An element's number is greater than those around it, so the outer ones are listed first.
    at = {number: place for place, number in enumerate(sorted(known))}
    suspects = [(n, known[n].readers, None if known[n].outer is None else at[known[n].outer.number]) for n in at]
    nodes = {node: place for place, node in enumerate(dict.fromkeys(b.node for b in found))}
    rows = [(nodes[b.node], b.weight, b.article, None if b.suspect is None else at[b.suspect.number]) for b in found]
    parts = [list(nodes), suspects, rows, [b.text for b in found]]
    return zstandard.compress(json.dumps(parts, ensure_ascii=False, separators=(",", ":")).encode(), 1)


def unpacked(value: bytes) -> list[Block]:
    nodes, listed, rows, texts = json.loads(zstandard.decompress(value))
    suspects: list[Suspect] = []
    for number, readers, outer in listed:
        suspects.append(Suspect(number, readers, None if outer is None else suspects[outer]))
    return [
        Block(nodes[node], weight, text, article, None if suspect is None else suspects[suspect])
        for (node, weight, article, suspect), text in zip(rows, texts, strict=True)
    ]


def _hosted(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host, and ``page``: the address of host and content, which repeated pages share."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    return rows.withColumn("page", F.unhex(F.sha2(F.concat_ws("\n", F.coalesce("host", F.lit("")), "html").cast("binary"), 256)))


def _node_rows(rows: DataFrame) -> DataFrame:
    """(host, page, node, content): the text of every node that is no furniture by tag, once per row."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, nodes, contents = [], [], []
            for row, source in enumerate(batch["html"].to_pylist()):
                digests: dict[int, xxhash.xxh64] = {}
                for b in _walk(source):
                    digests.setdefault(b.node, xxhash.xxh64()).update(b.text + "\n")
                at += [row] * len(digests)
                nodes += digests
                contents += [d.intdigest() for d in digests.values()]
            own = pa.array(at, pa.int64())
            arrays = [
                batch["host"].take(own),
                batch["page"].take(own),
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(contents, dtype=np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "page", "node", "content"])

    return rows.select("host", "page", "html").mapInArrow(walk, "host string, page binary, node long, content long")


def site_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance): content importance of the nodes seen on two pages of a host or more."""
    return _tree(_node_rows(_hosted(pages)))


def _tree(nodes: DataFrame) -> DataFrame:
    texts = nodes.groupBy("host", "node", "content").agg(F.count("*").cast("double").alias("n"))
    sums = texts.groupBy("host", "node").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("x"))
    entropy = (F.log("pages") - F.col("x") / F.col("pages")) / F.log("pages")
    return sums.filter("pages > 1").select("host", "node", F.col("pages").cast("long"), F.greatest(F.lit(0.0), entropy).alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A page gets the importance of its own nodes only, by a join of nodes: what a host's pages have in common is never
    gathered, however many pages and nodes it has. The html itself is not shuffled, only the blocks that may stay.
    """
    rows = _hosted(pages)
    nodes = materialise(_node_rows(rows), "page-nodes")
    below = _tree(nodes).filter("importance < 1").select("host", "node", "importance")
    own = nodes.select("host", "page", "node").distinct().join(below, ["host", "node"])
    per_page = own.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("node", "importance"))).alias("tree"))

    @F.pandas_udf("binary")
    def blocks_of(source: pd.Series) -> pd.Series:
        return pd.Series([packed(_walk(one)) for one in source], dtype=object)

    @F.pandas_udf("string")
    def text_of(found: pd.Series, importance: pd.Series) -> pd.Series:
        out = [_chosen(unpacked(one), dict(known) if known is not None else {}) for one, known in zip(found, importance, strict=True)]
        return pd.Series(out, dtype=object)

    bodies = rows.select("page_id", "url", "page", blocks_of("html").alias("blocks"))
    joined = bodies.join(per_page, "page", "left").withColumn("text", text_of("blocks", "tree"))
    return joined.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
