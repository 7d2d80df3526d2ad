"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with its root-to-leaf path
of block tags.  Per path the text length and the punctuation are summed and
divided by the number of blocks; the two ratios are fused (length times one
plus punctuation), smoothed over neighbouring blocks and held against the
page's threshold.  The smallest element that holds all blocks above it is the
article, or all article or main elements with such blocks where there are any;
their blocks, in page order, and a headline before them are the text.  Elements that say themselves that they are menus, notices, forms and
the like never count.

A page is one row, so no shuffle is needed: pages are dealt as the scan deals
them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import col, table

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style noscript template title textarea select button iframe object svg math canvas audio video map datalist".split())
BOILERPLATE = set("nav footer aside form menu dialog head".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Words of a class or id that mark an element as something else than the article.
MARKS = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header
masthead topbar toolbar comment comments commentlist respond reply replies disqus discussion social share sharing related recommended
recommendations widget widgets pagination pager search""".split())
#: Class names that tell what an element has or lacks.
MODIFIED = re.compile(r"(?:has|have|with|no|without|hide|hides|show|shows)[^a-z0-9]")
#: Readers' words, which are never the article.
READERS = set("comment comments commentlist respond reply replies disqus discussion".split())
NEVER, WHOLE, PART = 2.0, 0.9, 0.5
#: Elements of running text: a mark that is a part of their name (related-work) says nothing.
TEXTUAL = HEADINGS | set("p li dt dd blockquote pre td th tr figcaption".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
#: Paths inside a story, whose own header may hold its heading.
STORY = re.compile(r"/(?:article|main)\b|\.(?:post|entry|story|article|content)\b")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table body html div section article main td th blockquote".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


class Node:
    __slots__ = ("parent", "tag", "path", "out", "mark", "number", "depth")

    def __init__(self, parent: "Node | None", tag: str, name: str, out: bool, number: int, mark: float = 0.0):
        self.parent, self.tag, self.out, self.mark, self.number = parent, tag, out, mark, number
        self.path = (parent.path + "/" if parent else "") + name
        self.depth = parent.depth + 1 if parent else 0


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)}


def _is_out(tag: str, attrs: dict[str, str], inside_article: bool) -> bool:
    if tag in BOILERPLATE or tag == "header" and not inside_article:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    return attrs.get("role", "").lower() in ROLES


def _mark(tag: str, attrs: dict[str, str]) -> float:
    """0, or the share of the page's weight above which an element's marks
    don't count: NEVER of a readers' mark; WHOLE where a class or id has nothing but marks, PART where it has one
    among other words."""
    if tag in ("html", "body", "main", "header"):  # a header inside a story keeps its headings
        return 0.0
    names = [n for n in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split() if not MODIFIED.match(n)]
    parts = [[x for x in re.split(r"[^a-z0-9]+", n) if x] for n in names]
    whole = [x for n in parts if n and MARKS.issuperset(n) for x in n]
    if whole:
        return NEVER if READERS.intersection(whole) else WHOLE
    return PART if tag not in TEXTUAL and any(MARKS.intersection(n) for n in parts) else 0.0


def blocks(page: str) -> list[tuple[Node, str]]:
    """(element, text) of each text block in page order; boilerplate left out."""
    found: list[tuple[Node, str]] = []
    node = Node(None, "", "", False, 0)
    parts: list[str] = []
    number, at, size = 0, 0, len(page)

    def close_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not node.out:
                found.append((node, text))
            parts.clear()

    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        end, attrs_text = m[1] or m[4], m[3] if m[2] else m[6]
        if tag in SKIPPED:
            if not end and not (attrs_text or "").endswith("/"):
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else size
            parts.append(" ")
            continue
        if tag in INLINE:
            if not end and attrs_text and "hidden" in attrs_text.lower() and "hidden" in _attributes(attrs_text):
                stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = stop.end() if stop else at
            continue
        close_block()
        if tag in VOID:
            continue
        if end:
            up = node
            while up.parent is not None and up.tag != tag:
                up = up.parent
            if up.parent is not None and not (tag not in SCOPES and _crosses(node, up)):
                node = up.parent
            continue
        # a paragraph ends where any other block starts; items end at the next item
        if node.tag == "p":
            node = node.parent
        if tag in CLOSED_BY:
            up = node
            while up.parent is not None and up.tag not in SCOPES and up.tag not in CLOSED_BY[tag]:
                up = up.parent
            if up.tag in CLOSED_BY[tag]:
                node = up.parent
        attrs = _attributes(attrs_text) if attrs_text else {}
        inside = bool(STORY.search(node.path))
        number += 1
        name = tag + ("." + attrs["class"].split()[0] if attrs.get("class", "").strip() else "")
        out = node.out or _is_out(tag, attrs, inside)
        node = Node(node, tag, name, out, number, _mark(tag, attrs))
    close_block()
    return _unmarked([(n, t) for n, t in found if not _in_header(n)])


def _unmarked(found: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Blocks outside marked elements.  A mark doesn't count on an element with
    most of the page's weight (but for readers' marks), nor around an article or main element that weighs
    more than all unmarked blocks beside it; nor does a name that is a mark in part, inside an article,
    on text with the ratios of the unmarked blocks."""
    if not any(up.mark for up in {n.number: n for n, _ in found}.values() for up in _chain(up)):
        return found
    weight = _fused(found)
    sums: dict[int, float] = {}
    counts: dict[int, int] = {}
    stories: dict[int, Node] = {}
    marked = []
    for (node, _), w in zip(found, weight):
        ups = list(_chain(node))
        marked.append(any(up.mark for up in ups))
        for up in ups:
            sums[up.number] = sums.get(up.number, 0.0) + w
            counts[up.number] = counts.get(up.number, 0) + 1
            if up.tag in ("article", "main") and not up.mark:
                stories[up.number] = up
    void: set[int] = set()
    if stories:
        story = max(stories.values(), key=lambda n: (sums[n.number], -n.depth))
        beside = sum(w for (n, _), w, m in zip(found, weight, marked) if not m and all(up is not story for up in _chain(n)))
        if sums[story.number] > beside:
            void = {up.number for up in _chain(story)}
    total = sums[0]
    plain = [w for w, m in zip(weight, marked) if not m]
    usual = 0.5 * sum(plain) / len(plain) if plain else 0.0

    def gone(up: Node) -> bool:
        if not up.mark or up.number in void or sums[up.number] > up.mark * total:
            return False
        return up.mark != PART or "/article" not in up.path or not plain or sums[up.number] / counts[up.number] < usual

    return [(n, t) for n, t in found if not any(gone(up) for up in _chain(n))]


def _crosses(node: Node, up: Node) -> bool:
    """An end tag of a small element doesn't close the section around it."""
    while node is not up:
        if node.tag in SCOPES:
            return True
        node = node.parent
    return False


def _in_header(node: Node) -> bool:
    """Text of an article's own header counts only in its headings."""
    heading = node.tag in HEADINGS
    while node is not None:
        if node.tag == "header":
            return not heading
        node = node.parent
    return False


def _chain(node: Node) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _fused(found: list[tuple[Node, str]]) -> np.ndarray:
    """Per block the fused ratios of its path."""
    paths: dict[str, list[float]] = {}
    for node, text in found:
        p = paths.setdefault(node.path, [0, 0, 0])
        p[0] += len(text)
        p[1] += len(PUNCTUATION.findall(text))
        p[2] += 1
    return np.array([paths[n.path][0] / paths[n.path][2] * (1 + paths[n.path][1] / paths[n.path][2]) for n, _ in found])


def _common(nodes: list[Node]) -> Node:
    """Smallest element that holds all of the given ones."""
    top = nodes[0]
    for node in nodes[1:]:
        while top is not node:
            if top.depth >= node.depth:
                top = top.parent
            else:
                node = node.parent
    return top


def content(found: list[tuple[Node, str]]) -> list[str]:
    """Texts of the blocks of the article."""
    if len(found) < 2:
        return [t for _, t in found]
    fused = _fused(found)
    padded = np.pad(fused, 1, mode="edge")
    smooth = 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]
    least = min(smooth.std(), smooth.max())
    chosen = smooth >= least
    weight = np.where(chosen, fused, 0.0)
    sums: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    for (node, _), w in zip(found, weight):
        for up in _chain(node):
            sums[up.number] = sums.get(up.number, 0.0) + w
            nodes[up.number] = up
    named = sorted((n for n in nodes.values() if n.tag in ("article", "main") and sums[n.number] > 0), key=lambda n: (-sums[n.number], -n.depth))
    kept: dict[int, Node] = {}
    above: set[int] = set()
    for n in named:  # the heaviest, and those beside it
        ups = [up.number for up in _chain(n)]
        if n.number not in above and not kept.keys() & set(ups):
            kept[n.number] = n
            above.update(ups)
    if not kept:
        # blocks that are chosen for their neighbours alone don't widen the article
        article = _common([n for (n, _), c in zip(found, chosen & (fused >= least)) if c] or [n for (n, _), c in zip(found, chosen) if c])
        while article.parent is not None and article.tag not in SCOPES:
            article = article.parent  # a lone paragraph: its section
        kept[article.number] = article
    inside = [any(up.number in kept for up in _chain(n)) for n, _ in found]
    first = inside.index(True)
    # the article may lack a headline of its own
    if found[first][0].tag not in HEADINGS and not any(n.tag == "h1" for (n, _), x in zip(found, inside) if x):
        heads = [i for i in range(first) if found[i][0].tag == "h1"]
        for i in range(heads[-1] if heads else first, first):  # a headline beside the article
            inside[i] = found[i][0].tag in HEADINGS
    return [t for (_, t), x in zip(found, inside) if x]


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends; null or no text: empty."""
    return "\n".join(content(blocks(page))) if page else ""


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of each row.  Null and
    empty pages give empty text; repeated rows come back as often as given; a page is
    read whole, however long.  A kept column named like a result is an error."""
    taken = {c.lower() for c in keep} & {"text", "n_chars"}
    if taken:
        raise ValueError(f"rename {sorted(taken)} first")
    held = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["text"] = [main_text(h) for h in b.pop("html")]
            b["n_chars"] = [len(t) for t in b["text"]]
            yield b

    picked = pages.select(*[col(c).alias(h) for c, h in zip(keep, held)], col(html_col).cast("string").alias("html"))
    kinds = ", ".join(f"{c} {t}" for c, t in picked.drop("html").dtypes)
    return picked.mapInPandas(run, f"{kinds}, text string, n_chars long") \
        .select(*[F.col(h).alias(c) for c, h in zip(keep, held)], "text", "n_chars")


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``: page_id, url, text, n_chars."""
    return extract(table(spark, sf_dir, "pages"))
