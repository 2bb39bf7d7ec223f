"""Main text of web pages by tag-path ratios.

A page becomes a list of text nodes, each with its path of tags from the root. For every path,
text length and punctuation are summed over its nodes and divided by their number; the two ratios
are smoothed along the page, fused into one score, and paths with a score above the threshold
are content. Every section with a text of such a path is in the article, however short. An <article> or
<main> around content, and a section with a fair part of the content, belong to it whole: headings and short blocks
too, although their own paths score low. Between the sections, from the innermost one around all content, headings belong to it. Parts that a page itself marks as menu,
header, footer, sidebar, notice, advert, form or comments are left out before.

Defined results: a null or empty page, or one without text outside such parts, has an empty
text. Each page is read alone, so repeated rows and ids give repeated results; an empty table
an empty one. Unclosed and misnested tags are closed the way browsers do for paragraphs, items
and cells. Extra columns of the input are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of tags.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp template svg math object select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SECTION = set("article body div main section td".split())
ROOTS = {"html", "body", "main", "article"}
LEFT_OUT = set("head nav footer aside form button dialog menu fieldset".split())
# Words of class, id and role that mark a part as no article text.
MARKED = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies dialog disqus footer form login menu modal nav navbar navigation newsletter "
    "notice notices popup promo promotion related respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar".split()
)
# Only outside the article: inside it, such a part holds the article's own heading.
MARKED_OUTSIDE = {"header", "masthead"}
# A start tag on the left ends an open one on the right, unless a tag of the third set is nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
HEADING = re.compile(r"/h[1-6](/|$)")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
KERNEL = (0.25, 0.5, 0.25)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^<>]*>",
    re.S,
)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


@dataclass
class _Open:
    tag: str
    path: str
    section: int
    left_out: bool
    in_article: bool


@dataclass
class Node:
    path: str
    section: int
    block: int
    text: str


def _is_left_out(tag: str, rest: str, in_article: bool) -> bool:
    if tag in LEFT_OUT:
        return True
    if tag in ROOTS:
        return False
    if not in_article and tag == "header":
        return True
    if _HIDDEN.search(rest):
        return True
    marks = [m.group(2).strip("\"'").lower() for m in _MARK.finditer(rest)]
    words = {w for m in marks for w in _WORDS.split(m)}
    return not words.isdisjoint(MARKED) or (not in_article and not words.isdisjoint(MARKED_OUTSIDE))


def text_nodes(page: str) -> tuple[list[Node], list[int], set[int]]:
    """Text nodes outside the parts left out, in page order; for each section the one around it; those that are articles."""
    root = _Open("", "", 0, False, False)
    stack, around, nodes, articles = [root], [0], [], set()
    at = block = 0

    def text(raw: str) -> None:
        top = stack[-1]
        if raw and not top.left_out:
            nodes.append(Node(top.path, top.section, block, html.unescape(raw)))

    def pop_to(tags: set[str], stop: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    while True:
        found = _MARKUP.search(page, at)
        text(page[at : found.start() if found else len(page)])
        if not found:
            return nodes, around, articles
        at = found.end()
        if found["tag"] is None:
            continue
        tag, rest = found["tag"].lower(), found["rest"]
        if tag not in INLINE:
            block += 1
        if found["end"]:
            pop_to({tag}, set() if tag in ROOTS or tag in SECTION else {"td", "th"} - {tag})
            continue
        if tag in ENDS_PARAGRAPH:
            pop_to({"p"}, SECTION | {"li", "th", "blockquote", "button"})
        if tag in CLOSES:
            pop_to(*CLOSES[tag])
        if tag in VOID:
            continue
        if tag in RAW and not rest.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        top = stack[-1]
        section = top.section
        if tag in SECTION:
            around.append(section)
            section = len(around) - 1
            if tag in ("article", "main"):
                articles.add(section)
        in_article = top.in_article or tag in ("article", "main")
        left_out = top.left_out or _is_left_out(tag, rest, top.in_article)
        stack.append(_Open(tag, f"{top.path}/{tag}", section, left_out, in_article))


def _smooth(values: list[float]) -> list[float]:
    padded = [values[0], *values, values[-1]]
    return [sum(w * padded[i + k] for k, w in enumerate(KERNEL)) for i in range(len(values))]


def content_paths(nodes: list[Node]) -> set[str]:
    """Paths whose smoothed, fused ratio of text and punctuation reaches the threshold.

    The threshold is the smaller of the standard deviation and the mean of the paths' scores,
    so that a page with one kind of path keeps it.
    """
    sums: dict[str, list[float]] = defaultdict(lambda: [0, 0, 0])
    for node in nodes:
        own = sums[node.path]
        own[0] += 1
        own[1] += len(node.text.strip())
        own[2] += len(PUNCTUATION.findall(node.text))
    length = _smooth([sums[n.path][1] / sums[n.path][0] for n in nodes])
    marks = _smooth([sums[n.path][2] / sums[n.path][0] for n in nodes])
    fused: dict[str, float] = defaultdict(float)
    for node, a, b in zip(nodes, length, marks, strict=True):
        fused[node.path] += a * (1 + b) / sums[node.path][0]
    mean = sum(fused.values()) / len(fused)
    spread = math.sqrt(sum((v - mean) ** 2 for v in fused.values()) / len(fused))
    # Something must be above the threshold, whatever rounding does.
    threshold = min(mean, spread, max(fused.values()))
    return {path for path, score in fused.items() if score >= threshold}


def main_text(page: str | None) -> str:
    nodes, around, articles = text_nodes(page or "")
    filled = [n for n in nodes if n.text.strip()]
    if not filled:
        return ""
    paths = content_paths(filled)
    weight: dict[int, int] = defaultdict(int)
    for node in filled:
        if node.path in paths:
            weight[node.section] += len(node.text)
    # Content in each section and those inside it; a section comes after the one around it.
    held = [weight.get(section, 0) for section in range(len(around))]
    for section in range(len(around) - 1, 0, -1):
        held[around[section]] += held[section]
    innermost = max(section for section, w in enumerate(held) if w == held[0])
    # What lies in an article with content, or in a section with a fair part of it, belongs to it.
    most = max(weight.values())
    whole, within = [], []
    for section, parent in enumerate(around):
        fair = 4 * weight.get(section, 0) >= most or (section in articles and held[section] > 0)
        whole.append(fair or (section > 0 and whole[parent]))
        within.append(section == innermost or (section > 0 and within[parent]))

    def belongs(node: Node) -> bool:
        if whole[node.section] or weight.get(node.section):
            return True
        return within[node.section] and held[node.section] > 0 and HEADING.search(node.path) is not None

    out, block = [], None
    for node in nodes:
        if belongs(node):
            if node.block != block:
                out.append([])
                block = node.block
            out[-1].append(node.text)
    return " ".join(t for t in (" ".join("".join(parts).split()) for parts in out) if t)


def extract_text(pages: DataFrame, key_cols: list[str], html_col: str = "html") -> DataFrame:
    """`key_cols`, renamed k0, k1, ..., and `text` of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            last = rows.num_columns - 1
            texts = pa.array([main_text(p) for p in rows.column(last).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(last)), texts], names=[*(f"k{i}" for i in range(last)), "text"]
            )

    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)]
    rows = pages.select(*keys, F.col(html_col).alias("html"))
    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes[:-1])
    return rows.mapInArrow(extract, f"{schema}, text string")
