"""Main text of web pages: the maximum-scoring run of words and tags.

A page is a sequence of tokens. Words score positive and tags negative, by weights from
labelled pages: how much more often a kind of token stands inside the marked main part
than outside. One linear scan finds the contiguous run with the largest sum; its words
are the main text. Elements that never are text of the article (scripts, menus, forms,
comments of readers and so on) are left out wherever they stand.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_batches, by_value, hash_sample, text_of

by_value(__name__)

#: Weights are learnt from at most so many pages, in the order of a hash of the page, that
#: mark their main part with an element of LABELS and have at most SAMPLE_CHARS characters.
SAMPLE_PAGES = 1_000
SAMPLE_CHARS = 100_000

#: Element names of HTML.
LABELS = {"article", "main"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
BOILERPLATE = {
    "aside", "button", "canvas", "dialog", "footer", "form", "head", "header", "menu", "nav", "object",
    "option", "select", "svg", "audio", "video", "embed",
} | RAW
#: Words in a class, id or role that name what is not the article.
MARKS = {
    "ad", "ads", "adbox", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "header", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promotion",
    "related", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
    "complementary", "contentinfo", "respond", "replies", "disqus", "toolbar", "widget",
}

#: Words that say where or what kind of box, and nothing of what is in it.
BOXES = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "column", "container",
    "content", "form", "full", "global", "group", "icons", "inline", "inner", "item", "items", "label",
    "large", "left", "link", "links", "list", "main", "message", "middle", "mobile", "outer", "page", "panel",
    "policy", "posts", "primary", "reader", "right", "secondary", "section", "signup", "site", "slot", "small",
    "text", "title", "top", "unit", "user", "wrap", "wrapper",
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|xmp|noembed|noframes)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r"(?:.*?</(?P=raw)\b[^>]*>|.*\Z)"
    r"|<(?P<close>/)?(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*+)(?:>|\Z)"
    r"|<(?:/[^a-z]|[!?])[^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")
JOINTS = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: Least cost of a tag and least value of a word; cost of crossing the mark of a main part.
LEAST = 0.01
BORDER = 50.0


@dataclass
class Block:
    """Words of one block, and the tags before them."""

    text: str
    words: int
    tags: list[str]
    parent: str
    inside: bool


@dataclass
class Weights:
    """Cost of a tag of each kind and value of a word by the element around it."""

    tags: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)

    def cost(self, block: Block) -> float:
        """Of the tags before the block. Where the page marks its main part, tags in it cost least."""
        if block.inside:
            return LEAST * len(block.tags)
        return sum(self.tags.get(t, 1.0) for t in block.tags)

    def value(self, block: Block) -> float:
        """Of the block's words."""
        each = self.words.get(block.parent, 0.5)
        return block.words * (max(0.5, each) if block.inside else each)


def is_boilerplate(name: str, attributes: str) -> bool:
    if name in BOILERPLATE:
        return True
    if name in LABELS or name in ("html", "body") or "=" not in attributes:
        return False
    named = " ".join(a or b or c for a, b, c in NAMED.findall(attributes))
    return any(map(is_mark, named.split()))


def is_mark(name: str) -> bool:
    """Whether a class, id or role says that this is not the article.

    All words of the name must: ``comment-list`` does, ``share-price`` speaks of prices.
    """
    words = set(WORDS.findall(JOINTS.sub("-", name).lower()))
    return not MARKS.isdisjoint(words) and words <= MARKS | BOXES


def blocks_of(page: str, whole: bool = False) -> list[Block]:
    """The page's blocks of text in order, those of boilerplate elements only if ``whole``."""
    blocks: list[Block] = []
    open_: list[str] = ["body"]
    skipped: list[str] = []  # open elements from the boilerplate one on
    parts: list[str] = []
    tags: list[str] = []
    at = labelled = 0

    def finish() -> None:
        nonlocal tags
        words = html.unescape("".join(parts)).split()
        parts.clear()
        if words:
            parent = next((n for n in reversed(open_) if n not in INLINE), "body")
            blocks.append(Block(" ".join(words), len(words), tags, parent, labelled > 0))
            tags = []

    for m in TOKEN.finditer(page):
        if not skipped and m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if m["raw"] and not skipped:
                finish()
            continue
        if skipped and name in LABELS and not m["close"] and not any(b.inside for b in blocks):
            skipped.clear()  # the main part does not lie inside an element left open
        if skipped:
            if m["close"]:
                if name in skipped:
                    del skipped[len(skipped) - 1 - skipped[::-1].index(name) :]
                elif name in open_ and name in ("body", "html", *LABELS):
                    skipped.clear()
            elif name not in EMPTY:
                skipped.append(name)
            if skipped or not m["close"] or name not in LABELS:
                continue
        if name not in INLINE:
            finish()
        skip = not m["close"] and not whole and is_boilerplate(name, m["attributes"])
        if not skip:
            tags.append(("/" if m["close"] else "") + name)
        if m["close"]:
            if name in open_[1:]:
                del open_[len(open_) - 1 - open_[::-1].index(name) :]
        elif skip:
            finish()
            if name not in EMPTY and not m["attributes"].rstrip().endswith("/"):
                skipped.append(name)
        elif name not in EMPTY:
            if name == "p" and open_[-1] == "p" or name == "li" and open_[-1] == "li":
                open_.pop()
            open_.append(name)
        labelled = sum(n in LABELS for n in open_)
    if not skipped:
        parts.append(page[at:])
    finish()
    return blocks


def main_text(page: str, weights: Weights) -> str:
    """Words of the run of blocks and tags with the largest score, found in one scan."""
    blocks = blocks_of(page)
    best = score = 0.0
    first, chosen = 0, (0, 0)
    for i, block in enumerate(blocks):
        score -= weights.cost(block)
        if i and block.inside != blocks[i - 1].inside:
            score -= BORDER
        if score <= 0:
            score, first = 0.0, i
        score += weights.value(block)
        if score > best:
            best, chosen = score, (first, i + 1)
    return " ".join(b.text for b in blocks[slice(*chosen)])


def learn(pages: list[str]) -> Weights:
    """Weights from pages that mark their main part; without any, all words and tags weigh alike.

    A tag costs the more the likelier it stands outside the main part, a word is worth
    the more the likelier its kind of element stands inside; neither changes its sign.
    """
    counts = {True: (Counter(), Counter()), False: (Counter(), Counter())}
    for page in pages:
        for block in blocks_of(page, whole=True):
            counts[block.inside][0].update(block.tags)
            counts[block.inside][1][block.parent] += block.words

    def odds(i: int, kind: str) -> float:
        return math.log((counts[True][i][kind] + 1) / (counts[False][i][kind] + 1))

    weights = Weights()
    for kind in counts[True][0] | counts[False][0]:
        # A tag of the main part costs next to nothing, one of the rest a few words.
        weights.tags[kind] = min(3.0, max(LEAST, -odds(0, kind)))
    for kind in counts[True][1] | counts[False][1]:
        weights.words[kind] = 0.05 + max(0.0, odds(1, kind)) / 4
    return weights


def train(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from a bounded sample of the pages that mark their main part."""
    page = F.col(html_col)
    marked = page.rlike(r"(?i)<(article|main)\b") & (F.length(page) <= SAMPLE_CHARS)
    marked_pages = pages.where(marked)
    return learn(hash_sample(marked_pages, html_col, SAMPLE_PAGES, marked_pages.count()))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points).

    Character references are decoded; white space inside a block becomes one space, and
    blocks are joined by one space in page order. NULL, empty and textless pages give an
    empty text. Whole pages are read, of any length. A page's tokens are looked at once.
    """
    by_batches(pages.sparkSession)
    weights = train(pages, html_col)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p, weights) for p in batch.to_pylist()], pa.string())

    text = F.arrow_udf(run, "string")(text_of(F.col(html_col)))
    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text.alias("text")
    ).withColumn("n_chars", F.length("text").cast("bigint"))
