"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat run of text blocks. A block is described by its words and the share
of them in links, the same of the blocks before and after it, and by where the markup puts
it: inside furniture (menus, adverts, forms, comments), inside the article, or neither.
Names and forms are weak signs, as a layout's wrapper may bear such a name: what is
inside as many of them as most of the article is, or of the text, is not furniture. A decision tree over these, grown from the small labelled table
below, says which blocks are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements that end a block, hold no text, or hold none of the page's.
BLOCKS = frozenset(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu "
    "nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
FURNITURE = frozenset("aside audio button canvas dialog fieldset footer head iframe menu nav search select video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words in class and id by which authors name furniture, and the article.
NAMES = (
    r"(?:ads?|adverts?|advertisements?|advertising|adsense|banner|breadcrumbs?|comments?|commentlist|consent|"
    r"cookies?|copyright|disclaimer|disqus|footer|gdpr|header|login|masthead|menu|menus|modal|nav|navbar|navigation|"
    r"newsletter|notice|notification|pager|pagination|popup|promo|promoted|recommended|related|replies|reply|respond|"
    r"share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|subscription|tagcloud|toolbar|topbar|"
    r"widget|widgets)"
)
# Whole tokens: words around the name that say where or what it is, but not has-sidebar or sticky-header.
FURNITURE_NAME = re.compile(
    r"(?:^|\s)(?:(?:article|blog|bottom|desktop|entry|global|left|main|mobile|page|post|posts|primary|right|secondary|"
    r"site|top|user)[_-]+)*"
    rf"{NAMES}\d*(?:[_-]+(?:{NAMES}\d*|area|bar|block|body|bottom|box|button|buttons|form|icons|inner|item|items|left|"
    r"link|links|list|message|overlay|right|section|text|thread|title|top|\d\w*))*(?=$|\s)",
    re.I,
)
ARTICLE_NAME = re.compile(r"(?:^|[\s_-])(?:article|story|post|entry)(?:[\s_-]?(?:body|content|text))?(?=$|\s)", re.I)

# Raw text ends only at its own end tag. A tag may hold '>' in quotes.
MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(script|style|textarea|title|xmp)(?=[\s/>])[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.I | re.S,
)
# Elements that are left out whole. Without an end tag they hold nothing, as does <svg/>.
UNSHOWN = {
    name: re.compile(
        rf"<!--.*?(?:--!?>|\Z)|<(/?){name}(?=[\s/>])((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.I | re.S
    )
    for name in ("svg", "math", "object", "noscript", "template")
}
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

PLAIN, CHROME, MAIN = 0, 1, 2

# The labelled table: pages as runs of (words, words in links, place, 1 for main text).
LABELLED = (
    ((6, 6, CHROME, 0), (9, 0, CHROME, 0), (7, 0, MAIN, 1), (62, 0, MAIN, 1), (3, 0, MAIN, 1), (12, 0, CHROME, 0)),
    ((1, 1, CHROME, 0), (1, 1, CHROME, 0), (2, 2, CHROME, 0), (11, 0, MAIN, 1), (240, 4, MAIN, 1), (8, 1, CHROME, 0)),
    ((14, 0, CHROME, 0), (1, 0, MAIN, 1), (2, 0, MAIN, 1), (30, 0, MAIN, 1), (45, 0, CHROME, 0), (3, 3, CHROME, 0)),
    ((80, 0, CHROME, 0), (150, 0, MAIN, 1), (6, 6, MAIN, 1), (90, 10, MAIN, 1), (70, 0, CHROME, 0)),
    ((3, 3, PLAIN, 0), (2, 2, PLAIN, 0), (8, 0, PLAIN, 1), (55, 2, PLAIN, 1), (72, 0, PLAIN, 1), (4, 4, PLAIN, 0)),
    ((1, 1, PLAIN, 0), (1, 1, PLAIN, 0), (40, 0, PLAIN, 1), (6, 0, PLAIN, 1), (36, 1, PLAIN, 1), (2, 2, PLAIN, 0)),
    ((5, 5, PLAIN, 0), (4, 0, PLAIN, 0), (3, 3, PLAIN, 0), (9, 9, PLAIN, 0), (25, 0, PLAIN, 1), (28, 3, PLAIN, 1)),
    ((20, 19, PLAIN, 0), (120, 5, PLAIN, 1), (18, 0, PLAIN, 1), (15, 0, PLAIN, 1), (33, 0, PLAIN, 1), (16, 14, PLAIN, 0)),
    ((2, 0, PLAIN, 0), (3, 2, PLAIN, 0), (5, 1, PLAIN, 0), (4, 3, PLAIN, 0), (30, 28, PLAIN, 0)),
    # headings and short lines between long blocks; notices and comments without a name
    ((2, 2, PLAIN, 0), (5, 0, PLAIN, 1), (60, 0, PLAIN, 1), (3, 0, PLAIN, 1), (80, 1, PLAIN, 1), (4, 0, PLAIN, 1), (45, 0, PLAIN, 1)),
    ((1, 1, PLAIN, 0), (2, 0, PLAIN, 1), (20, 0, PLAIN, 1), (1, 0, PLAIN, 1), (18, 0, PLAIN, 1), (2, 0, PLAIN, 1), (17, 0, PLAIN, 1)),
    ((11, 0, PLAIN, 0), (3, 3, PLAIN, 0), (2, 2, PLAIN, 0), (52, 3, PLAIN, 1), (5, 0, PLAIN, 1), (38, 0, PLAIN, 1), (2, 2, PLAIN, 0)),
    ((64, 0, PLAIN, 1), (2, 2, PLAIN, 0), (14, 0, PLAIN, 0), (1, 1, PLAIN, 0), (2, 2, PLAIN, 0), (7, 0, PLAIN, 0), (1, 1, PLAIN, 0)),
    ((16, 0, PLAIN, 0), (1, 1, PLAIN, 0), (3, 3, PLAIN, 0), (90, 2, PLAIN, 1), (1, 1, PLAIN, 0), (9, 0, PLAIN, 0), (1, 1, PLAIN, 0)),
    ((66, 0, PLAIN, 1), (13, 0, PLAIN, 1), (2, 2, PLAIN, 0), (2, 2, PLAIN, 0), (48, 1, PLAIN, 1), (6, 0, PLAIN, 1), (3, 3, PLAIN, 0)),
    ((5, 5, CHROME, 0), (4, 0, MAIN, 1), (6, 6, MAIN, 1), (41, 0, MAIN, 1), (8, 0, MAIN, 1), (3, 3, CHROME, 0)),
    ((2, 2, CHROME, 0), (12, 0, MAIN, 1), (2, 2, MAIN, 1), (5, 0, MAIN, 1), (1, 1, CHROME, 0)),
    ((50, 0, PLAIN, 1), (1, 0, PLAIN, 1), (28, 0, PLAIN, 1), (2, 2, PLAIN, 0), (1, 1, PLAIN, 0), (32, 1, PLAIN, 1), (4, 4, PLAIN, 0)),
    ((43, 0, PLAIN, 1), (1, 0, PLAIN, 1), (10, 0, PLAIN, 1), (2, 2, PLAIN, 0), (3, 3, PLAIN, 0), (15, 0, PLAIN, 0), (2, 2, PLAIN, 0)),
    ((30, 0, PLAIN, 1), (1, 0, PLAIN, 1), (7, 0, PLAIN, 1), (5, 5, PLAIN, 0)),
    ((35, 0, PLAIN, 1),), ((9, 0, MAIN, 1),), ((5, 5, PLAIN, 0),), ((12, 0, PLAIN, 1),), ((22, 0, CHROME, 0),),
)


def described(blocks: list[tuple[int, int, int]]) -> list[tuple[float, ...]]:
    """(words, link density, both of the block before, both of the one after, furniture, article) of each block."""
    flat = [(float(n), in_links / n) for n, in_links, _ in blocks]
    edge = [(0.0, 0.0)]
    return [
        (*own, *before, *after, float(place == CHROME), float(place == MAIN))
        for own, before, after, (_, _, place) in zip(flat, edge + flat[:-1], flat[1:] + edge, blocks)
    ]


def grown(rows: np.ndarray, labels: np.ndarray):
    """Decision tree by Gini impurity: a label, or (feature, threshold, at most, above)."""
    if len(set(labels.tolist())) == 1:
        return int(labels[0])
    best = None
    for feature in (6, 7, 0, 1, 2, 3, 4, 5):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= threshold
            share = [(part.mean(), len(part)) for part in (labels[low], labels[~low])]
            impurity = sum(n * p * (1 - p) for p, n in share)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(threshold), low)
    if best is None:
        return int(labels.mean() >= 0.5)
    _, feature, threshold, low = best
    return feature, threshold, grown(rows[low], labels[low]), grown(rows[~low], labels[~low])


@cache
def tree(labelled: tuple = LABELLED):
    """The tree of a labelled table."""
    rows = [r for page in labelled for r in described([b[:3] for b in page])]
    return grown(np.array(rows), np.array([b[3] for page in labelled for b in page]))


def chosen(node, row: tuple[float, ...]) -> int:
    while not isinstance(node, int):
        feature, threshold, low, high = node
        node = low if row[feature] <= threshold else high
    return node


def place_of(name: str, attributes: str, around: int) -> tuple[int, bool]:
    """Where an element puts its text: what it says itself, or else what is around it; and
    whether its name, or being a form, says that it is furniture."""
    if around == CHROME or name in FURNITURE:
        return CHROME, False
    given = {}
    if "=" in attributes or "hidden" in attributes:
        given = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    role = given.get("role", "").lower()
    if role in ROLES - {"form"} or "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN.search(given.get("style", "")):
        return CHROME, False
    names = f"{given.get('class', '')} {given.get('id', '')}"
    article = name in ("article", "main") or role in ("article", "main")
    weak = name == "form" or role == "form" or bool(FURNITURE_NAME.search(names))
    if weak and name not in ("body", "html", "main") and role != "main":
        return PLAIN, True
    if article or ARTICLE_NAME.search(names):
        return MAIN, False
    if name == "header" and around != MAIN:  # a page's header, not an article's
        return CHROME, False
    return around, False


def settled(flat: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """The blocks without how many weak signs they are inside: those inside more than most
    of the article is, or of the text if there is no article, are furniture."""
    if not any(depth for *_, depth in flat):
        return [b[:4] for b in flat]
    said: dict[int, Counter[int]] = {MAIN: Counter(), PLAIN: Counter(), CHROME: Counter()}
    for _, n, in_links, place, depth in flat:
        said[place][depth] += n - in_links
    words = said[MAIN] or said[PLAIN]
    most = max(sorted(words), key=words.__getitem__, default=0)
    return [(*b[:3], b[3] if b[4] <= most else CHROME) for b in flat]


def ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by where they begin; those without an end tag are not in it."""
    begun, out = [], {}
    for tag in UNSHOWN[name].finditer(page):
        if tag[1]:
            if begun:
                out[begun.pop()] = tag.end()
        elif tag[2] and not (name in ("svg", "math") and tag[2].endswith("/>")):
            begun.append(tag.start())
    return out


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, place) of the page's text blocks, in order."""
    out: list[tuple[str, int, int, int, int]] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, int]] = [("", PLAIN, 0)]  # element, place, weak signs of furniture so far
    opened: Counter[str] = Counter()
    unshown: dict[str, dict[int, int]] = {}
    link, at = 0, 0

    def end() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                in_links = len(html.unescape("".join(linked)).split()) if linked else 0
                out.append((" ".join(words), len(words), min(in_links, len(words)), *stack[-1][1:]))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece:
            text.append(piece)
            if link:
                linked.append(piece)

    while tag := MARKUP.search(page, at):
        add(page[at : tag.start()])
        at = tag.end()
        name = (tag[3] or tag[6] or "").lower()
        if not name:
            continue
        closing = bool(tag[2] or tag[5])
        if name in UNSHOWN:
            if not closing:
                if name not in unshown:
                    unshown[name] = ends(page, name)
                at = unshown[name].get(tag.start(), at)
            continue
        if name in ("br", "img", "wbr"):
            add(" " if name != "wbr" else "")
        elif name == "a":
            link = 0 if closing else 1
            linked.append(" ")
        if closing:
            if opened[name] or name in BLOCKS:
                end()
            while opened[name]:  # what is still open inside ends as well
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
        elif name not in VOID:
            if name in BLOCKS:
                end()
                link = 0
                if stack[-1][0] in ("p", "li", "dt", "dd", "option") and (name == stack[-1][0] or stack[-1][0] == "p"):
                    opened[stack.pop()[0]] -= 1
            place, weak = place_of(name, tag[4] or tag[7] or "", stack[-1][1])
            if name in BLOCKS or weak or place != stack[-1][1]:
                end()
                stack.append((name, place, stack[-1][2] + weak))
                opened[name] += 1
        elif name == "hr":
            end()
    add(page[at:])
    end()
    return settled(out)


def main_text(page: str | None) -> str:
    """The main text of a page, blocks joined by an empty line; empty for null."""
    flat = blocks(page or "")
    own = tree()
    return "\n\n".join(b[0] for b, row in zip(flat, described([b[1:] for b in flat])) if chosen(own, row))


def extracted(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, text, n_chars (its code points).

    A null or empty page, or one without main text, has an empty text. Character
    references are decoded, runs of white space in a block are one space, and nothing is
    cut off. Null and repeated ids are kept. Other columns are left out.
    """
    kind, url = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                text = [main_text(page) for page in part["html"]]
                yield part[["id", "url"]].assign(text=text, n_chars=[len(t) for t in text])

    out = rows.mapInPandas(extract, f"id {kind}, url {url}, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
