"""Main text of web pages by line-block distribution.

Markup is stripped to lines: every block element and every piece of boilerplate
(navigation, headers, footers, asides, forms, scripts, styles, and containers
whose class or id names an advert, notice, sidebar, menu or comments) ends a
line; boilerplate lines have no length. A class or id counts as a whole name,
and drops no container that holds the page's marked article or most of its text.
Lengths are summed over sliding windows of ``WINDOW`` lines. The text surges
where the sums rise to the threshold after a window below it, and dives where
they fall to zero; the lines between are kept, and with them the lines right
before the surge that are not links.

Marks of an article weigh the lines: one inside counts ``SURGE`` at least, so
short paragraphs and short articles stay whole; one outside counts the less the
more of the page's text is marked, and surges at ``SURGE`` a line of the window.
So a whole article leaves nothing else of its page, and a small marked card does
not hide a text beside it.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by an empty line. Null or empty html, and a page without text,
give an empty text. Broken markup (unclosed elements, cut-off tags) is read as
far as it goes. Rows that repeat an id are rows of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import text_chunks, texts

WINDOW = 3
SURGE = 60  # characters in a window

# Element names by their part in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object")
BOILERPLATE = frozenset(
    "nav header footer aside form button select menu dialog fieldset label head".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 "
    "hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = BLOCKS | BOILERPLATE - {"label", "button", "select"}
NAMES = re.compile(
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar\w*|widgets?|menu\w*|nav\w*|"
    r"breadcrumbs?|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|"
    r"login|search|comments?|commentlists?|respond|replies|reply|disqus|discussion|share|sharing|social|related|recommend\w*|"
    r"footer|masthead|topbar|toolbar|pagination|pager|copyright|disclaimer",
    re.I,
)
# What may stand beside such a word in a name; any other word gives the name another meaning.
BESIDE = frozenset(
    "site page main top bottom left right primary secondary global mobile header side skip bar box list container "
    "wrapper area section block link links button buttons icons item items inner outer post posts article "
    "articles policy unit slot row column panel group form user users reader readers thread".split()
)
PAIRS = frozenset(("side-bar", "skip-link", "side-rail", "left-rail", "right-rail"))
MOST_TEXT = 0.5  # a container with more of the page's text stays,
MOST_BESIDE_ARTICLE = 0.9  # or with more than this where an article is marked elsewhere
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())

# As browsers read a tag: a quotation mark opens a value only right after the equals
# sign and if another one closes it; elsewhere it is a character like any other.
ATTRIBUTE_NAME = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|["'][^\s>]*+)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    rf"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[\s/]++|{ATTRIBUTE_NAME}(?:\s*+=\s*+{VALUE}?+)?+)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(rf"""({ATTRIBUTE_NAME})(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
SPACES = re.compile(r"\s+")


@dataclass
class Line:
    text: str
    inside: int  # how many open elements mark the article
    named: tuple[int, ...] = ()  # numbers of the open containers named like boilerplate
    gap: bool = False  # stands where boilerplate was left out
    link: bool = False  # all of its text is links


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _is_boilerplate(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name == "header" and in_article:  # holds the article's own heading
        return False
    if name in BOILERPLATE or "hidden" in attributes:
        return True
    if not attributes or name in ("body", "html", "article", "main"):
        return False
    return attributes.get("role", "").lower() in ROLES


def _is_named_boilerplate(attributes: dict[str, str]) -> bool:
    """Whether a whole class name or the id says boilerplate."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
        named = [w for w in words if NAMES.fullmatch(w)]
        if name in PAIRS or named and all(w in named or w in BESIDE for w in words):
            return True
    return False


def _marks_article(name: str, attributes: dict[str, str]) -> bool:
    return (
        name in ("article", "main")
        or attributes.get("role", "").lower() in ("article", "main")
        or attributes.get("itemprop", "").lower() == "articlebody"
    )


def lines_of(html: str) -> list[Line]:
    """The page's lines in order; a line without text stands where boilerplate was left out."""
    lines: list[Line] = []
    pieces: list[str] = []
    plain = False  # whether a piece of the line is no link
    stack: list[tuple[str, bool, bool, bool]] = []  # name, boilerplate, marks the article, named
    named: tuple[int, ...] = ()
    dropped = articles = containers = links = 0

    def add(piece: str) -> None:
        nonlocal plain
        pieces.append(piece)
        plain = plain or not links and any(c.isalnum() for c in piece)

    def close_line(gap: bool = False) -> None:
        nonlocal plain
        text = SPACES.sub(" ", unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            lines.append(Line(text, articles, named, link=not plain))
        plain = False
        if gap:
            lines.append(Line("", articles, named, True))

    def leave(count: int) -> None:
        nonlocal dropped, articles, named, links
        for _ in range(count):
            name, boilerplate, article, container = stack.pop()
            links -= name == "a"
            if container:
                close_line()
                named = named[:-1]
            dropped -= boilerplate
            articles -= article

    at = 0
    while at < len(html):
        token = TOKEN.search(html, at)
        if token is None:
            if not dropped:
                add(html[at:])
            break
        if not dropped:
            add(html[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            if token[0].startswith("<![CDATA[") and not dropped:
                add(token[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if token["close"]:
            place = next((n for n in range(len(stack) - 1, -1, -1) if stack[n][0] == name), None)
            if place is not None:
                if name in BLOCKS or any(s[1] or s[3] or s[0] in BLOCKS for s in stack[place:]):
                    close_line()
                leave(len(stack) - place)
            elif name in BLOCKS:
                close_line()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>|\Z", re.I).search(html, at)
            at = end.end()
            continue
        if name == "br":
            if not dropped:
                pieces.append(" ")
            continue
        if name in ENDS_PARAGRAPH:
            place = next((n for n in range(len(stack) - 1, -1, -1) if stack[n][0] in ("p", *BLOCKS, *BOILERPLATE)), None)
            if place is not None and stack[place][0] == "p" and not stack[place][1]:
                leave(len(stack) - place)
            close_line()
        elif name in BLOCKS or name in BOILERPLATE:
            close_line()
        if name in VOID or token["attributes"].endswith("/"):
            continue
        attributes = _attributes(token["attributes"])
        boilerplate = _is_boilerplate(name, attributes, articles > 0)
        if boilerplate and not dropped:
            close_line(gap=True)
        article = _marks_article(name, attributes) and not (dropped or boilerplate)
        container = not (dropped or boilerplate or article or name in ("body", "html")) and _is_named_boilerplate(attributes)
        if container:
            close_line()
            containers += 1
            named = (*named, containers)
            lines.append(Line("", articles, named))
        stack.append((name, boilerplate, article, container))
        dropped += boilerplate
        articles += article
        links += name == "a"
    close_line()
    return _without_named(lines) if containers else lines


def _without_named(lines: list[Line]) -> list[Line]:
    """The lines without the containers named like boilerplate, but for those with the article or most text."""
    total = sum(len(x.text) for x in lines)
    elsewhere = sum(len(x.text) for x in lines if x.inside and not x.named)
    sizes: dict[int, list[int]] = {}  # marks around it, characters, those of articles marked in it
    for line in lines:
        for container in line.named:
            size = sizes.setdefault(container, [line.inside, 0, 0])
            size[1] += len(line.text)
            size[2] += len(line.text) * (line.inside > size[0])
    most = MOST_BESIDE_ARTICLE if elsewhere else MOST_TEXT
    dropped = {
        container
        for container, (_, size, marked) in sizes.items()
        if size <= most * total and (marked <= elsewhere or not marked)
    }
    left = []
    for line in lines:
        border = not line.text and not line.gap  # of the innermost container
        if not dropped.isdisjoint(line.named[:-1] if border else line.named):
            continue
        if not border or line.named[-1] in dropped:
            left.append(line)
    return left


def weights_of(lines: list[Line], surge: int = SURGE) -> np.ndarray:
    """Lengths of the lines, raised inside a marked article, lowered outside by its share of the text."""
    lengths = np.array([len(x.text) for x in lines], float)
    inside = np.array([x.inside > 0 for x in lines])
    share = lengths[inside].sum() / max(lengths.sum(), 1)
    raised = np.where(lengths > 0, np.maximum(lengths, surge), 0)
    return np.where(inside, raised, lengths * (1 - share) ** 2)


def kept_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between surge and dive of the windows' weights."""
    if not lines:
        return []
    weights = weights_of(lines, surge)
    marked = any(line.inside and line.text for line in lines)
    kept = np.zeros(len(lines), bool)
    # no window reaches over the border of a marked article
    borders = [n for n in range(1, len(lines)) if (lines[n].inside > 0) != (lines[n - 1].inside > 0)]
    for first, last in zip([0, *borders], [*borders, len(lines)], strict=True):
        sums = np.convolve(weights[first:last], np.ones(window))[window - 1 :]  # lines i .. i + window - 1
        beside = marked and not lines[first].inside
        threshold = window * surge if beside else max(min(surge, sums.max()), 1)
        at, size = 0, last - first
        while at < size:
            if sums[at] < threshold:
                at += 1
                continue
            start = end = at
            while start and (before := lines[first + start - 1]).text and not before.link:
                start -= 1
            while end < size and sums[end] > 0:
                end += 1
            kept[first + start : first + min(end + window - 1, size)] = True
            at = end
    return [x.text for x, keep in zip(lines, kept, strict=True) if keep and x.text]


def main_text(html: str) -> str:
    return "\n\n".join(kept_lines(lines_of(html)))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, "html"):
        found = [main_text(h) for h in texts(batch, "html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(found, pa.string()),
                pa.array(map(len, found), pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), "url", F.col(html_col).alias("html")
    )
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
