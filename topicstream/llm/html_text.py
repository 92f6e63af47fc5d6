"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block-level element, with blank lines where a container begins or ends; lines that are mostly links
count as blank. The text lengths of ``window`` consecutive lines are
summed. The main text begins where this sum surges from zero and ends where it dives back to zero; of the stretches found,
those before the first and after the last one whose peak is not far below the highest are left out, but for a heading right before the first. All text
between a surge and its dive is kept. ``article`` and ``main`` are hints: if a stretch with a high peak lies in such an element, the stretches of that
element are the text, whatever their peaks, and if none does, the element means nothing.

Scripts, forms, menus and other elements that are no article by their tag leave blank lines, and so do those that say so by a role or by a
class or id made of such words only ("ad-slot", "site-footer", not "has-sidebar" or "related-work"). An element that turns out to hold an
``article`` or ``main`` is not left out from there on.

Defined results: null or empty html, or html without text, gives an empty text. Markup that is cut off at the end is dropped,
unclosed elements end with the page. Pages of any length are read whole, in one pass. Extra columns are ignored and repeated rows are extracted one by one.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from topicstream.llm.common import map_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset(
    "script style noscript template textarea title head nav footer aside form button select option label iframe object svg canvas dialog menu".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
ARTICLE = frozenset("article main".split())
CONTAINER = frozenset("div section article main header table ul ol dl body center figure details".split())
IMPLICIT = frozenset("p li dt dd td th tr".split())  # their start tag ends an open one of the same name
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|menu\w*|nav|navbar|navigation"
    r"|breadcrumbs?|sidebar\w*|footer|masthead|comments?|replies|disqus|share|sharing|social|related|newsletter|subscribe|widgets?|login"
    r"|signup|search|pagination|pager|toolbar|skip",
    re.I,
)
# words that say where an element is or what shape it has, and nothing about what it holds
SHAPE = re.compile(r"site|top|bottom|left|right|box|bar|block|lists?|wrap(?:per)?|container|area|section|inner|outer|slot|unit|links?|buttons?|icons?|posts?|main|primary|secondary|\d*", re.I)


@dataclass(frozen=True)
class Settings:
    window: int = 3
    peak_share: float = 0.2  # of the highest peak
    enough: int = 80  # a peak of so many characters always counts
    link_share: float = 0.6
    names: bool = True  # roles, classes and ids may leave an element out


@dataclass
class Line:
    text: str
    linked: int
    article: int  # number of the outermost article around it, 0 for none
    heading: bool = False


def named_other(value: str) -> bool:
    """Is one of the names in a class or id made of other-content words and words of shape only?"""
    for name in value.split():
        words = re.split(r"[_-]+", name)
        found = [bool(OTHER.fullmatch(w)) for w in words]
        if any(found) and all(f or SHAPE.fullmatch(w) for f, w in zip(found, words, strict=True)):
            return True
    return False


def is_other(name: str, attributes: str, in_article: bool, names: bool = True) -> bool:
    """Does the element say that it is no part of an article?"""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not attributes or name in ("body", "html") or name in ARTICLE:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if names and (key in ("class", "id") and named_other(value) or key == "role" and value.lower() in ROLES):
            return True
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def page_lines(page: str, settings: Settings) -> list[Line]:
    """The page as lines of text and blank lines."""
    lines: list[Line] = []
    parts: list[str] = []
    linked = links = 0
    article = articles = 0
    dropping: str | None = None  # name of the element being left out, and how many of the name are open
    depth = at = 0
    heading = False

    def end_line(gap: int = 0) -> None:
        nonlocal linked, heading
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append(Line(text, linked, articles if article else 0, heading))
            heading = False
        lines.extend(Line("", 0, articles if article else 0) for _ in range(gap))
        parts.clear()
        linked = 0

    def gap_of(name: str) -> int:
        """Blank lines at either end: two containers side by side are further apart than a window is long."""
        return settings.window if name in ARTICLE else (settings.window + 1) // 2 if name in CONTAINER else 0

    def add(text: str) -> None:
        nonlocal linked
        if dropping is None and text:
            parts.append(text)
            linked += len(text) if links else 0

    while found := TOKEN.search(page, at):
        add(page[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["end"]:
            if dropping is not None:
                depth -= name == dropping
                if depth == 0 or name in ("body", "html"):
                    dropping = None
                    end_line(settings.window)
            elif name == "a":
                links = max(0, links - 1)
            elif name not in INLINE:
                end_line(gap_of(name))
                heading = False
                article = max(0, article - (name in ARTICLE))
            continue
        closed = found["attributes"].rstrip().endswith("/") or name in VOID
        if name in RAW and not closed:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            at = stop.end()
            if dropping is None:
                end_line() if name not in INLINE else None
            continue
        if dropping is not None and name in ARTICLE:
            dropping = None  # what holds an article is not left out
        if dropping is not None:
            implied = dropping in IMPLICIT and name not in INLINE and depth == 1
            if not implied:
                depth += name == dropping and not closed
                continue
            dropping = None  # an unclosed paragraph ends at the next block
        if not closed and is_other(name, found["attributes"], article > 0, settings.names):
            if name not in INLINE:
                end_line(settings.window)
            dropping, depth = name, 1
        elif name == "a":
            links += not closed
        elif name not in INLINE:
            end_line(gap_of(name))
            heading = name in HEADING
            links = 0
            articles += name in ARTICLE and not article
            article += name in ARTICLE
    add(page[at:])
    end_line()
    return lines


def stretches(sizes: list[int], window: int) -> list[tuple[int, int, int]]:
    """Surge and dive points: (first line, line after the last one, highest window sum) of every stretch."""
    found, start, peak = [], None, 0
    padded = sizes + [0] * window
    total = sum(padded[: window - 1])
    for i in range(len(sizes)):
        total += padded[i + window - 1]
        if padded[i] and start is None:  # surge
            start, peak = i, 0
        if start is not None:
            peak = max(peak, total)
            if total == 0:  # dive
                found.append((start, i, peak))
                start = None
        total -= padded[i]
    if start is not None:
        found.append((start, len(sizes), peak))
    return found


def kept_lines(lines: list[Line], settings: Settings) -> list[Line]:
    """The lines between the surge and dive points that hold the main text."""
    sizes = [len(x.text) if x.linked < settings.link_share * len(x.text) else 0 for x in lines]
    found = stretches(sizes, settings.window)
    top = max((p for _, _, p in found), default=0)
    high = [k for k, (_, _, p) in enumerate(found) if p >= min(settings.enough, settings.peak_share * top)]
    marked = {lines[found[k][0]].article for k in high if found[k][2] >= settings.peak_share * top} - {0}
    if marked:  # an article begins and ends far from other lines, so no stretch crosses its ends
        return [x for x in lines if x.article in marked and x.text]
    if not high:
        return []
    first, last = high[0], high[-1]
    if first and all(x.heading for x in lines[slice(*found[first - 1][:2])] if x.text):
        first -= 1
    return [x for a, b, _ in found[first : last + 1] for x, n in zip(lines[a:b], sizes[a:b], strict=True) if n]


def main_text(page: str, settings: Settings = Settings()) -> str:
    """The main text of one page."""
    return " ".join(x.text for x in kept_lines(page_lines(page, settings), settings))


def extract(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``pages`` (page_id, url, html) to page_id, url, text, n_chars."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def transform(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x, settings) if x else "" for x in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": list(map(len, texts))}

    return map_batches(pages.select("page_id", "url", "html"), transform, f"page_id {kind}, url string, text string, n_chars long")
