"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. A line weighs the characters of its
text; link text weighs nothing outside of article elements. Lines of parts that are no
article (menus, footers, adverts, forms, comments …) weigh 0, and so do lines outside the
article elements of a page that has most of its text in them, or lines inside where the
text is elsewhere (comments and teasers can be articles). The sums over windows of lines
form a curve; the text between its surge and its dive is kept, without lines of weight 0.
Time and memory are linear in the page.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.batches import add_columns

#: Lines of a window; a surge or dive crosses this share of the largest window.
WINDOW, LEVEL = 3, 0.2
#: For the level, a line weighs at most so many times the median counting line.
CLIP = 3
#: A marked part with more than this share of the page's text is no mere page part.
MOST = 0.75
#: How many times more a character weighs in an article element when the side with the text is chosen.
FAVOUR = 3

# Fixed names of the HTML standard and usual names of page parts.
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style noscript template head title iframe object svg math canvas audio video select textarea button".split())
_RAW = frozenset("script style textarea title iframe noscript template".split())
_OTHER = frozenset("nav footer aside form dialog menu".split())
_MAIN = frozenset("article main".split())
_NAMES = re.compile(
    r"(?:ads?|adverts?|advertisements?|adbox|sponsor(?:ed)?|promo(?:tion)?|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|"
    r"nav|navbar|navigation|menus?|breadcrumbs?|header|masthead|footer|foot|sidebars?|side|widgets?|comments?|disqus|replies|respond|related|recommended|"
    r"share|sharing|social|newsletter|subscribe|signup|login|search|tags|pagination|pager|toolbar|skip|legal|copyright|disclaimer|hidden)\d*", re.I,
)
# With one of the names, these make a compound name such as ad-box or site-header.
_AFFIXES = frozenset("box bar block list area link links unit slot site main global top bottom left right primary secondary buttons form panel".split())
# After one of the names, these make one too, such as cookie-banner-wrap.
_WRAPS = frozenset("wrap wrapper inner outer body content container holder row section item items text message".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# An unpaired quote is a character like others, so that no tag is read twice.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s=\"'/>])([^\s=\"'/>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
# Items and what each closes.
_ITEMS = {"li": ("li",), "tr": ("tr",), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}


def _names_part(value: str, inside_main: bool) -> bool:
    """Whether a class or id token is a name of a page part, alone or in a compound of names and affixes."""
    for token in value.lower().split():
        parts = [x for x in re.split(r"[_-]+", token) if x]
        named = [bool(_NAMES.fullmatch(x)) for x in parts]
        if not any(named) or inside_main and {"header", "masthead"} & set(parts):
            continue
        first = named.index(True)
        if all(n or x in _AFFIXES or x in _WRAPS and i > first for i, (x, n) in enumerate(zip(parts, named))):
            return True
    return False


def _no_article(tag: str, attributes: str, inside_main: bool, inside_article: bool) -> str:
    """What opens a part that is no article: ``hidden``, ``part``, ``named`` if only a class or id says so,
    ``inner`` for an article inside an article; else empty."""
    found = "part" if tag in _OTHER or tag == "header" and not inside_main else "inner" if tag == "article" and inside_article else ""
    if not attributes or tag in ("html", "body"):
        return found
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "hidden"
        if name == "role" and value.lower() in _ROLES:
            found = "part"
        elif name in ("class", "id") and tag != "main" and found in ("", "inner") and _names_part(value, inside_main):
            found = "named"
    return "hidden" if "hidden" in _ATTRIBUTE.sub(" ", attributes).lower().replace("/", " ").split() else found


class Lines(NamedTuple):
    """The lines of a page: their text, characters of link text, and number of the innermost part and article (-1: none).

    ``outer`` gives the part around each part, ``above`` the article or main element around each of those.
    """

    texts: list[str]
    links: list[int]
    part: list[int]
    article: list[int]
    outer: list[int]
    above: list[int]
    kinds: list[str]
    holds: list[bool]


def page_lines(page: str) -> Lines:
    """Lines of a page, one per block element, in one pass whose time is linear in the page.

    ``br`` begins a new line too, though it is no block element.
    """
    out = Lines([], [], [], [], [], [], [], [])
    parts: list[str] = []
    links = 0
    stack: list[tuple[str, bool, bool]] = []  # tag, opens a part that is no article, opens an article
    places: dict[str, list[int]] = {}  # where each tag is open in the stack
    blocks: list[int] = []  # where block elements are open
    part = article = -1
    link = articles = 0
    unclosed: set[str] = set()
    at, skip_to = 0, 0

    def flush():
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                for column, value in zip(out, (text, links, part, article)):
                    column.append(value)
            parts.clear()
        links = 0

    def close(depth: int):
        nonlocal part, article, link, articles
        while len(stack) > depth:
            tag, opened, main = stack.pop()
            places[tag].pop()
            if tag not in _INLINE:
                blocks.pop()
            if opened:
                part = out.outer[part]
            if main:
                article = out.above[article]
                articles -= tag == "article"
            link -= tag == "a"

    for token in _TOKEN.finditer(page):
        if token.start() < skip_to:
            continue
        if token.start() > at:
            text = page[at : token.start()]
            parts.append(text)
            if link:
                links += len(text)
        at = token.end()
        tag = token[2]
        if not tag:
            continue
        tag = tag.lower()
        if token[1]:
            if tag not in _INLINE:
                flush()
            open_at = places.get(tag)
            # An inline end tag closes no block element that was left open around it.
            if open_at and (tag not in _INLINE or not blocks or open_at[-1] > blocks[-1]):
                close(open_at[-1])
            continue
        if tag in _RAW or tag in _HIDDEN and tag not in _VOID:
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            flush() if tag not in ("noscript", "script", "style") else None
            if not end:
                unclosed.add(tag)
            skip_to = at = end.end() if end else (len(page) if tag in _RAW else at)
            continue
        if tag not in _INLINE:
            flush()
        if blocks and (tag in _CLOSES_P or tag in _ITEMS):
            # A new block closes an open paragraph or item of the same list.
            if stack[blocks[-1]][0] in (("p",) if tag in _CLOSES_P else _ITEMS[tag]):
                close(blocks[-1])
        if tag in _VOID or token[3].endswith("/") and tag in ("hr", "img"):
            continue
        kind = _no_article(tag, token[3], article >= 0, articles > 0)
        main = tag in _MAIN
        if main:
            if kind:
                out.holds.append(True)
            elif part >= 0:
                out.holds[part] = True
            out.above.append(article)
            article = len(out.above) - 1
            articles += tag == "article"
        elif kind:
            out.holds.append(False)
        if kind:
            out.outer.append(part)
            out.kinds.append(kind)
            part = len(out.outer) - 1
        places.setdefault(tag, []).append(len(stack))
        if tag not in _INLINE:
            blocks.append(len(stack))
        stack.append((tag, bool(kind), main))
        link += tag == "a"
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def line_weights(lines: Lines) -> tuple[np.ndarray, bool]:
    """Weight of each line, and whether the article elements hold the text.

    Lines of parts that are no article weigh 0, unless the part is void: an article element
    inside and no more text outside, a mere name around more than ``MOST`` of the text, or
    articles inside an article with more text than the rest. The others weigh their
    characters, outside of articles without link text. The articles hold the text if
    ``FAVOUR`` times their weight reaches that of the rest; the other side then weighs 0.
    """
    size = np.array([len(t) for t in lines.texts], np.int64)
    linked = np.minimum(np.array(lines.links, np.int64), size)
    part, inside = np.array(lines.part, np.int64), np.array(lines.article, np.int64) >= 0
    n = len(lines.outer)
    sizes, holds = np.bincount(part[part >= 0], size[part >= 0], n).astype(np.int64).tolist(), list(lines.holds)
    for k in range(n - 1, -1, -1):  # what is inside a part has a larger number
        if lines.outer[k] >= 0:
            sizes[lines.outer[k]] += sizes[k]
            holds[lines.outer[k]] |= holds[k]
    total, outside = int(size.sum()), int((size - linked)[part < 0].sum())
    nested = sum(sizes[k] for k in range(n) if lines.kinds[k] == "inner")
    bare = not (inside & (part < 0)).any()
    out = []
    for k, kind in enumerate(lines.kinds):
        void = kind == "inner" and 2 * nested > total or kind == "named" and sizes[k] > MOST * total
        void |= kind != "hidden" and bare and holds[k] and sizes[k] > outside
        out.append(not void or lines.outer[k] >= 0 and out[lines.outer[k]])
    marked = np.array([k >= 0 and out[k] for k in lines.part], bool)
    weights = np.where(marked, 0, np.where(inside, size, size - linked))
    own, rest = int(weights[inside].sum()), int(weights[~inside].sum())
    main = own > 0 and FAVOUR * own >= rest
    return np.where(inside == main, weights, 0), main


def text_span(weights: np.ndarray) -> tuple[int, int, float]:
    """Line of the surge, line of the dive, and the least weight of a line at either.

    Of the sums over ``WINDOW`` lines, the surge is in the first above the level and the
    dive in the last, as articles have short lines within.
    """
    clipped = np.minimum(weights, CLIP * np.median(weights[weights > 0]))
    level = LEVEL * np.convolve(clipped, np.ones(WINDOW)).max()
    curve = np.convolve(weights, np.ones(WINDOW, np.int64))[WINDOW - 1 :]  # of the window that begins at each line
    high = np.flatnonzero(curve > level)
    surge, dive = int(high[0]), min(len(weights) - 1, int(high[-1]) + WINDOW - 1)
    while surge < dive and weights[surge] <= level / WINDOW:
        surge += 1
    while dive > surge and weights[dive] <= level / WINDOW:
        dive -= 1
    return surge, dive, level / WINDOW


def main_text(page: str) -> str:
    """The lines of some weight between surge and dive, joined by newlines; empty if no line counts.

    Short lines beside the text, such as its headline, belong to it: the span reaches over
    adjacent lines up to a link line or a part that is no article or, where articles hold the
    text, up to the end of the article (and the elements around it) that has the surge or dive.
    """
    lines = page_lines(page)
    weights, main = line_weights(lines)
    if not weights.any():
        return ""
    surge, dive, _ = text_span(weights)

    def reach(edge: int, step: int) -> int:
        around, k = set(), lines.article[edge]
        while k >= 0:
            around.add(k)
            k = lines.above[k]
        i = edge + step
        while 0 <= i < len(weights):
            if main:
                if lines.article[i] not in around:
                    break
                edge = i if weights[i] else edge
            elif weights[i] and 2 * lines.links[i] < len(lines.texts[i]):
                edge = i
            else:
                break
            i += step
        return edge

    surge, dive = reach(surge, -1), reach(dive, 1)
    return "\n".join(lines.texts[i] for i in range(surge, dive + 1) if weights[i])


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: id, url, text, n_chars (code points).

    A null, empty or text-free page gives an empty text; repeated rows give repeated rows. Pages
    of any length are read whole, in time and memory linear in their length.
    """

    def make():
        return lambda pages: [pa.array([main_text(p.decode("utf-8", "replace")) for p in pages], pa.string())]

    out = add_columns(df, html_col, "text string", make, [id_col, url_col])
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
