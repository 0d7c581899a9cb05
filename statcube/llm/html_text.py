"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, and lines in menus, adverts, forms and other furniture are
taken out.  Where an ``article`` or ``main`` marks the text, all lines left inside it are the text.  Elsewhere a line weighs
as much as its text is long, or nothing if it is mostly links, and weights are summed over sliding windows of
lines.  Text begins where a window's sum surges over a threshold, taken back over the weighing lines before
it, and ends where the sum dives to nothing.

Defined cases: a null or empty page has the empty text; markup that never closes ends with the page; rows
that repeat are extracted each for itself; no length of text or number of lines is cut.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 3
SURGE = 80
MAX_LINK_SHARE = 0.5

_HIDDEN = "script|style|noscript|template|iframe|svg|canvas|select|textarea|button|head|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_HIDDEN})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDES = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE_TAGS = frozenset("nav aside footer form menu dialog".split())
_NEVER = frozenset("html body main article".split())
_FURNITURE = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar aside widget widgets cookie cookies consent gdpr notice notices alert popup modal"
    " overlay newsletter subscribe subscription signup login search comment comments commentlist disqus respond reply"
    " replies discussion share sharing social related recommended recommendations pagination pager toolbar footer form"
    " skip complementary contentinfo masthead topbar copyright".split())
_OUTSIDE_ONLY = frozenset("header banner".split())
# Elements of running text: names that also describe what an author says do not make furniture of them.
_RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dl dt dd figure figcaption em strong b i q cite code".split())
_AMBIGUOUS = frozenset(
    "alert notice notices reply replies respond comment comments discussion aside form search related skip social banner".split())


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in _NEVER:
        return False
    if tag in _FURNITURE_TAGS or (tag == "header" and not in_article) or (attributes and _HIDES.search(attributes)):
        return True
    for groups in _NAMES.findall(attributes) if attributes else ():
        names = set(re.split(r"[^a-z]+", "".join(groups).lower()))
        if tag in _RUNNING:
            names -= _AMBIGUOUS
        if names & _FURNITURE or (not in_article and names & _OUTSIDE_ONLY):
            return True
    return False


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """Lines of a page outside its furniture: decoded text, weight, and whether it stands in an article."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked = 0
    stack: list[str] = []
    held: Counter[str] = Counter()
    furniture_at = None  # depth of the outermost open piece of furniture

    def end_line() -> None:
        nonlocal linked
        text = " ".join(references.unescape("".join(parts)).split())
        if text and furniture_at is None:
            weight = 0 if linked > MAX_LINK_SHARE * len(text) else len(text)
            lines.append((text, weight, bool(held["article"] or held["main"])))
        parts.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal furniture_at
        while stack:
            top = stack.pop()
            held[top] -= 1
            if top == tag:
                break
        if furniture_at is not None and len(stack) <= furniture_at:
            furniture_at = None

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at:token.start()])
            if held["a"]:
                linked += token.start() - at
        at = token.end()
        tag = token[3].lower() if token[3] else ""
        if not tag:
            continue
        if tag in _BLOCK:
            end_line()
        if token[2]:
            if held[tag]:
                close(tag)
            continue
        if tag in _BLOCK and tag != "br" and held["p"]:
            close("p")
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1] == tag:
            close(tag)
        if tag in _VOID or token[4].endswith("/"):
            continue
        if furniture_at is None and _is_furniture(tag, token[4], bool(held["article"] or held["main"])):
            furniture_at = len(stack)
        stack.append(tag)
        held[tag] += 1
    parts.append(page[at:])
    end_line()
    return lines


def between_surges(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> Iterator[int]:
    """Indexes of the lines between surge and dive points."""
    n = len(weights)
    sums = [sum(weights[i:i + window]) for i in range(n)]
    threshold = max(1, min(surge, max(sums, default=0)))
    at = done = 0
    while at < n:
        if sums[at] < threshold:
            at += 1
            continue
        start = at
        while start > done and weights[start - 1]:
            start -= 1
        while at < n and sums[at]:
            at += 1
        yield from (i for i in range(start, at) if weights[i])
        done = at


def main_text(page: str | None) -> str:
    lines = page_lines(page or "")
    marked = [text for text, _, inside in lines if inside]
    if marked:
        return "\n".join(marked)
    return "\n".join(lines[i][0] for i in between_surges([weight for _, weight, _ in lines]))


def extract(page: Column) -> Column:
    """The main text of a page; never null."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: main_text(p if isinstance(p, str) else ""))

    return texts(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Adds ``text`` and ``n_chars``; columns of these names are replaced."""
    return pages.withColumn("text", extract(F.col("html"))).withColumn("n_chars", F.length("text").cast("long"))
