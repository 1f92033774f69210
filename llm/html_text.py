"""Main text of web pages by composite text density.

A page becomes a tree of elements. Every element gets its composite text density: its
characters per tag, times how far the characters and tags outside links outweigh those in
links, on a logarithmic scale whose base grows with the page's own share of link text. The
density sum of an element is that of its children, and of the text that stands in it directly.

The element with the largest density sum holds the main text. The least density on the path from
it to the body is the threshold: other elements that reach it, outside that subtree, are
content by themselves, each with the largest density sum below it. Before that, what a page's
author names as something else (menus, footers, forms, scripts, adverts, comments, hidden parts)
leaves the tree; afterwards the choice is drawn to the bounds of the article elements it lies in,
or of the only one that it holds, so that titles and short paragraphs stay.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, same_names
from .tokens import pieces

# Names of HTML elements.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes plaintext".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt rtc ruby s
    samp small span strike strong sub sup time tt u var wbr img picture source""".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table
    ul xmp""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("table td th caption button object marquee applet template".split())
#: An element with one of these names ends open ones of these, up to the nearest of those.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
}
TRANSPARENT = frozenset("html head body".split())
# What is not main text, by element, by role, and by word of a class or id.
NOT_TEXT = frozenset("""nav header footer aside form script style title noscript template iframe object embed svg canvas audio
    video select button input textarea dialog menu datalist map frameset noframes noembed""".split())
NOT_ROLE = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
    toolbar""".split())
NOT_WORD = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense banner banners breadcrumb
    breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead
    menu modal nav navbar navigation newsletter notice notices paginator pagination pager paywall popup promo promotion
    recommended related replies reply respond share sharing sidebar signup skyscraper social sponsor sponsored subscribe
    subscription toolbar topbar""".split())
COMMENT_WORD = frozenset("comment comments commentlist disqus replies reply respond".split())
PARTS = frozenset("article main".split())

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|!--|[!?/])")
_TAIL = re.compile(r"""[^>=]*+(?:=(?:\s*+"[^"]*+"|\s*+'[^']*+')?+[^>=]*+)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
LEAST_BASE = 2.0  # of the logarithm; below, a page without links has none


class _Page:
    """Elements in page order as parallel lists; element 0 is the body. The elements below
    element i are i+1 to last[i], its text is ``text[begin[i]:end[i]]``."""

    def __init__(self):
        self.name, self.parent, self.last, self.begin, self.end = ["body"], [-1], [0], [0], [0]
        self.noise, self.link = [""], [False]
        self.chars, self.own, self.link_chars, self.tags, self.link_tags = [0], [0], [0], [0], [0]
        self.text: list[str] = []
        self.stack = [0]
        self.opened = Counter()          # open elements by name

    def open(self, name: str, noise: str) -> None:
        up = self.stack[-1]
        self.parent.append(up)
        self.name.append(name)
        self.noise.append(noise or self.noise[up])
        self.link.append(self.link[up] or name == "a")
        for numbers in (self.chars, self.own, self.link_chars, self.tags, self.link_tags):
            numbers.append(0)
        self.last.append(len(self.last))
        self.begin.append(len(self.text))
        self.end.append(len(self.text))
        if name not in INLINE:
            self.say(" ")
        if name not in VOID:
            self.stack.append(len(self.name) - 1)
            self.opened[name] += 1

    def close(self) -> None:
        i = self.stack.pop()
        self.opened[self.name[i]] -= 1
        if self.name[i] not in INLINE:
            self.say(" ")
        self.last[i], self.end[i] = len(self.name) - 1, len(self.text)

    def close_to(self, names, scope) -> None:
        """Ends the innermost open element of these names, unless one of ``scope`` is further in."""
        if not any(self.opened[name] for name in names):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.name[self.stack[depth]]
            if name in names:
                while len(self.stack) > depth:
                    self.close()
                return
            if name in scope:
                return

    def say(self, text: str) -> None:
        self.text.append(text)
        if text != " ":
            self.own[self.stack[-1]] += len("".join(text.split()))


def _noise(name: str, tail: str) -> str:
    """Why an element is not main text: "element", "comment", "word", or nothing."""
    if name in NOT_TEXT:
        return "element"
    if "=" not in tail and "hidden" not in tail:
        return ""
    found = {}
    for key, *values in _ATTRIBUTE.findall(tail):
        found.setdefault(key.lower(), html.unescape("".join(values)))
    if "hidden" in found or found.get("aria-hidden") == "true" or _GONE.search(found.get("style", "")):
        return "element"
    if found.get("role", "").strip().lower() in NOT_ROLE:
        return "element"
    told = ""
    for label in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [w.lower() for w in _WORD.findall(label)]
        if parts and parts[0] not in ("has", "no", "with", "without", "is", "js"):
            if COMMENT_WORD.intersection(parts):
                return "comment"
            if NOT_WORD.intersection(parts):
                told = "word"
    return told


def parse(source: str) -> _Page:
    """The tree of a page. Tags that HTML lets out are supplied: paragraphs, items and cells
    end where the next begins, end tags without an open element are ignored."""
    page, at, n = _Page(), 0, len(source)

    def said(a: int, b: int) -> None:
        if b > a:
            text = source[a:b]
            page.say(html.unescape(text) if "&" in text else text)

    while at < n:
        mark = _MARK.search(source, at)
        if mark is None:
            break
        said(at, mark.start())
        name = (mark[2] or "").lower()
        if not name:
            opened = mark[0]
            close = "-->" if opened == "<!--" else "]]>" if source.startswith("<![CDATA[", mark.start()) else ">"
            stop = source.find(close, mark.end() - (2 if opened == "<!--" else 0))
            at = n if stop < 0 else stop + len(close)
            continue
        tail = _TAIL.match(source, mark.end())
        if tail is None:            # the page ends inside a tag
            return _finish(page)
        at = tail.end()
        if mark[1]:
            if name == "br":
                page.open("br", "")
            elif name in HEADINGS:
                page.close_to(HEADINGS, SCOPE)
            elif name in INLINE:
                page.close_to((name,), CLOSES_P | SCOPE)
            elif name not in TRANSPARENT:
                page.close_to((name,), SCOPE - {name} if name in SCOPE else SCOPE)
                page.say(" ")
            continue
        if name in TRANSPARENT:
            continue
        if name in CLOSES_P:
            page.close_to(("p",), SCOPE)
        if name in HEADINGS and page.name[page.stack[-1]] in HEADINGS:
            page.close()
        if name in IMPLIED:
            page.close_to(*IMPLIED[name])
        if name == "a":
            page.close_to(("a",), CLOSES_P | SCOPE)
        noise = _noise(name, tail[0])
        if noise == "word" and name in PARTS:
            noise = ""
        if name in PARTS:
            _unsaid(page)
        page.open(name, noise)
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            at = stop.start() if stop else n
            if stop is None:
                return _finish(page)
        elif tail[0].endswith("/>") and name in ("svg", "path", "use", "circle", "rect", "g", "math"):
            page.close()
    said(at, n)
    return _finish(page)


def _unsaid(page: _Page) -> None:
    """An article or main element inside an element whose class sounds like something else:
    the class speaks of the page's layout, so it does not count."""
    for i in page.stack:
        if page.noise[i] == "word":
            page.noise[i] = ""


def _finish(page: _Page) -> _Page:
    while len(page.stack) > 1:
        page.close()
    page.last[0], page.end[0] = len(page.name) - 1, len(page.text)
    for i in range(len(page.name) - 1, 0, -1):
        if page.noise[i]:
            continue
        up = page.parent[i]
        page.chars[i] += page.own[i]
        if page.link[i]:
            page.link_chars[i] = page.chars[i]
            page.link_tags[i] = page.tags[i] + (page.name[i] == "a")
        page.chars[up] += page.chars[i]
        page.link_chars[up] += page.link_chars[i]
        page.tags[up] += page.tags[i] + 1
        page.link_tags[up] += page.link_tags[i]
    page.chars[0] += page.own[0]
    return page


def densities(page: _Page) -> tuple[list[float], list[float]]:
    """Composite text density and density sum of each element; 0 for what is not content."""
    n = len(page.name)
    share = page.link_chars[0] / max(page.chars[0], 1)

    def composite(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        base = max(math.log(c / max(c - lc, 1) * lc + share * c + math.e), LEAST_BASE)
        return c / t * math.log(max(c / max(lc, 1) * (t / max(lt, 1)), 1.0 if lc else 2.0), base)

    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if page.noise[i]:
            continue
        t = max(page.tags[i], 1)
        density[i] = composite(page.chars[i], t, page.link_chars[i], page.link_tags[i])
        total[i] += composite(page.own[i], t, page.own[i] if page.link[i] else 0, 0)
        if i:
            total[page.parent[i]] += density[i]
    return density, total


def main_elements(page: _Page) -> list[int]:
    """The elements that hold the main text, none within another, in page order."""
    if not page.chars[0]:
        return []
    density, total = densities(page)
    n = len(page.name)
    best = list(range(n))                     # of each subtree, the element with the largest sum
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.noise[i] and total[best[i]] >= total[best[up]]:
            best[up] = best[i]
    top, around = best[0], [-1] * n           # around: the article or main element it lies in
    for i in range(1, n):
        around[i] = i if page.name[i] in PARTS and not page.noise[i] else around[page.parent[i]]
    path = [top]
    while path[-1]:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    found = {best[i] for i in range(n) if not page.noise[i] and page.chars[i] and density[i] >= threshold}
    if around[top] < 0:
        found = _only_article(page, top) or found
    found = {around[i] for i in found if around[i] >= 0} or found
    chosen: list[int] = []
    for i in sorted(found):
        if not chosen or i > page.last[chosen[-1]]:
            chosen.append(i)
    return chosen


def _only_article(page: _Page, top: int) -> set[int]:
    """The article, else the main element, below ``top``, if there is just one."""
    for part in ("article", "main"):
        found, i = set(), top
        while i <= page.last[top]:
            if page.noise[i] or page.name[i] == part:
                if not page.noise[i] and page.chars[i]:
                    found.add(i)
                i = page.last[i] + 1
            else:
                i += 1
        if len(found) == 1:
            return found
    return set()


def main_text(source: str | None) -> str:
    """The main text of one page, blocks joined by one space."""
    if not source:
        return ""
    page = parse(source)
    parts = []
    for top in main_elements(page):
        i, at = top, page.begin[top]
        while i <= page.last[top]:
            if page.noise[i]:
                parts.extend(page.text[at:page.begin[i]])
                parts.append(" ")
                at, i = page.end[i], page.last[i] + 1
            else:
                i += 1
        parts.extend(page.text[at:page.end[top]])
        parts.append(" ")
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (main text, "" if there is none) and n_chars.

    Every page is read whole, where it is; nothing is shuffled. Character references are
    decoded as browsers do, also without a semicolon; runs of white space, and bounds of
    blocks, are one space. Elements that are inline (links, emphasis, code) do not part words.

    Null or empty html, and a page of markup only, has an empty text. Text outside any element
    counts as text of the body; a page that ends inside a tag loses that tag only. Of equal
    density sums the element furthest in wins, of those the first. Repeated rows come out once
    each, null ids and urls stay null, other columns are left out, an empty table gives none.
    A task holds some 2 MB of pages at once, or one longer page.
    """
    types = dict(pages.dtypes)
    rows = same_names(pages, ("page_id", "url", column))
    arrow_batches(pages.sparkSession)

    def run(batches):
        for batch in pieces(batches, column):
            texts = [main_text(source.as_py()) for source in batch.column(column)]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return rows.select("page_id", "url", F.col(f"`{column}`").cast("string").alias(column)).mapInArrow(
        run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
