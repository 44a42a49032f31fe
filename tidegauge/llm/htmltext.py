"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser is fed in pieces and its events build lines: a line is
the text between two block boundaries, with the tags met on the way. The ratio of
text to tags of each line is smoothed over its neighbours by a Gaussian, and two-means
clustering of the smoothed ratios sets the threshold above which a line is content.

Content lines choose the region: the articles (or `main`) of a page if they hold the
larger part of its content, else the deepest element that holds nearly all of it, from
the first content line (or the headings before it) to the last. Of a region every line is
text, short ones as well, but for what is marked as something else: navigation, headers and footers of the page, sidebars, notices, adverts, forms,
reader comments, and what a browser doesn't show. Elements that HTML lets stand open
(p, li, td and the like) end where HTML ends them, and the head at the first that isn't
of it. A form, or a part marked by a word alone, that holds most of the article or
nearly all of the content is a wrapper of the page and not such a mark; what starts with
"comment" is never one. `main` is content within any of these. In an article a name marks
only if none of its words says anything else ("related-links" does, "related-research" not).

Pages are independent: no shuffle, and a page is as much as its one row. Defined
results: a null, empty or textless page has the empty text with 0 characters; null ids
and urls pass through; repeated rows give a row each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import ship

FEED = 1 << 16
SIGMA = 1.0
REACH = 2
WEIGHTS = np.exp(-(np.arange(-REACH, REACH + 1) ** 2) / (2 * SIGMA * SIGMA))
#: A region holds at least this share of the content.
MOST = 0.9

# Names of HTML elements by what the HTML standard says of them, and words by which pages mark what isn't content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img label".split())
NOT_SHOWN = frozenset("head title script style noscript template iframe object embed svg canvas audio video map datalist".split())
NOT_CONTENT = frozenset("nav footer aside button select textarea option input dialog menu".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
HOLDS_SAME = frozenset("ul ol dl table tbody thead tfoot select menu".split())
HOLDERS = HOLDS_SAME | frozenset(ENDS_SAME)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead "
    "comment comments commentlist disqus cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget pagination pager".split()
)
#: With these, a mark in an article is still one: "share-buttons" is, "related-research" isn't.
PARTS = frozenset("area article articles bar block box button buttons container content form group icon icons inner item items link links list outer panel post posts row section slot stories story unit wrap wrapper".split())
PAGE_MARKS = frozenset("header footer".split())
OF_HEAD = frozenset("html head title meta link base script style noscript template".split())
KEPT = frozenset("html body article main".split())
COMMENT_MARKS = frozenset("comment comments commentlist".split())
MARK_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
COMMENT_START = re.compile(r"(?:^|\s)(?:comment|disqus)", re.I)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _marked(attrs: dict[str, str | None]) -> str:
    return f"{attrs.get('class') or ''} {attrs.get('id') or ''}"


def _words(marked: str) -> set[str]:
    return {w.lower() for w in MARK_WORD.findall(marked)}


class Element:
    """An open element: its place among all (a parent comes before its children), and what its ancestors say of it.

    wrap: the nearest element from here up that shuts its lines unless it turns out to be a wrapper, -1 if there is none.
    shut_at, holder: places on the stack of the uppermost shut element and of the nearest of HOLDERS.
    """

    __slots__ = ("tag", "number", "shut", "article", "heading", "wrap", "shut_at", "holder")

    def __init__(self, tag: str, number: int):
        self.tag, self.number = tag, number
        self.shut = self.article = self.heading = False
        self.wrap = self.shut_at = self.holder = -1


class Line:
    __slots__ = ("text", "tags", "element", "shut", "article", "heading", "wrap")

    def __init__(self, text: str, tags: int, top: Element):
        self.text, self.tags, self.element = text, tags, top.number
        self.shut, self.article, self.heading, self.wrap = top.shut, top.article, top.heading, top.wrap


class Lines(HTMLParser):
    """Parser events to lines. Each event costs what it opens and closes, however deep the page is nested."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [Element("", 0)]
        self.open = Counter([""])
        self.parents = [-1]
        self.wrap_parents: dict[int, int] = {}
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = 0

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers aren't asked for."""
        return j

    def line(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append(Line(text, self.tags, self.stack[-1]))
            self.tags = 0

    def _end_from(self, at: int) -> None:
        for element in self.stack[at:]:
            self.open[element.tag] -= 1
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.line()
        if tag not in OF_HEAD:
            self._end_head(tag == "body")
        if tag in ENDS_PARAGRAPH and self.open["p"]:
            at = len(self.stack) - 1
            while self.stack[at].tag in INLINE:
                at -= 1
            if self.stack[at].tag == "p":
                self._end_from(at)
        if tag in ENDS_SAME:
            self._end_same(ENDS_SAME[tag])
        if tag in ("article", "main"):  # these don't stand in the page's own parts: one of those was left open
            at = self.stack[-1].shut_at
            if at >= 0 and self.stack[at].tag in ("nav", "header", "footer"):
                self._end_from(at)
        if tag in VOID:
            return
        above, own = self.stack[-1], dict(attrs)
        new = Element(tag, len(self.parents))
        self.parents.append(above.number)
        new.article = above.article or tag in ("article", "main")
        new.heading = above.heading or tag in HEADINGS
        new.wrap = -1 if tag == "main" else above.wrap
        new.shut = above.shut or self._is_shut(tag, own, above.article)
        if not new.shut and self._is_marked(tag, own, above.article):
            if COMMENT_START.search(_marked(own)):
                new.shut = True
            else:
                self.wrap_parents[new.number] = new.wrap
                new.wrap = new.number
        place = len(self.stack)
        new.shut_at = above.shut_at if above.shut else place if new.shut else -1
        new.holder = place if tag in HOLDERS else above.holder
        self.stack.append(new)
        self.open[tag] += 1

    def _end_head(self, anywhere: bool) -> None:
        if not self.open["head"] or not (anywhere or self.stack[-1].tag == "head"):
            return
        self._end_from(next(i for i, e in enumerate(self.stack) if e.tag == "head"))

    def _end_same(self, tags: set[str]) -> None:
        """End the nearest open element of these, unless another stands in between that may hold it."""
        if not any(self.open[t] for t in tags):
            return
        at = self.stack[-1].holder
        while at >= 0 and self.stack[at].tag not in HOLDS_SAME:
            if self.stack[at].tag in tags:
                self._end_from(at)
                return
            at = self.stack[at - 1].holder

    def _is_shut(self, tag: str, attrs: dict[str, str | None], in_article: bool) -> bool:
        if tag in NOT_SHOWN or tag in NOT_CONTENT or (tag == "header" and not in_article):
            return True
        if not attrs:
            return False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN_STYLE.search(attrs.get("style") or "") or (attrs.get("role") or "").lower() in ROLES:
            return True
        return tag == "article" and not COMMENT_MARKS.isdisjoint(_words(_marked(attrs)))

    def _is_marked(self, tag: str, attrs: dict[str, str | None], in_article: bool) -> bool:
        if tag == "form":
            return True
        if tag in KEPT or not attrs:
            return False
        if in_article:  # here a name is a mark only if none of its words says anything else
            return any(not MARKS.isdisjoint(own) and own <= MARKS | PARTS for own in map(_words, _marked(attrs).split()))
        return not _words(_marked(attrs)).isdisjoint(MARKS | PAGE_MARKS)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self._end_from(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.line()
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                self._end_from(at)
                return
            if tag in INLINE and self.stack[at].tag not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and not data.isspace():
            self._end_head(False)
        if self.stack[-1].tag not in NOT_SHOWN:
            self.parts.append(data)


def smoothed(ratios: list[float]) -> list[float]:
    """Each value with its neighbours up to REACH, weighted by a Gaussian; at the ends over those there are."""
    if len(ratios) <= 2 * REACH:
        norm = np.convolve(np.ones(len(ratios)), WEIGHTS)[REACH:-REACH]
        return (np.convolve(ratios, WEIGHTS)[REACH:-REACH] / norm).tolist()
    return (np.convolve(ratios, WEIGHTS, "same") / np.convolve(np.ones(len(ratios)), WEIGHTS, "same")).tolist()


def threshold(values: list[float]) -> float:
    """The middle between the means of two clusters."""
    low, high = min(values), max(values)
    for _ in range(50):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not below:
            return low
        new = sum(below) / len(below), sum(above) / len(above)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def up_the_tree(own: dict[int, int], parents) -> dict[int, int]:
    """Sums over each node's own and all below it. A parent has a lesser number than its children. parents: -1 above the top."""
    out = dict(own)
    heap = [-n for n in out]
    heapq.heapify(heap)
    while heap:
        n = -heapq.heappop(heap)
        parent = parents[n]
        if parent >= 0:
            if parent not in out:
                out[parent] = 0
                heapq.heappush(heap, -parent)
            out[parent] += out[n]
    return out


def wrappers(shown: list[Line], content: list[Line], parents: dict[int, int]) -> set[int]:
    """Marked elements round most of the article or, where there is none, nearly all of the content. shown: lines not shut for good; content: those of them above the threshold."""
    articles = [x for x in shown if x.article]
    free = sum(len(x.text) for x in content if x.wrap < 0 and not x.article)
    total = sum(len(x.text) for x in articles)
    held: dict[int, int] = {}
    for line in articles or content:
        if line.wrap >= 0:
            held[line.wrap] = held.get(line.wrap, 0) + len(line.text)
    held = up_the_tree(held, parents)
    if articles:
        return {e for e, n in held.items() if 2 * n > total and n >= free}
    return {e for e, n in held.items() if n >= MOST * (n + free)}


def region_of(content: list[Line], parents: list[int]) -> tuple[int, int]:
    """The deepest element that holds nearly all of the content, and the last one within it."""
    held: dict[int, int] = {}
    for line in content:
        held[line.element] = held.get(line.element, 0) + len(line.text)
    total = sum(held.values())
    region = max(e for e, n in up_the_tree(held, parents).items() if n >= MOST * total)  # these are a chain, the deepest comes last
    inside = {region}
    last = region
    for n in range(region + 1, len(parents)):
        if parents[n] not in inside:
            break
        inside.add(n)
        last = n
    return region, last


def main_text(html: str | None) -> str:
    parser = Lines()
    for at in range(0, len(html or ""), FEED):
        parser.feed(html[at : at + FEED])
    parser.close()
    parser.line()
    lines = parser.lines
    if all(line.shut for line in lines):
        return ""
    plain = [math.log1p(len(x.text) / max(1, x.tags)) for x in lines]
    ratios = smoothed(plain)
    least = threshold(ratios)
    if parser.wrap_parents:
        shown = [line for line in lines if not line.shut]
        wide = wrappers(shown, [x for x, r in zip(lines, ratios, strict=True) if r >= least and not x.shut] or shown, parser.wrap_parents)
        is_open = {-1: True}
        for number, parent in parser.wrap_parents.items():
            is_open[number] = number in wide and is_open[parent]
        for line in shown:
            line.shut = not is_open[line.wrap]
    own = [(x, r, p) for x, r, p in zip(lines, ratios, plain, strict=True) if not x.shut]
    if not own:
        return ""
    content = [x for x, r, _ in own if r >= least] or [x for x, _, _ in own]
    if 2 * sum(len(x.text) for x in content if x.article) >= sum(len(x.text) for x in content):
        return " ".join(x.text for x, _, _ in own if x.article)
    first, last = region_of(content, parser.parents)
    inside = [(x, p) for x, _, p in own if first <= x.element <= last]
    # where no element marks the article, it begins with content or a heading and ends with content
    dense = [i for i, (_, p) in enumerate(inside) if p >= least]
    if dense:
        begin = dense[0]
        while begin and inside[begin - 1][0].heading:
            begin -= 1
        inside = inside[begin : dense[-1] + 1]
    return " ".join(x.text for x, _ in inside)


def _extract(batches):
    for batch in batches:
        texts: list[str] = []
        for at in range(0, batch.num_rows, 128):
            texts += map(main_text, batch.column(2).slice(at, 128).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    ship(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")
