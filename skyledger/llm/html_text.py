"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser reports tags and text; block elements begin a new line. A line's ratio is its
visible characters outside links over its tags. Ratios are smoothed by a Gaussian window, and a threshold (half the
length-weighted mean) clusters lines into content and rest. The regions that pass choose the innermost container that holds
all of them, or the article or main element around it. All of its lines are content, but for those in parts of other
purpose (menus, page headers and footers, side bars, notices, adverts, forms, comments of readers), which
have a ratio of 0 and take no part. An element's class or id tells its purpose only if it is a container, and only
if it does not hold most of the dense text of the page and of its article.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows

SIGMA, RADIUS, SHARE = 1.0, 2, 0.8
_PAGES = "page_id bigint, url string, text string"

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div body td blockquote html".split())
SILENT = frozenset("script style noscript template head title svg math iframe object select textarea button canvas audio video".split())
OTHER_PURPOSE = frozenset("nav footer aside form menu dialog search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements whose class or id may tell another purpose; headings, paragraphs and parts of lines are not among them.
NAMED = CONTAINERS - {"html", "body", "main"} | frozenset("header ul ol dl table tbody tr details fieldset figure center".split())
#: Last words of a class name or id of an element of other purpose.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar aside footer header masthead topbar toolbar comment comments disqus replies respond notice notices cookie cookies consent "
    "gdpr alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended pagination pager widget "
    "skip toc".split()
)
#: The same for an article, which a page may have for each comment.
ARTICLE_WORDS = frozenset("ad ads advert adverts advertisement sponsored promo comment comments reply replies".split())
#: What an open element of a kind is closed by.
_P_ENDS = BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "optgroup", "option", "html", "body"}
_CLOSED_BY = {
    "p": _P_ENDS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
_SCOPES = frozenset("ul ol dl table article section main div body aside nav footer header form td th blockquote".split())
_WORDS = re.compile("[a-z]+")
#: Words ahead that make it a state of the page, or a part of the content.
_NOT_OTHER = frozenset("has no not with without article post entry story content".split())


_CLOSES: dict[str, list[str]] = {}
for _name, _enders in _CLOSED_BY.items():
    for _ender in _enders:
        _CLOSES.setdefault(_ender, []).append(_name)
_UNFINISHED = re.compile("<[a-zA-Z/!?]")


def _named_other(tag: str, said: dict[str, str]) -> bool:
    """Whether a class name or the id of a container is, or ends in, a word of other purpose."""
    if tag not in NAMED:
        return False
    wanted = ARTICLE_WORDS if tag == "article" else OTHER_WORDS
    for name in f"{said.get('class', '')} {said.get('id', '')}".split():
        words = _WORDS.findall(name)
        if words and words[-1] in wanted and (len(words) == 1 or words[-2] not in _NOT_OTHER):
            return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: text, tags, characters inside links, the open containers, whether the purpose is another, and the
    innermost element around that is of other purpose by its name.

    Open elements are found by name, so an element costs no more for the depth it is in.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, int, int]] = []  # element, silent, other purpose, container, named
        self.depths: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.parents: list[int] = [-1]
        self.kinds: list[str] = [""]
        self.named: list[int] = [-1]
        self.lines: list[tuple[str, int, int, int, bool, int]] = []
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def parse_html_declaration(self, i: int) -> int:
        # a marked section is no HTML: all up to the next ">" is a comment
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def _state(self) -> tuple[bool, bool, int, int]:
        return self.open[-1][1:] if self.open else (False, False, 0, 0)

    def _innermost(self, tag: str) -> int:
        held = self.depths.get(tag)
        return held[-1] if held else -1

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, other, container, named = self._state()
            self.lines.append((text, self.tags, self.linked, container, other, named))
        self.parts, self.tags, self.linked = [], 0, 0

    def _close(self, depth: int) -> None:
        if any(tag in BLOCKS for tag, *_ in self.open[depth:]):
            self._end_line()
        while len(self.open) > depth:
            tag = self.open.pop()[0]
            self.depths[tag].pop()
            if tag in _SCOPES:
                self.scopes.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            head = self._innermost("head")
            if head >= 0:  # left open
                self._close(head)
            depth = max((self._innermost(name) for name in _CLOSES.get(tag, ())), default=-1)
            if depth >= 0 and depth >= (self.scopes[-1] if self.scopes else 0):
                self._close(depth)
            self._end_line()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        silent, other, container, named = self._state()
        if not silent:
            silent = tag in SILENT
        if not other and tag not in ("html", "body", "main"):
            said = {name: (value or "").lower() for name, value in attrs}
            other = (
                tag in OTHER_PURPOSE or said.get("role", "") in OTHER_ROLES or "hidden" in said or said.get("aria-hidden") == "true"
                or tag == "header" and self._innermost("article") < 0
            )
            if not other and _named_other(tag, said):
                self.named.append(named)
                named = len(self.named) - 1
        if tag in CONTAINERS:
            self.parents.append(container)
            self.kinds.append(tag)
            container = len(self.parents) - 1
        self.depths.setdefault(tag, []).append(len(self.open))
        if tag in _SCOPES:
            self.scopes.append(len(self.open))
        self.open.append((tag, silent, other, container, named))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        depth = self._innermost(tag)
        if depth >= 0 and (tag in BLOCKS or depth >= (self.scopes[-1] if self.scopes else 0)):
            self._close(depth)
        elif tag in BLOCKS:
            self._end_line()

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.parts.append(data)
            if self._innermost("a") >= 0:
                self.linked += len(data)

    def finish(self) -> None:
        if _UNFINISHED.match(self.rawdata):  # a tag or comment without its end
            self.rawdata = ""
        self.close()
        self._end_line()


def _smoothed(ratios: list[float]) -> list[float]:
    weights = {d: math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)}
    out = []
    for i in range(len(ratios)):
        near = [(weights[d], ratios[i + d]) for d in weights if 0 <= i + d < len(ratios)]
        out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    return out


def _dense(lines: list[tuple[str, int, int, int, bool, int]]) -> list[tuple[str, int, int, int, bool, int]]:
    """The lines that pass the threshold."""
    smooth = _smoothed([max(0, len(text) - linked) / max(1, tags) for text, tags, linked, *_ in lines])
    length = sum(len(line[0]) for line in lines)
    threshold = 0.5 * sum(s * len(line[0]) for s, line in zip(smooth, lines)) / length
    return [line for line, ratio in zip(lines, smooth) if ratio >= threshold]


def main_text(html: str) -> str:
    """The main text of one page; empty if there is none."""
    page = _Lines()
    page.feed(html)
    page.finish()
    lines = [line for line in page.lines if not line[4]]
    if any(line[5] for line in lines):
        # an element is overruled if it holds most of the dense text and, where the page has article or main elements, of theirs
        semantic = [False] * len(page.parents)
        for at in range(1, len(semantic)):
            semantic[at] = semantic[page.parents[at]] or page.kinds[at] in ("article", "main")
        dense = _dense(lines)
        content = [True, *[any(len(line[0]) > line[2] for line in dense)] * (len(page.named) - 1)]
        for voters in (dense, [line for line in lines if semantic[line[3]]]):
            held = [0] * len(page.named)
            for text, _, linked, _, _, at in voters:
                held[at] += max(0, len(text) - linked)
            for at in range(len(held) - 1, 0, -1):
                held[page.named[at]] += held[at]
            for at in range(1, len(held)):
                content[at] = content[at] and content[page.named[at]] and held[at] >= SHARE * held[0]
        lines = [line for line in lines if content[line[5]]]
    if not lines:
        return ""
    passed = _dense(lines)
    votes = [0] * len(page.parents)
    for text, _, linked, at, *_ in passed:
        votes[at] += max(0, len(text) - linked)  # links beside dense lines pass, but have no vote
    if not any(votes):
        for line in passed:
            votes[line[3]] += len(line[0])
    # containers are numbered in page order, each after the one around it: sums go to the front, and of those that hold
    # all votes the innermost is the last
    for at in range(len(votes) - 1, 0, -1):
        votes[page.parents[at]] += votes[at]
    chosen = max(at for at, held in enumerate(votes) if held == votes[0])
    around = chosen
    while around > 0 and page.kinds[around] not in ("article", "main"):
        around = page.parents[around]
    chosen = around if around > 0 else chosen
    inside = [at == chosen for at in range(len(votes))]
    for at in range(1, len(votes)):
        inside[at] = inside[at] or inside[page.parents[at]]
    return " ".join(text for text, _, _, at, *_ in lines if inside[at])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, url, text`` of every page, where the rows lie.

    A null or empty page, and one without any text, has an empty text. Null ids and urls stay; repeated rows stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_PAGES)
        for batch in batches:
            ids, urls, bodies = (column.to_pylist() for column in batch.columns)
            yield batch_of(schema, {"page_id": ids, "url": urls, "text": [main_text(body or "") for body in bodies]})

    return map_rows(pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html).alias("html")), _PAGES, work)
