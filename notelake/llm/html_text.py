"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, a threshold.

The standard library's parser streams a page. Block tags cut it into lines; each line knows its
text, how many tags it took, how much of it is link text and whether it lies in an element that never
holds the article (by tag, role, class or id). A line's ratio is its plain text per tag, 0 in such
elements and ``FULL`` at most, so that a long line weighs no more than any paragraph. Ratios are
smoothed by a Gaussian over the lines, so that short paragraphs are lifted by their neighbours, and
lines above ``LAMBDA`` standard deviations are content. A region is an article (or main) element
with such a line, or one beside it in the same box (a div, section, cell or body) that has text
outside links. In a page without, it is all lines from the first to the last one with the heading
before it, and all lines in the box of such a line. Lines of the named elements are taken out of it.

Edge cases: null, empty and text-free pages give '' and 0. A page without markup is one line. Open
elements at the end of a page end there; end tags without a start are ignored. If no line stands out,
all lines outside the named elements are the text. Repeated rows are each extracted.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from notelake.llm.texts import map_texts

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = frozenset(
    "head title script style noscript template svg math iframe object audio video canvas".split())
ASIDE = frozenset(
    "nav footer aside form dialog menu button select textarea fieldset".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
    "form".split())
# Words in class and id that name parts beside the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination paywall popup promo promoted promotion recommended related respond replies reply "
    "share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription "
    "tags teaser toc toolbar topbar widget widgets".split())
WORDS = re.compile(r"[a-z]+")
# Words that say a page has or lacks such a part, as in "has-sidebar"; and parts an article has too.
SAYS = frozenset("has with without no".split())
IN_ARTICLE = frozenset("header tags".split())

# Elements that hold blocks.
BOXES = frozenset("html body div section center td th article main".split())

SIGMA, LAMBDA = 1.5, 0.5
FULL = 80
RADIUS = 5
KERNEL = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)


def named_aside(attrs: list[tuple[str, str | None]], inside: bool = False) -> bool:
    """``inside``: within an article, whose own header is part of it."""
    for name, value in attrs:
        if name == "hidden":
            return True
        if not value:
            continue
        if name in ("class", "id"):
            words = WORDS.findall(value.lower())
            found = ASIDE_WORDS.intersection(words)
            if found and SAYS.isdisjoint(words) and not (inside and found <= IN_ARTICLE):
                return True
        elif name == "role":
            if value.lower() in ASIDE_ROLES:
                return True
        elif name == "aria-hidden" and value.lower() == "true":
            return True
    return False


Line = tuple[str, int, int, bool, int, bool, int, int]


class Lines(HTMLParser):
    """Lines of a page: (text, tags, link characters, beside, region, heading, box, outer box).

    A line right in a box may be a paragraph of the box around that one, its outer box.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Open elements: (tag, beside the article, region of the article, heading, box, outer box).
        self.open: list[tuple[str, bool, int, bool, int, int]] = [("", False, 0, False, 0, 0)]
        self.text: list[str] = []
        self.region_boxes = [0]  # the box that each region stands in
        self.boxes = 0
        self.tags = self.links = self.regions = self.in_link = self.hidden = 0

    def cut(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.lines.append((text, self.tags, self.links, *self.open[-1][1:]))
                self.tags = self.links = 0
            self.text = []

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in INLINE and not attrs:  # the usual case
            if tag == "br":
                self.text.append(" ")
                return
            if tag == "a":
                self.in_link += 1
            self.open.append((tag, *self.open[-1][1:]))
            return
        if tag in HIDDEN:
            if tag not in ("script", "style", "title") or not self.hidden:
                self.cut()
        if tag not in INLINE:
            self.cut()
            if tag == "p" or tag == "li" or tag not in VOID:
                self.close_implied(tag)
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        _, beside, region, heading, box, outer = self.open[-1]
        if tag in MAIN and not named_aside(attrs):
            if beside and any(name == "nav" for name, *_ in self.open):
                beside = False  # an article does not stand in a menu: the menu was not closed
            if not region:
                self.regions += 1
                region = self.regions
                self.region_boxes.append(box)
        elif not beside:
            beside = tag in ASIDE or (tag == "header" and not region) or (
                bool(attrs) and tag not in ("body", "html") and named_aside(attrs, region > 0))
        if tag in HIDDEN:
            self.hidden += 1
        if tag == "a":
            self.in_link += 1
        if beside and tag in INLINE and not self.open[-1][1]:
            self.cut()  # an inline element beside the article is a line of its own
        if tag not in INLINE:
            outer = box
        if tag in BOXES:
            self.boxes += 1
            box = self.boxes
        self.open.append((tag, beside, region, heading or tag in HEADINGS, box, outer))

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it in its list."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == "p" or (tag == "li" and name == "li"):
                self.shorten(i)
                return
            if name not in INLINE:
                return

    def shorten(self, to: int) -> None:
        for name, *_ in self.open[to:]:
            if name == "a":
                self.in_link -= 1
            elif name in HIDDEN:
                self.hidden -= 1
        del self.open[to:]

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag not in INLINE:
            self.cut()
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if tag not in INLINE or self.open[i][1] != self.open[i - 1][1]:
                    self.cut()
                self.shorten(i)
                return
            if tag in INLINE and self.open[i][0] not in INLINE:
                return  # it was opened outside this block

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
            if self.in_link > 0:
                self.links += len(data)


def lines_of(html: str) -> tuple[list[Line], list[int]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    return parser.lines, parser.region_boxes


def content(lines: list[Line], region_boxes: list[int]) -> list[str]:
    """The lines of the content regions."""
    if not lines:
        return []
    beside = np.array([line[3] for line in lines])
    region = np.array([line[4] for line in lines])
    plain = np.array([max(len(text) - links, 0) for text, _, links, *_ in lines], float)
    tags = np.array([max(line[1], 1) for line in lines], float)
    ratio = np.where(beside, 0.0, np.minimum(plain / tags, FULL))
    weight = np.convolve(np.ones(len(ratio)), KERNEL)[RADIUS:-RADIUS]
    smooth = np.convolve(ratio, KERNEL)[RADIUS:-RADIUS] / weight
    chosen = ~beside & (smooth >= LAMBDA * smooth.std()) & (ratio > 0)
    if not chosen.any():
        kept = ~beside
    elif (region[chosen] > 0).any():
        stands_in = np.array(region_boxes)
        own = np.unique(region[chosen & (region > 0)])
        texts = np.unique(region[(ratio > 0) & (region > 0)])
        near = texts[np.isin(stands_in[texts], stands_in[own])]
        kept = ~beside & np.isin(region, np.concatenate([own, near]))
    else:
        first, last = np.flatnonzero(chosen)[[0, -1]]
        inside = np.zeros(len(lines), bool)
        inside[first:last + 1] = True
        boxes = np.array([line[6:] for line in lines])
        inside |= np.isin(boxes, np.unique(boxes[chosen])).any(axis=1)
        first = np.flatnonzero(inside & ~beside)[0]
        while first and lines[first - 1][5] and not beside[first - 1]:
            first -= 1
            inside[first] = True
        kept = inside & ~beside
    return [lines[i][0] for i in np.flatnonzero(kept)]


def extract(html: str | None) -> str:
    return "\n\n".join(content(*lines_of(html))) if html else ""


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url",
                  html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""

    def work(batch: pa.RecordBatch):
        texts = [extract(page) for page in batch.column(1).to_pylist()]
        return (batch.column(0), batch.column(2), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()))

    kind = pages.schema[key].dataType.simpleString()
    named = pages.select(F.col(key), F.col(url).cast("string").alias(url), F.col(html))
    return map_texts(named, key, html, f"{key} {kind}, {url} string, text string, n_chars bigint",
                     work, [url])
