"""Main text of HTML pages from streaming parser events and text-to-tag ratios.

The standard library's parser feeds its events to a visitor that never builds a tree. Block elements and ``<br>`` end a
line; a line knows its text, the number of tags in it, and what encloses it. What is never content (scripts, styles, forms,
navigation, page headers and footers, sidebars, notices, adverts, reader comments; by element, ARIA role, or words in class
and id) is left out. Each line's text-to-tag ratio is smoothed by a Gaussian over its neighbours; lines at or above a share
of the ratios' standard deviation are content, and neighbouring ones form regions. The part of the page (an article, the
main element, or the rest of the body) with the most text in content regions is the main part. Of an article or main
element all lines are kept; elsewhere, those from the first to the last content region, without lines that are mostly
links.

Null or empty html gives an empty text. Broken markup is read as the parser reads it; text after an unclosed script or
comment is not content. Repeated pages give repeated rows. Pages of any length are read whole, one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import texts_of

BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea".split())
NEVER = RAW | frozenset("nav footer aside form menu dialog button select search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# whole words of a class or id, as cut at anything that is no letter or digit
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside rail widget widgets footer masthead topbar cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comments "
    "comment commentlist disqus respond replies reply pagination pager toolbar".split()
)
STATES = frozenset("has with no without is not".split())  # "has-sidebar" is said of what stands beside one
OF_CONTENT = frozenset("article post entry content story main title section".split())
# <p> and the like are closed by the next block
IMPLIED = {
    "p": BLOCKS - {"br", "button", "option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}
SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Line:
    part: int
    text: str
    tags: int
    linked: int


class LineVisitor(HTMLParser):
    """Turns parser events into lines. Keeps a stack of open elements, nothing of what is closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, int]] = []  # element, left out, part of the page
        self.kinds = ["body"]  # kind of each part
        self.words: list[str] = []
        self.tags = self.linked = self.links = 0

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.end_line()
            while self.stack and tag in IMPLIED.get(self.stack[-1][0], ()):
                self.stack.pop()
        self.tags += 1
        if tag in VOID:
            return
        skipped, part = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (False, 0)
        if not skipped and self.left_out(tag, attrs):
            if not block:
                self.end_line()
            skipped = True
        if tag in ("article", "main") or tag == "div" and ("role", "main") in attrs:
            if not skipped and not (tag == "main" and self.kinds[part] == "article"):
                if self.kinds[part] == "body" or tag == "article" and self.kinds[part] == "main":
                    self.kinds.append("article" if tag == "article" else "main")
                    part = len(self.kinds) - 1
        if tag == "a":
            self.links += 1
        self.stack.append((tag, skipped, part))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if self.stack[i][1] and tag not in BLOCKS:
                    self.words.clear()
                if tag == "a":
                    self.links = max(0, self.links - 1)
                del self.stack[i:]
                return
            if self.stack[i][0] in ("article", "main", "body") and tag not in ("body", "html"):
                return  # a stray end tag closes nothing beyond these

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][1]):
            self.words.append(data)
            if self.links:
                self.linked += len(data.strip())

    def end_line(self):
        text = SPACE.sub(" ", "".join(self.words)).strip()
        if text:
            self.lines.append(Line(self.stack[-1][2] if self.stack else 0, text, self.tags, self.linked))
            self.tags = 0
        self.words.clear()
        self.linked = 0

    def left_out(self, tag, attrs) -> bool:
        if tag in NEVER:
            return True
        if tag == "header":
            return not any(self.kinds[part] == "article" for _, _, part in self.stack[-1:])
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "role" and value in ROLES:
                return True
            if name in ("class", "id") and value and any(map(self.names_boilerplate, value.lower().split())):
                return True
        return False


    def names_boilerplate(self, token) -> bool:
        words = _WORDS.findall(token)
        if not words or words[0] in STATES:
            return False
        if "header" in words and not any(part for _, _, part in self.stack[-1:]):
            return OF_CONTENT.isdisjoint(words)
        return token == "hidden" or not BOILERPLATE.isdisjoint(words)


def smoothed_ratios(lines: list[Line], radius: int = 2) -> np.ndarray:
    """Text-to-tag ratios of the lines, smoothed by a Gaussian of the given radius (its edges are renormalised)."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(1, radius)) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius:radius + len(ratios)] / weights


def main_text(html: str, radius: int = 2, share: float = 0.5) -> str:
    """The page's main text; blocks are joined by one space."""
    visitor = LineVisitor()
    visitor.feed(html)
    visitor.close()
    visitor.end_line()
    lines = visitor.lines
    if not lines:
        return ""
    ratios = smoothed_ratios(lines, radius)
    content = ratios >= min(share * ratios.std(), ratios.max())
    weight: dict[int, int] = {}
    for line, inside in zip(lines, content):
        weight[line.part] = weight.get(line.part, 0) + inside * len(line.text)
    articles = {p: w for p, w in weight.items() if visitor.kinds[p] != "body"}
    if articles and max(articles.values()):
        best = max(articles, key=articles.get)
        return " ".join(line.text for line in lines if line.part == best)
    kept = [i for i in np.flatnonzero(content) if lines[i].linked * 2 < len(lines[i].text)]
    if not kept:
        return ""
    return " ".join(line.text for line in lines[kept[0]:kept[-1] + 1] if line.linked * 2 < len(line.text))


def text_extractor(radius: int = 2, share: float = 0.5) -> Callable:
    """A column function html -> main text."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(html, radius, share) for html in texts_of(batch)], type=pa.string())

    return extract


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text", radius: int = 2, share: float = 0.5) -> DataFrame:
    """Add the main text of ``html``."""
    return df.withColumn(text, text_extractor(radius, share)(F.col(html)))
