"""Main text of HTML pages by line-block distribution.

Markup is stripped first: a page becomes lines, one per block element, and each line knows whether it lies in an article
and whether it lies in something that is never article text (menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts, styles; by element, role, class or id). Lines of the latter kind count no characters, and neither do
lines that are mostly links. The sums of line lengths over sliding windows of ``WINDOW`` lines then show where text is: a
surge point is a line at which the windows begin to hold text, a dive point the line after which they hold none, and all
counted lines between surge and dive are kept, short ones and headings included. A window holds text if it reaches ``LEAST``
characters, so a lone caption or date outside any text does not count; if no window does, the largest one is kept. In a
weighty article (below) a stretch that reaches this goes on until the windows are empty, so poems and dialogues stay whole,
and linked paragraphs between its first and last line of text are kept.

Classes and ids of containers (not of paragraphs, headings, items and cells) are read word by word, except those that say what a page has (``no-sidebar``, ``with-comments``,
``share-enabled``); of an ``<article>`` only the first word of each counts, as the others are often its topics. Such a word
does not rule out an element that holds ``<main>`` or at least ``MOST`` of the text, of the page or, where one is heavy
enough in the sense below, of the largest article that no word of its own rules out. Forms are treated like such a word.

An article (``<article>`` or ``<main>``) is a weight: its characters count ``ARTICLE`` times, provided that, so weighed, it
holds as much as all lines outside it. A teaser card beside a body in plain elements does not, and is judged like any other
line. Lines inside and outside are summed by themselves, so that a line beside the article does not pass by the article's text.
A headline of an article that is a link counts nothing, but is kept where the windows hold text.

Scale: one pass without a shuffle; rows are independent. A page takes time in proportion to its length, nesting included.

Defined cases: null and empty html give an empty text. Repeated rows are extracted each. Elements left open close with
their parents or at the end of the page, so cut pages keep what they hold.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
LEAST = 60
ARTICLE = 5
MOST = 0.8

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?[A-Za-z][^\s/>]*(?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+(?:>|\Z)",  # quotes count only after an equals sign
    re.S,
)
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# Element names.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea title".split())
NEVER = frozenset(
    "head nav header footer aside form button select menu dialog fieldset noscript template iframe object svg script style "
    "textarea title canvas audio video math".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar side aside widget widgets footer header masthead topbar cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments respond disqus reply replies share sharing social related recommended recommendations pagination "
    "pager toolbar skip tags copyright legal disclaimer form search".split()
)
# elements that rule lines out unless they hold most of the text: pages whose body is one form exist
SOFT = frozenset("form fieldset".split())
# elements that hold text and no layout: their classes say how it looks
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th b i em strong blockquote pre".split())
# words that count only by themselves: side-by-side, social-history, search-results-analysis
VAGUE = frozenset("side social search form legal tags related alert notice share skip".split())
# first and last words of classes that say what a page has, not what the element is
HAS = frozenset("no not non has have with without".split())
ABLE = frozenset("enabled disabled".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# p and li close an open one of their own kind
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def words_of(value: str, first_only: bool) -> set[str]:
    """The words of a class or id that say what an element is."""
    found: set[str] = set()
    for token in value.split():
        parts = [x for x in re.split(r"[^a-z0-9]+", token) if x]
        if parts and parts[0] not in HAS and parts[-1] not in ABLE:
            found.update(parts[:1] if first_only else (p for p in parts if len(parts) == 1 or p not in VAGUE))
    return found


def never_text(name: str, tag: str) -> tuple[str, bool]:
    """Why an element is no article text (empty if it may be), and whether only a word of its class or id says so."""
    if name in NEVER:
        return name, name in SOFT
    if name in ("body", "html", "main") or len(tag) <= len(name) + 2:
        return "", False
    worded = ""
    for key, value in ATTRIBUTE.findall(tag):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return "hidden", False
        if key == "role" and value in ROLES:
            return value, False
        if key == "style" and "display:none" in value.replace(" ", ""):
            return "hidden", False
        if not worded and key in ("class", "id") and name not in PLAIN:
            worded = min(WORDS & words_of(value, name == "article"), default="")
    return worded, bool(worded)


class Scope(NamedTuple):
    """An element that may rule lines out, or an article: the scope around it, why, and whether only a word of it says so."""

    parent: int
    why: str
    soft: bool
    article: bool


class Line(NamedTuple):
    """A line: its text, the scope it lies in, whether it lies in an article or main, is a heading, a paragraph, its links."""

    text: str
    scope: int
    inside: bool
    heading: bool
    paragraph: bool
    linked: int


class Lines:
    """Lines of a page; rows are [text, in article, never text, characters in links, heading].

    Open elements are counted as they open and close, and scopes form a tree that is summed once, so a page takes time in
    proportion to its length however deep its elements nest.
    """

    def __init__(self) -> None:
        self.found: list[Line] = []
        self.open: list[tuple[str, int]] = []  # name, scope
        self.places: dict[str, list[int]] = {}  # of open elements by name
        self.blocks: list[int] = []  # places of open blocks
        self.parts: list[str] = []
        self.linked = 0
        self.scopes = [Scope(-1, "", False, False)]
        self.keep: set[int] = set()  # soft scopes that rule nothing out

    def is_open(self, *names: str) -> bool:
        return any(self.places.get(n) for n in names)

    def rows(self) -> list[tuple[str, bool, bool, int, bool]]:
        self.judge()
        # 0: may be text; 1: only the header of an article is around it; 2: ruled out
        state, headed = [0], [False]
        for k, scope in enumerate(self.scopes[1:], 1):
            off = scope.why and not (scope.soft and k in self.keep)
            in_article = headed[scope.parent]
            state.append(max(state[scope.parent], (1 if scope.why == "header" and not scope.soft else 2) if off else 0))
            headed.append(in_article or scope.article)
        rows = []
        for line in self.found:
            at = state[line.scope]
            # headline and standfirst in an article's own header are part of the article
            own = at == 1 and line.inside and (line.heading or (line.paragraph and headed[line.scope]))
            rows.append((line.text, line.inside, at > 0 and not own, line.linked, line.heading))
        return rows

    def judge(self) -> None:
        """Find the softly ruled elements that hold most of the text of the article or the page."""
        hard = [False]
        for scope in self.scopes[1:]:
            hard.append(hard[scope.parent] or bool(scope.why and not scope.soft))
        counted = [line for line in self.found if not hard[line.scope] and 2 * line.linked <= len(line.text)]

        def held(lines: list[Line]) -> list[int]:
            sizes = [0] * len(self.scopes)
            for line in lines:
                sizes[line.scope] += len(line.text)
            for k in range(len(sizes) - 1, 0, -1):
                sizes[self.scopes[k].parent] += sizes[k]
            return sizes

        sizes = held(counted)
        total = sizes[0]
        articles = [k for k, scope in enumerate(self.scopes) if scope.article and not scope.why]
        if articles:
            largest = max(articles, key=sizes.__getitem__)
            if sizes[largest] and ARTICLE * sizes[largest] >= total - sizes[largest]:
                within = [False] * len(self.scopes)
                for k in range(largest, len(self.scopes)):
                    within[k] = k == largest or within[self.scopes[k].parent]
                counted, total = [line for line in counted if within[line.scope]], sizes[largest]
                sizes = held(counted)
        self.keep.update(k for k, scope in enumerate(self.scopes) if scope.soft and total and sizes[k] >= MOST * total)

    def text(self, raw: str) -> None:
        self.parts.append(raw)
        if self.is_open("a"):
            self.linked += len(raw.strip())

    def end_line(self) -> None:
        line = " ".join(html.unescape("".join(self.parts)).split())
        if line:
            scope = self.open[-1][1] if self.open else 0
            self.found.append(
                Line(line, scope, self.is_open("article", "main"), self.is_open(*HEADINGS), self.is_open("p"), self.linked)
            )
        self.parts, self.linked = [], 0

    def close_from(self, place: int) -> None:
        for at in range(len(self.open) - 1, place - 1, -1):
            self.places[self.open[at][0]].pop()
        del self.open[place:]
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def start(self, name: str, tag: str) -> None:
        if name in BLOCKS:
            self.end_line()
        closed = CLOSES.get(name)
        if closed and self.open and self.open[-1][0] in closed:
            self.close_from(len(self.open) - 1)
        elif name in BLOCKS and name not in ("li", "dd", "dt", "td", "th", "tr", "option"):
            # a block ends an open paragraph, whatever inline elements are open in it
            if self.blocks and self.open[self.blocks[-1]][0] == "p":
                self.close_from(self.blocks[-1])
        if name == "br" or name == "img":
            self.parts.append(" ")
        if name in VOID:
            return
        scope = self.open[-1][1] if self.open else 0
        why, soft = never_text(name, tag)
        if name == "main":
            k = scope
            while k > 0 and k not in self.keep:
                if self.scopes[k].soft:
                    self.keep.add(k)
                k = self.scopes[k].parent
        if why or name == "article":
            self.scopes.append(Scope(scope, why, soft, name == "article"))
            scope = len(self.scopes) - 1
        self.places.setdefault(name, []).append(len(self.open))
        if name in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((name, scope))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.end_line()
        places = self.places.get(name)
        # a stray inline end tag does not close blocks
        if places and (name in BLOCKS or not self.blocks or places[-1] > self.blocks[-1]):
            self.close_from(places[-1])


def page_lines(page: str) -> list[tuple[str, bool, bool, int, bool]]:
    lines, at = Lines(), 0
    while True:
        match = TOKEN.search(page, at)
        if not match:
            lines.text(page[at:])
            break
        if match.start() > at:
            lines.text(page[at : match.start()])
        tag, at = match[0], match.end()
        if tag[1] in "!?":
            continue
        name = NAME.match(tag)[1].lower()
        if tag[1] == "/":
            lines.end(name)
            continue
        if name in RAW and not tag.endswith("/>"):
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        lines.start(name, tag)
    lines.end_line()
    return lines.rows()


def stretches(sums: list[int], enough: int, least: int) -> list[tuple[int, int]]:
    """(surge, dive) of each stretch of windows that reaches ``enough`` somewhere and ``least`` everywhere."""
    found, at = [], 0
    while at < len(sums):
        start, high = at, 0
        while at < len(sums) and sums[at] >= least:
            high, at = max(high, sums[at]), at + 1
        if high >= enough:
            found.append((start, at))
        at = max(at, start + 1)
    return found


def main_text(page: str | None, window: int = WINDOW, least: int = LEAST) -> str:
    """The kept lines of one page, joined by line breaks."""
    rows = page_lines(page or "")
    n = len(rows)
    sizes = [0 if never or 2 * linked > len(line) else len(line) for line, _, never, linked, _ in rows]
    article = sum(size for size, row in zip(sizes, rows, strict=True) if row[1])
    weight = ARTICLE if ARTICLE * article >= sum(sizes) - article else 1
    sides = []
    for side in (True, False):
        mine = [(weight if side else 1) * size if row[1] == side else 0 for size, row in zip(sizes, rows, strict=True)]
        # window i covers lines i to i + window - 1, from before the first line to the last one
        sides.append((side, [sum(mine[max(0, i) : i + window]) for i in range(1 - window, n)]))
    enough = max(1, min(least, max((max(sums, default=0) for _, sums in sides))))
    kept = [False] * n
    for side, sums in sides:
        # of a weighty article short lines belong to the text until the windows are empty, and its stretches are one
        whole = side and weight > 1
        found = stretches(sums, enough, 1 if whole else enough)
        for surge, dive in [(found[0][0], found[-1][1])] if whole and found else found:
            lines = range(max(0, surge + 1 - window), min(n, dive))
            text = [i for i in lines if rows[i][1] == side and (sizes[i] > 0 or (side and rows[i][4] and not rows[i][2]))]
            # what lies between the first and the last line of text is kept, links as well
            for i in range(text[0], text[-1] + 1) if text else ():
                kept[i] |= rows[i][1] == side and not rows[i][2] and (side or sizes[i] > 0)
    return "\n".join(row[0] for row, keep in zip(rows, kept, strict=True) if keep)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the html column, plus the main text."""
    rest = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower())]
    thin = pages.select(*rest, html_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[rest].copy()
            out[text_col] = [main_text(h if isinstance(h, str) else "") for h in pdf[html_col]]
            yield out

    return thin.mapInPandas(run, thin.select(*rest).withColumn(text_col, F.lit("")).schema)
