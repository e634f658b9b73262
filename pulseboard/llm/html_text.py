"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clustering.

The standard library's streaming parser turns a page into lines: a block-level
tag ends a line, inline tags only count towards the line's tags. Each line has
a text-to-tag ratio (characters per tag); the ratios are smoothed with a
Gaussian along the page and split in two clusters by the threshold between
their means (one-dimensional 2-means). Lines of the upper cluster seed content
regions, and a region grows to the container (article, main, section, body)
that holds its text. All lines of the chosen container are kept, short ones too. Lines within elements that never
hold text to read (scripts, styles, controls, hidden ones) are left out before.
An article or main element with over half of the content regions is such a
container; without one it is the deepest element that holds them all, and it
grows to the neighbours of that element and of its ancestors that are running
text (paragraphs, or long lines, with few links), whatever their density, so
that a section of shorter paragraphs is kept beside one of longer ones.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are marked, by tag, role or class and id tokens, and left out before too, nested articles
as well. A token is a mark if each of its words is a mark or a companion (``share-links``, not
``has-sidebar`` or ``related-work``). Inline elements have no marks, nor have
paragraphs and headings within an article or main element. A mark is evidence
only: it is lifted from the element that holds most of the page's prose while
little text stands outside (a page wrapped in one form). Menus, footers, asides
and comments are lifted only if no text stands outside.

Cases: null or empty html gives an empty text; a page without markup is one
block; unclosed, crossed or missing end tags close with their parents; tag
soup never raises; equal scores go to the deeper, then the earlier container;
repeated rows, null ids, empty tables and extra columns are ordinary (columns
named text or n_chars are replaced).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import table

#: HTML element names by role.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINER = frozenset("article main section body td div".split())
NAMED = frozenset(("article", "main"))
NEVER = frozenset(
    "head script style noscript template iframe object svg math canvas audio video button select textarea label title".split())
MARKED = frozenset("nav header footer aside form dialog menu".split())
#: Text blocks: in an article or main element no class marks them, elsewhere only ``TEXT_MARKS`` do.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption caption dt dd tr th thead tbody tfoot".split())
PARAGRAPH = frozenset("p pre blockquote dd figcaption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"html", "body", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "caption"}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
#: Words in a class or id that mark what is not main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget footer header masthead cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe signup login share sharing social related recommended comment comments respond replies disqus "
    "pagination pager copyright legal hidden".split())
TEXT_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs cookie cookies consent gdpr newsletter subscribe share sharing pagination pager copyright footer".split())
#: Marks that are lifted only if no text stands outside.
STRICT = frozenset("nav footer aside dialog menu comment comments respond replies disqus".split())
#: Words that may stand beside a mark in a token; single letters may too.
COMPANIONS = frozenset(
    "js site page main global top bottom left right upper lower primary secondary mobile desktop wrapper wrap container inner "
    "outer box bar block panel pane region area row col column list lists link links group holder module component media post "
    "posts article articles story stories item items button buttons btn icon icons form thread section slot unit zone space "
    "google gpt dfp message msg logo trail body text title toggle window dialog".split())
_WORDS = re.compile(r"[A-Za-z]+")
_BLANK = re.compile(r"\s+")
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")  # a tag that the page's end cuts off is no text
SIGMA = 2.0
#: Least characters of running text in a paragraph and elsewhere.
SHORT, LONG = 30, 80


def _is_mark(token: str, marks: frozenset[str]) -> bool:
    w = _WORDS.findall(token)
    return not marks.isdisjoint(w) and all(x in MARKS or x in COMPANIONS or len(x) == 1 for x in w)


def _hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in NEVER:
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and tag not in BLOCK and (value or "").lower() in ROLES:
            return True
        if name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _mark(tag: str, attrs: list[tuple[str, str | None]], named: bool) -> str:
    """What marks an element ("form", "strict", "class"), or an empty text."""
    if tag in MARKED:
        return "form" if tag in ("form", "header") else "strict"
    if not attrs or tag not in BLOCK or tag in ("body", "html", "main"):
        return ""
    textual = tag in TEXTUAL or named and tag == "td"
    marks = MARKS if not textual else frozenset() if named or tag in HEADING else TEXT_MARKS
    kind = ""
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.lower().split():
                if _is_mark(token, marks):
                    if not STRICT.isdisjoint(_WORDS.findall(token)):
                        return "strict"
                    kind = "class"
        elif name == "role" and tag != "article" and (value or "").lower() in ROLES:
            kind = kind or ("form" if value.lower() == "form" else "class")
    return kind


class _Lines(HTMLParser):
    """Lines of a page: text, tags, container, innermost mark, characters in links, block element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int, bool, bool]] = []  # tag, left out, container, mark, in a link, in article or main
        self.parents, self.kinds = [-1], ["html"]  # of each container
        self.outer, self.why = [-1], [""]  # of each mark; 0 is no mark
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.lines: list[tuple[str, int, int, int, int, str]] = []  # text, tags, container, mark, characters in links, block

    def _here(self) -> tuple[bool, int, int, bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, 0, 0, False, False)

    def _end_line(self) -> None:
        if self.text:
            text = _BLANK.sub(" ", "".join(self.text)).strip()
            if text:
                _, container, mark, _, _ = self._here()
                block = next((e[0] for e in reversed(self.stack) if e[0] in BLOCK), "")
                self.lines.append((text, self.tags, container, mark, self.linked, block))
            self.text = []
            self.tags = self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_line()
            if tag in CLOSES_P:
                self._close_p()
            elif tag in ("li", "dd", "dt", "option", "tr", "td", "th"):
                self._close_same(tag)
        self.tags += 1
        if tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        out, container, mark, link, named = self._here()
        out = out or _hidden(tag, attrs)
        if tag in CONTAINER and not out:
            self.parents.append(container)
            self.kinds.append(tag)
            container = len(self.parents) - 1
        if not out and (why := _mark(tag, attrs, named)):
            self.outer.append(mark)
            self.why.append(why)
            mark = len(self.outer) - 1
        self.stack.append((tag, out, container, mark, link or tag == "a", named or tag in NAMED))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: the slash means nothing but on void elements

    def _cut(self, k: int) -> None:
        del self.stack[k:]

    def _close_p(self) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag == "p":
                return self._cut(k)
            if tag in BLOCK:
                return

    def _close_same(self, tag: str) -> None:
        group = ("dd", "dt") if tag in ("dd", "dt") else ("td", "th") if tag in ("td", "th") else (tag,)
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in group:
                return self._cut(k)
            if self.stack[k][0] in ("ul", "ol", "dl", "table", "select", "menu", "body", "article", "div"):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                return self._cut(k)
            if tag not in BLOCK and self.stack[k][0] in BLOCK:
                return  # a stray inline end tag closes no block

    def handle_data(self, data: str) -> None:
        here = self._here()
        if not here[0]:
            self.text.append(data)
            if here[3]:
                self.linked += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._end_line()


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = math.ceil(2 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_cut(values: np.ndarray) -> float:
    """Threshold between two clusters of the values (2-means from their ends)."""
    low, high = float(values.min()), float(values.max())
    while True:
        cut = (low + high) / 2
        upper = values >= cut
        a, b = (float(values[~upper].mean()) if not upper.all() else low), float(values[upper].mean())
        if a == low and b == high:
            return cut
        low, high = a, b


def _prose(line: tuple[str, int, int, int, int, str]) -> bool:
    """Is a line running text: a paragraph, or long, and few links."""
    text, linked, block = line[0], line[4], line[5]
    return 3 * linked < len(text) and len(text) >= (SHORT if block in PARAGRAPH else LONG)


def _lifted(page: _Lines) -> list[bool]:
    """Of each mark: is it lifted, so that its element may hold main text."""
    n = len(page.outer)
    own, prose, lines, direct = [0] * n, [0] * n, [0] * n, [0] * n
    total, named = 0, False  # named: prose in an unmarked article or main element
    kinds = set()
    for line in page.lines:
        m, size, good = line[3], len(line[0]), _prose(line)
        direct[m] += size
        total += size * good
        if good and m == 0:
            kinds.add(line[2])
        while m >= 0:
            own[m] += size
            prose[m] += size * good
            lines[m] += good
            m = page.outer[m]
    for c in kinds:
        while c >= 0 and not named:
            named = page.kinds[c] in NAMED
            c = page.parents[c]
    lifted, free = [True] + [False] * (n - 1), direct[0]
    for m in range(1, n):
        why = page.why[m]
        if lifted[page.outer[m]] and lines[m] and 2 * prose[m] > total and (
                free == 0 and lines[m] > 1 if why == "strict" else not named and prose[m] > (free if why == "form" else 3 * free)):
            lifted[m] = True
            free += direct[m]
    if not free:  # every piece is marked: the best guess are the elements that are mostly prose
        for m in range(1, n):
            lifted[m] = lifted[m] or lifted[page.outer[m]] and page.why[m] != "strict" and lines[m] > 0 and 2 * prose[m] > own[m]
    return lifted


def _counts(line: tuple[str, int, int, int, int, str]) -> tuple[int, int, int, int]:
    """Headings; characters of other lines; those of prose; and those of prose or of short lines with few links."""
    n = len(line[0])
    if line[5] in HEADING:
        return 1, 0, 0, 0
    prose = _prose(line)
    return 0, n, n * prose, n * (prose or 3 * line[4] < n and n >= SHORT)


def _is_text(headings: int, size: int, prose: int, short: int) -> bool:
    """Is a region running text: over half of its characters are prose; under a heading, short lines count too."""
    return 2 * (short if headings else prose) > size


def _grow(page: _Lines, best: int, kept: list[bool]) -> None:
    """Keeps the regions beside ``best`` and its ancestors that are running text; of others, those within them."""
    counts = [(0, 0, 0, 0)] * len(page.parents)
    for line in page.lines:
        counts[line[2]] = tuple(map(add, counts[line[2]], _counts(line)))
    for c in range(len(counts) - 1, 0, -1):
        counts[page.parents[c]] = tuple(map(add, counts[page.parents[c]], counts[c]))
    path, c = set(), best
    while c >= 0:
        path.add(c)
        c = page.parents[c]
    whole = [False] * len(counts)
    for c in range(1, len(counts)):
        whole[c] = c not in path and (whole[page.parents[c]] or _is_text(*counts[c]))
    for c, run in groupby(range(len(kept)), key=lambda k: page.lines[k][2]):
        run = list(run)
        if not kept[run[0]]:
            text = whole[c] or _is_text(*map(sum, zip(*(_counts(page.lines[k]) for k in run))))
            for k in run:  # a line between regions stands for itself
                kept[k] = text or _prose(page.lines[k])
    for k in range(len(kept) - 2, -1, -1):  # a heading goes with what follows it
        kept[k] = kept[k] or page.lines[k][5] in HEADING and kept[k + 1]


def main_text(html: str) -> str:
    page = _Lines()
    page.feed(_CUT_TAG.sub("", html))
    page.finish()
    if len(page.outer) > 1:
        lifted = _lifted(page)
        page.lines = [line for line in page.lines if lifted[line[3]]]
    if not page.lines:
        return ""
    weight = smoothed(np.array([len(t) / max(1, n) for t, n, *_ in page.lines], dtype=np.float64))
    seed = weight >= content_cut(weight)
    depth = [0] * len(page.parents)
    for c in range(1, len(page.parents)):
        depth[c] = depth[page.parents[c]] + 1
    gain = [0.0] * len(page.parents)  # content characters of seeds within the container
    for (text, _, c, *_), s in zip(page.lines, seed):
        while c >= 0:
            gain[c] += len(text) if s else 0
            c = page.parents[c]
    whole = max(gain)
    # an article or main element with most of the content regions, else the deepest container of all of them
    named = [c for c, kind in enumerate(page.kinds) if kind in NAMED and gain[c] > whole / 2]
    best = min(named or (c for c in range(len(gain)) if gain[c] == whole), key=lambda c: (-depth[c], c))

    inside = [c == best for c in range(len(page.parents))]
    for c in range(best + 1, len(inside)):
        inside[c] = inside[page.parents[c]]
    kept = [inside[line[2]] for line in page.lines]
    if best and not named:
        _grow(page, best, kept)
    return "\n".join(line[0] for line, k in zip(page.lines, kept) if k)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars."""
    keep = [f for f in pages.schema if f.name.lower() not in (html.lower(), "text", "n_chars")]
    schema = StructType([*keep, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h.as_py() or "") for h in b.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in keep], pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=schema.names)

    rows = pages.select(*[f.name for f in keep], F.col(html).alias("_html"))
    return rows.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
