"""Main text of web pages by text-to-tag ratios over a stream of parser events.

The standard library's parser streams through a page. Block elements end a line; a line has its
text, the number of tags met in it and the elements around it. The ratio of characters to tags of
each line is smoothed by a Gaussian over its neighbours, and a threshold from two-means clustering
tells lines of content from the others. The element that holds most of the content found so, widened
to the article or main element or else to the outermost below the body, is the region: its lines are
the text, short ones too, as are those of all other regions that hold content, and lines of content that
are in none. Without such an element all lines are. Left out is what is within menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments, by element, role, class or id, and lines outside an
article that are mostly links. Words of a class or id that also name parts of a text (DOUBTFUL) leave an element
out only if most of its characters are in lines that are not content, or in links; the id of a heading says nothing.

Defined results: a null page counts as empty and has an empty text, as has a page without content.
White space (as in str.split) within a line becomes one space. Markup that is never closed ends
with the elements around it or the page. Repeated rows and null ids are kept; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourboard.llm.shared import read

# Elements and words of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED = frozenset(
    "aside audio button canvas dialog footer form head header iframe input menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
HINTS = frozenset(
    "ad ads advert advertisement adverts breadcrumb breadcrumbs comment comments cookie cookies "
    "disqus gdpr masthead navbar popup promo sidebar signup topbar".split()
)
DOUBTFUL = frozenset(
    "advertising banner consent discussion footer header menu modal nav navigation newsletter notice "
    "related reply respond share sharing social sponsor sponsored subscribe toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose class or id says nothing about their being content.
WHOLE = frozenset("html body main article".split())
#: Elements a region can be, besides article and main.
REGIONS = frozenset("center div fieldset section table".split())
#: Elements that end an open one of the same kind.
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset("ul ol dl table menu select".split())

#: Neighbours on each side, and the width of the Gaussian, in lines.
REACH, WIDTH = 2, 1.0
#: Share of the content's characters an element has to hold to be the region's core.
MOST = 0.6
UNCLOSED = re.compile(r"<[!/?a-zA-Z]")
WORD = re.compile(r"[a-z]+")


def hint(tag: str, attributes: list[tuple[str, str | None]]) -> str | None:
    """Whether an element is ``skipped`` or ``doubtful``, or neither."""
    if tag in SKIPPED:
        return "skipped"
    if tag in WHOLE:
        return None
    found = None
    for name, value in attributes:
        value = (value or "").lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return "skipped"
        if name == "class" or name == "id" and tag not in HEADINGS:
            words = WORD.findall(value)
            if not HINTS.isdisjoint(words):
                return "skipped"
            if not DOUBTFUL.isdisjoint(words):
                found = "doubtful"
    return found


class Lines(HTMLParser):
    """Lines of a page: ``(text, tags, characters in links, elements around, skipped)``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int, int, tuple[int, ...], bool]] = []
        self.names: list[str] = []  # of all elements, by number
        self.doubtful: set[int] = set()
        self.open: list[tuple[str, int, bool]] = []  # name, number, skipped
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            skipped = bool(self.open) and self.open[-1][2]
            self.found.append((text, self.tags, self.linked, tuple(number for _, number, _ in self.open), skipped))
        self.parts, self.tags, self.linked = [], 0, 0

    def leave(self, names: tuple[str, ...], bounds: frozenset[str]) -> None:
        """Closes the nearest open element of ``names``, unless one of ``bounds`` lies between."""
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name in names:
                self.links -= sum(x[0] == "a" for x in self.open[depth:])
                del self.open[depth:]
                return
            if name in bounds:
                return

    def handle_starttag(self, tag, attrs):
        said = hint(tag, attrs)
        skipped = said == "skipped"
        if tag in BLOCKS or (said and not (self.open and self.open[-1][2])):
            self.end_line()
            self.leave(("p",), frozenset(("button",)) | WHOLE)
            if tag in ITEMS:
                self.leave(ITEMS[tag], LISTS)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag not in VOID:
            self.links += tag == "a"
            self.open.append((tag, len(self.names), skipped or bool(self.open) and self.open[-1][2]))
            if said == "doubtful":
                self.doubtful.add(len(self.names))
            self.names.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        mine = next((x for x in reversed(self.open) if x[0] == tag), None)
        above = self.open[self.open.index(mine) - 1][2] if mine and self.open.index(mine) else False
        if tag in BLOCKS or (mine and (mine[2] or mine[1] in self.doubtful) and not above):
            self.end_line()
        self.tags += 1
        if mine:
            self.leave((tag,), frozenset())
        elif tag == "br":
            self.parts.append(" ")

    def handle_data(self, data):
        self.parts.append(data)
        if self.links > 0:
            self.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    weights = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / WIDTH) ** 2)
    return np.convolve(np.pad(ratios, REACH, mode="edge"), weights / weights.sum(), mode="valid")


def content(ratios: np.ndarray) -> np.ndarray:
    """Which lines are content: those nearer to the higher of two means."""
    low, high = ratios.min(), ratios.max()
    above = np.ones(len(ratios), bool)
    while low < high:
        above = ratios > (low + high) / 2
        means = ratios[~above].mean(), ratios[above].mean()
        if means == (low, high):
            break
        low, high = means
    return above


def left_out(parser: Lines, above: np.ndarray) -> np.ndarray:
    """Which lines are within what is skipped, of content (``above``) or not."""
    sizes: dict[int, list[int]] = {}
    for (text, _, linked, around, skipped), high in zip(parser.found, above, strict=True):
        for element in parser.doubtful.intersection(around) if not skipped else ():
            held = sizes.setdefault(element, [0, 0, 0])
            held[0] += len(text)
            held[1] += len(text) if high else 0
            held[2] += linked
    no_text = {element for element, (size, high, linked) in sizes.items() if 2 * high < size or 2 * linked > size}
    return np.array([skipped or not no_text.isdisjoint(around) for *_, around, skipped in parser.found], bool)


def region_of(names: list[str], path: tuple[int, ...]) -> int | None:
    """The outermost article or main element of a path, or else the outermost that a region can be."""
    wide = [x for x in path if names[x] in ("article", "main")]
    inner = [x for x in path if names[x] in REGIONS]
    return wide[0] if wide else inner[0] if inner else None


def main_text(html: str | None) -> str:
    """The main text of a page."""
    parser = Lines()
    parser.feed(html or "")
    if UNCLOSED.match(parser.rawdata):
        parser.rawdata = ""  # a tag or comment that never ends
    parser.close()
    parser.end_line()
    lines = parser.found
    if not any(not line[4] for line in lines):
        return ""
    above = content(smoothed(np.array([len(text) / max(1, tags) for text, tags, *_ in lines])))
    out = left_out(parser, above)
    seeds = np.flatnonzero(above & ~out)
    if not len(seeds):
        seeds = np.flatnonzero(~out)
    held: dict[int, int] = {}
    for i in seeds:
        for element in lines[i][3]:
            held[element] = held.get(element, 0) + len(lines[i][0])
    total = sum(len(lines[i][0]) for i in seeds)
    core = max((element for element, size in held.items() if size >= MOST * total), default=None)
    region = None
    if core is not None:
        path = next(lines[i][3] for i in seeds if core in lines[i][3])
        region = region_of(parser.names, path[: path.index(core) + 1])
    # Without one region for most of the content there is no saying what lies outside.
    regions = {region_of(parser.names, lines[i][3]) for i in seeds} | {region} if region is not None else set()
    chosen = set(seeds.tolist())
    kept = []
    for i, (text, _, linked, around, _) in enumerate(lines):
        own = next((x for x in around if x in regions), None)
        if out[i] or (regions and own is None and i not in chosen):
            continue
        article = own is not None and parser.names[own] in ("article", "main")
        if not article and not above[i] and 2 * linked > len(text):
            continue
        kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` of every row."""

    def run(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return rows.mapInArrow(run, f"{id_col} long, {url_col} string, text string, n_chars long")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
