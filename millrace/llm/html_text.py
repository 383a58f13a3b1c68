"""HTML extraction by line-block distribution.

Markup is stripped into lines, one per block of the page: where block elements begin and end, lines do. Every
page is then judged by the distribution of its text over the lines; what its tags and classes say goes into
the weights (:func:`line_weights`):

* Scripts, styles, comments, hidden elements, menus, headers, footers and sidebars by their tags or roles give
  no line. Elements that by class or id are notices, adverts, forms or reader comments weigh nothing, and so
  does all below a last heading "Comments" that has half of the text above it. A word that may mean something else counts only if it makes up half
  of its name, and not beside words of state ("comments-open"). If a form, or an element so named, holds nearly
  all the text in paragraphs, it is the text.
* If ``article`` or ``main`` elements hold a title or a part of the text (``TRUSTED``), their lines weigh enough
  to surge by themselves and lines outside weigh nothing; what stands in ``main`` beside its articles
  counts if it is a heading or paragraph. Else these tags say nothing (a teaser).
* Any other line weighs the length of its text less that of its links.

The weights of ``WINDOW`` lines are summed from each line on and up to each line. Where the larger sum first
reaches a threshold of the page's own the text surges, where it is last reached it dives, and all lines between
that weigh something or are short, listed or linked there are kept. A list or table that the dive cuts is kept
whole. At the two ends, lines that are links only, are short and no sentence, heading or paragraph, or are
notices of rights and cookies are left out.

A line is its text with character references decoded, white space turned into one space, and trimmed;
lines are joined by one line feed. Nothing else is dropped or cut.

Each page is worked on alone, in one pass over its tags; memory is bounded by the longest page. Defined
results: NULL, empty or text-free html gives the empty string; html without tags is one line; unclosed
and misnested tags are taken as browsers do for blocks; repeated rows give repeated results; further
columns pass through :func:`extracted`.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name

WINDOW = 3
# The threshold is this part of the page's mean window sum.
SURGE = 0.5
# Article and main elements are believed if they hold this part of the page's text, or a title.
TRUSTED = 0.1
# A marked element is the text if it holds so many characters, and so many times those of the rest.
LEAST_TEXT = 200
MOST_OF_TEXT = 4

# Elements by what becomes of them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "textarea", "select", "button", "object", "canvas", "audio", "video", "head", "title")
SKIPPED = frozenset("nav footer aside header menu dialog".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Words in a class or id that mark an element wherever they stand, and those that mark it if they are half of its words.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer masthead cookie cookies consent gdpr popup modal overlay newsletter subscribe disqus pagination"
    " pager toolbar commentlist".split()
)
WEAK_MARKS = frozenset(
    "banner header notice notices notification alert promotion subscription signup login comment comments reply replies respond"
    " share sharing social related recommended widget skip".split()
)
# Words of a name that say nothing of its kind.
NEUTRAL_WORDS = frozenset(
    "article block area box container content entry inner item js list main outer page post section single site wp wrap wrapper".split()
)
# Beside these a word speaks of a layout or a state, as "with-sidebar"; or of an article's own head.
LAYOUT_WORDS = frozenset("with has no layout open closed enabled disabled allowed on off".split())
HEAD_WORDS = frozenset("article post entry content story title".split())
# An article or main element is marked only by these; text so marked is never the page's text.
NO_ARTICLE_WORDS = frozenset("comment comments ad ads advert advertisement sponsor promo related".split())
NEVER_TEXT = NO_ARTICLE_WORDS | frozenset("adverts advertising sponsored commentlist disqus reply replies respond cookie cookies consent gdpr".split())
# Text that the dive may not cut in two.
WHOLE_BLOCKS = ("ul", "ol", "dl", "table", "pre")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# A line of links in one of these is text.
TEXT_BLOCKS = ("p", *HEADINGS)
# An open p ends where one of these begins; li, dt/dd, options and table parts end at the next of their kind.
CLOSED_BY_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rawattrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)[^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE) for name in RAW}
_BODY = re.compile(r"</head\s*>|<body\b", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")
_RIGHTS = re.compile(r"^(?:©|\(c\) |copyright\b)|\ball rights reserved\b|\b(?:use|uses|using) cookies\b|^accept(?: all)?(?: cookies)?$", re.IGNORECASE)
_COMMENTS = re.compile(r"(?:\d+ )?(?:(?:reader|user) )?comments?(?: \(\d+\))?:?|\d+ (?:replies|responses)", re.IGNORECASE)


def _words_mark(name: str, value: str) -> set[str]:
    """The words of a class or id that mark an element as no part of the main text."""
    marks = NO_ARTICLE_WORDS if name in ("article", "main") else MARKS | WEAK_MARKS
    for part in value.split():
        words = _WORD.findall(part)
        found = marks.intersection(words)
        if not found or LAYOUT_WORDS.intersection(words) or found == {"header"} and HEAD_WORDS.intersection(words):
            continue
        telling = [w for w in words if w in found or not (w in NEUTRAL_WORDS or w.isdigit())]
        if found & MARKS or 2 * sum(w in found for w in telling) >= len(telling):
            return found
    return set()


def _marked_as_other(name: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element gives no lines, is marked as no part of the main text, and cannot be it for all that."""
    if name in ("body", "html"):
        return False, False, False
    if name in SKIPPED:
        return True, False, False
    marked, never = name == "form", False
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in SKIPPED_ROLES):
            return True, False, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False, False
        if key in ("class", "id"):
            found = _words_mark(name, value)
            marked, never = marked or bool(found), never or bool(found & NEVER_TEXT)
    return False, marked, never


class _Page:
    """Lines of a page while its tags go by."""

    def __init__(self):
        self.lines: list[str] = []
        self.lengths: list[int] = []  # without links
        self.blocks: list[str] = []  # p or heading around, else empty
        self.owners: list[int] = []  # 0: none, else the number of the article or main around
        self.within: list[tuple[int, ...]] = []  # marked elements around
        self.wholes: list[int] = []  # 0: none, else the number of the outermost list or table around
        self.kinds: list[str] = [""]
        self.mains: list[int] = [0]  # of each article or main the main around
        self.never: list[bool] = []  # of each marked element whether it cannot be the text
        self.open: list[tuple[str, bool, bool, int]] = []  # name, whether skipped, whether marked, owner outside
        self.opened: Counter[str] = Counter()
        self.marks: tuple[int, ...] = ()
        self.skipping = 0
        self.owner = 0
        self.whole = self.whole_depth = 0
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def text(self, text: str) -> None:
        if not self.skipping:
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def end_line(self) -> None:
        if self.parts:
            line = " ".join(html.unescape("".join(self.parts)).split())
            if line:
                self.lines.append(line)
                self.lengths.append(max(len(line) - self.linked, 0))
                self.blocks.append(next((x for x in TEXT_BLOCKS if self.opened[x]), ""))
                self.owners.append(self.owner)
                self.within.append(self.marks)
                self.wholes.append(self.whole if self.whole_depth else 0)
            self.parts, self.linked = [], 0

    def _pop(self) -> None:
        name, skipped, marked, owner = self.open.pop()
        self.opened[name] -= 1
        self.skipping -= skipped
        if marked:
            self.marks = self.marks[:-1]
        self.owner = owner
        self.links -= name == "a"
        self.whole_depth -= name in WHOLE_BLOCKS

    def begin(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text(" ")
            return
        if name in VOID:
            if name == "hr":
                self.end_line()
            return
        if name in BLOCKS:
            self.end_line()
            self._close_open("p", ("button", "td", "th", "table", "article", "main", "section", "div"))
            if name in CLOSED_BY_SAME:
                for other in CLOSED_BY_SAME[name]:
                    self._close_open(other, ("ul", "ol", "dl", "table", "select"))
        if name in ("article", "main") and len(self.kinds) == 1:
            # an unclosed menu or advert ends where the page's first article begins
            while self.skipping or self.marks:
                self._pop()
        skipped, marked, never = _marked_as_other(name, attributes)
        if skipped and name == "header" and self.kinds[self.owner] == "article":
            skipped = False
        # elements nested without end are not told apart
        marked = marked and len(self.marks) < 50
        self.open.append((name, skipped, marked, self.owner))
        self.opened[name] += 1
        self.skipping += skipped
        if marked:
            self.marks = (*self.marks, len(self.never))
            self.never.append(never)
        self.links += name == "a"
        if name in WHOLE_BLOCKS:
            self.whole += not self.whole_depth
            self.whole_depth += 1
        inside = self.kinds[self.owner]
        if name in ("article", "main") and not self.skipping and (not inside or inside == "main" and name == "article"):
            self.kinds.append(name)
            self.mains.append(self.owner if inside == "main" else 0)
            self.owner = len(self.kinds) - 1

    def _close_open(self, name: str, barriers: tuple[str, ...]) -> None:
        for i in range(len(self.open) - 1, -1, -1) if self.opened[name] else ():
            if self.open[i][0] == name:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in barriers:
                return

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.end_line()
        for i in range(len(self.open) - 1, -1, -1) if self.opened[name] else ():
            if self.open[i][0] == name:
                while len(self.open) > i:
                    self._pop()
                return
            if name not in BLOCKS and self.open[i][0] in BLOCKS:
                return  # an inline end tag does not close blocks


def page_lines(source: str) -> _Page:
    page, at, size = _Page(), 0, len(source)
    last, endless = source.rfind(">"), set()
    while at < size:
        tag = _TAG.search(source, at) if at <= last else None
        if tag is None:
            page.text(source[at:])
            break
        if tag.start() > at:
            page.text(source[at : tag.start()])
        at = tag.end()
        raw = tag["raw"]
        if raw:
            raw = raw.lower()
            if not tag["rawattrs"].rstrip().endswith("/"):
                end = None if raw in endless else (_BODY if raw == "head" else _RAW_END[raw]).search(source, at)
                if end:
                    at = end.start() if raw == "head" else end.end()
                elif raw in ("script", "style"):
                    at = size
                else:
                    endless.add(raw)
            if raw in ("title", "head"):
                page.end_line()
            continue
        name = tag["name"] or tag["name2"]
        if name:
            name = name.lower()
            if tag["close"] or tag["close2"]:
                page.end(name)
            else:
                attributes = tag["attrs"] or ""
                page.begin(name, attributes)
    page.end_line()
    return page


def surge_and_dive(weights: np.ndarray, sure: np.ndarray | None = None, window: int = WINDOW) -> tuple[int, int, float]:
    """The lines from the first surge to the last dive, as begin and end, and the threshold; lines that are sure surge."""
    if not len(weights):
        return 0, 0, 1.0
    padding = np.zeros(window - 1)

    def sums(of):
        return np.convolve(np.concatenate((padding, of, padding)), np.ones(window), "valid")

    threshold = max(SURGE * sums(weights)[window - 1 :].mean(), 1)
    raised = sums(weights if sure is None else np.where(sure, np.maximum(weights, threshold), weights))
    high = np.flatnonzero(np.maximum(raised[: len(weights)], raised[window - 1 :]) >= threshold - 1e-9)
    return (int(high[0]), int(high[-1]) + 1, threshold) if len(high) else (0, 0, threshold)


def _void_marks(page: _Page) -> set[int]:
    """Marked elements that hold nearly all of the page's text, in paragraphs; outer ones first."""
    void: set[int] = set()
    if all(page.never):
        return void
    lines_of: list[list[int]] = [[] for _ in page.never]
    rest = 0
    for i, marks in enumerate(page.within):
        rest += 0 if marks else page.lengths[i]
        for mark in marks:
            lines_of[mark].append(i)
    for mark, never in enumerate(page.never):
        inside = [] if never else [i for i in lines_of[mark] if void.issuperset(m for m in page.within[i] if m != mark)]
        text = sum(page.lengths[i] for i in inside)
        if text >= max(LEAST_TEXT, MOST_OF_TEXT * rest) and sum(page.blocks[i] == "p" for i in inside) >= 2:
            void.add(mark)
            rest += text
    return void


def line_weights(page: _Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines' weights, which of them may be text at all, and which surely are."""
    size = len(page.lines)
    lengths = np.array(page.lengths, dtype=np.float64)
    void = _void_marks(page)
    may = np.array([not marks or void.issuperset(marks) for marks in page.within], bool)
    # reader comments below their heading
    before = np.concatenate(([0], np.cumsum(np.where(may, lengths, 0))))
    for i in reversed(range(size)):
        if may[i] and page.blocks[i] in HEADINGS and _COMMENTS.fullmatch(page.lines[i]):
            if 2 * before[i] >= before[-1]:
                may[i:] = False
            break
    total = lengths[may].sum()
    owners = np.array(page.owners, dtype=np.int64)
    kinds, mains = np.array(page.kinds), np.array(page.mains, dtype=np.int64)
    titled = np.array([block == "h1" for block in page.blocks], bool)

    def trusted(lines):
        lines = lines & may
        return bool(lines.any() and (titled[lines].any() or lengths[lines].sum() >= TRUSTED * total))

    articles = kinds[owners] == "article"
    in_main = (kinds[owners] == "main") | (mains[owners] > 0)
    sure = np.zeros(size, bool)
    if trusted(articles):
        beside = in_main & ~articles & (lengths > 0) & np.array([bool(block) for block in page.blocks], bool)
        beside &= np.array([not _RIGHTS.search(line) for line in page.lines], bool)
        sure = (articles | beside) & may
    elif trusted(in_main):
        sure = in_main & may
    if sure.any():
        may = sure
    return np.where(may, lengths, 0.0), may, sure


def main_text(source: str | None) -> str:
    """The page's main text."""
    if not source:
        return ""
    page = page_lines(source)
    if not page.lines:
        return ""
    weights, may, sure = line_weights(page)
    begin, end, threshold = surge_and_dive(weights, sure)
    if begin < end:
        whole = {w for w in (page.wholes[begin], page.wholes[end - 1]) if w}
        text = {w: sum(page.lengths[i] for i in range(len(page.lines)) if page.wholes[i] == w and may[i]) for w in whole}
        full = {w: sum(len(page.lines[i]) for i in range(len(page.lines)) if page.wholes[i] == w and may[i]) for w in whole}
        while begin and page.wholes[begin - 1] == page.wholes[begin] and 2 * text.get(page.wholes[begin], 0) > full.get(page.wholes[begin], 0):
            begin -= 1
        while end < len(page.lines) and page.wholes[end] == page.wholes[end - 1] and 2 * text.get(page.wholes[end], 0) > full.get(page.wholes[end], 0):
            end += 1

    def stays(i: int) -> bool:
        """Whether a line may be the text's first or last: the sums look past the text."""
        line = page.lines[i]
        if sure[i]:
            return True
        if not may[i] or len(line) < 200 and _RIGHTS.search(line):
            return False
        if page.blocks[i]:
            return True
        return page.lengths[i] > 0 and (page.wholes[i] > 0 or page.lengths[i] >= threshold / WINDOW or bool(_SENTENCE.search(line)))

    while begin < end and not stays(begin):
        begin += 1
    while begin < end and not stays(end - 1):
        end -= 1
    return "\n".join(page.lines[i] for i in range(begin, end) if may[i])


def extracted(pages: DataFrame, source: str = "html", name: str = "main_text") -> tuple[DataFrame, str]:
    """The rows with their main text, and its column's name."""
    name = fresh_name(pages, name)

    @F.pandas_udf("string")
    def extract(sources: pd.Series) -> pd.Series:
        return sources.map(main_text, na_action=None).astype(object)

    return pages.withColumn(name, extract(F.col(f"`{source}`"))), name


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows, text = extracted(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col(text).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
