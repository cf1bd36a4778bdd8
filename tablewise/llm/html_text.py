"""Main text of HTML pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

A page is fed piece by piece to the standard library's event parser.  A line
is the text between two borders of blocks; each knows the elements that hold it, its
characters, those of its characters that are links, and the tags that opened since the line before it.

1. The ratio of a line is its characters outside links, divided by its tags.  Lines in
   page furniture (navigation, headers, footers, sidebars, notices, adverts, forms,
   reader comments, by element, role or class name) have ratio 0.
2. The ratios, in page order, are smoothed with a Gaussian kernel, so a short line
   between long ones is lifted and a lone long line among short ones sinks.
3. Lines whose smoothed ratio reaches the standard deviation of the page's
   smoothed ratios, and that are not furniture, form the content cluster.
4. The cluster's region is the ``article`` or ``main`` that holds most of its characters or, where
   none holds a fair share, the innermost block with nearly all of them.  All lines of
   that element that are not furniture are the text, with headings directly before it: nothing
   inside it is dropped for being short.

Defined cases: a null or blank page, or one of furniture alone, gives an empty text; a page cut short is
taken as if all its elements ended there; unknown, unclosed and stray tags are tolerated;
plain text without tags is one line; scripts, styles, the head, comments and
other markup never count; a line break element is white space inside its block; white space is what Python's ``str.split`` splits at (no-break
spaces too); very long pages are taken whole, in memory proportional to the page; null and repeated ids and
repeated rows each give their row; further columns stay out unless named in ``keep``,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, text_or_empty

PIECE_CHARS = 1 << 18
#: shares of the cluster's characters: an article that counts, one within another that is preferred, a block without articles
ARTICLE_SHARE, INNER_SHARE, BLOCK_SHARE = 0.3, 0.6, 0.8
BLOCKS = frozenset(("body", "div", "section", "td"))
HEADINGS = frozenset(("h1", "h2", "h3"))

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements inside a line; all others begin and end lines
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
#: elements whose text is never shown as text
UNSEEN = frozenset("head script style noscript template iframe object svg math canvas audio video datalist title textarea select button".split())
FURNITURE = frozenset("nav header footer aside form dialog menu search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: words of class names and ids that mark furniture
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsored sponsor promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs masthead topbar toolbar share sharing social "
    "pagination pager footer sidebar comment comments commentlist disqus reply replies respond related recommended recommendations widget widgets teaser".split()
)
#: furniture that may itself hold article elements (a comment, a teaser)
WITH_ARTICLES = frozenset("aside sidebar comment comments commentlist disqus reply replies respond related recommended recommendations widget widgets teaser".split())
#: what an opening tag ends: tag -> open elements, looked for up to the nearest border
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
BORDERS = frozenset("html body table ul ol dl div section article main nav header footer aside form blockquote".split())
#: blocks that end an open paragraph
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section table ul".split()
)
_MARKUP = re.compile(r"<[!?/a-zA-Z]")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")


def _names(attributes: list[tuple[str, str | None]]) -> set[str]:
    """Words of an element's class names, id and role that mark furniture."""
    found: set[str] = set()
    for key, value in attributes:
        if key == "role" and (value or "").strip().lower() in ROLES:
            found.add(value.strip().lower())
        elif key in ("class", "id"):
            for name in (value or "").split():
                words = [w.lower() for w in _WORD.findall(name)]
                # "has-sidebar" tells of another element
                if words and words[0] not in ("has", "with", "no", "without"):
                    found |= NAMES.intersection(words) | NAMES.intersection(x + y for x, y in zip(words, words[1:], strict=False))
    return found


class _Lines(HTMLParser):
    """Collects lines and the tree of elements that hold them; parents have smaller numbers than their children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.marks = ["#page"], [0], [frozenset()]
        self.open = [0]
        self.unseen = self.links = 0
        self.parts: list[str] = []
        self.link_chars = self.tags = 0
        self.lines: list[tuple[int, str, int, int]] = []  # element, text, characters in links, tags

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self._end_line()
            self._end_implied(tag)
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        names = _names(attrs) if tag not in ("html", "body", "main") else set()
        if tag in FURNITURE:
            names.add(tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.marks.append(frozenset(names))
        self.open.append(len(self.tag) - 1)
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_line()
        inline = tag in INLINE
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name == tag:
                self._close(depth)
                return
            # an inline end tag does not end blocks; "</p>" and "</li>" do not end what holds them
            if (inline and name not in INLINE) or (tag not in BORDERS and name in BORDERS):
                return

    def handle_data(self, data: str) -> None:
        if self.unseen == 0:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)

    def _end_implied(self, tag: str) -> None:
        ended = ENDED_BY.get(tag, set())
        paragraph = tag in ENDS_PARAGRAPH
        if not ended and not paragraph:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name in ended or (paragraph and name == "p"):
                self._close(depth)
                if not ended or name in ended:
                    return
            elif name in BORDERS:
                return

    def _close(self, depth: int) -> None:
        for element in self.open[depth:]:
            self.unseen -= self.tag[element] in UNSEEN
            self.links -= self.tag[element] == "a"
        del self.open[depth:]

    def _end_line(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((self._block(), text, min(self.link_chars, len(text)), self.tags))
            self.tags = 0
        self.parts, self.link_chars = [], 0

    def _block(self) -> int:
        for element in reversed(self.open):
            if self.tag[element] not in INLINE:
                return element
        return 0

    def finish(self) -> None:
        if _MARKUP.match(self.rawdata):  # a tag or comment that the page's end cuts off
            self.rawdata = ""
        self.close()
        self._end_line()


def smooth(ratios: np.ndarray, radius: int = 1) -> np.ndarray:
    """Ratios under a Gaussian kernel of the given radius, its weights summing to 1 at the ends too."""
    steps = np.arange(-radius, radius + 1)
    kernel = np.exp(-(steps**2) / (2.0 * radius**2))
    padded = np.pad(ratios, radius)
    weight = np.convolve(np.pad(np.ones(len(ratios)), radius), kernel, "valid")
    return np.convolve(padded, kernel, "valid") / weight


def _furniture(page: _Lines) -> list[bool]:
    """For each element, whether it is or lies in page furniture."""
    n = len(page.tag)
    # elements that hold an article or main which is not itself furniture: a wrapper, or one that was never closed
    holds = [False] * n
    for e in range(n - 1, 0, -1):
        if holds[e] or (page.tag[e] in ("article", "main") and not page.marks[e]):
            holds[page.parent[e]] = True
    out, within = [False] * n, [False] * n
    for e in range(1, n):
        up, tag, marks = page.parent[e], page.tag[e], page.marks[e]
        within[e] = within[up] or tag in ("article", "main")
        marked = bool(marks) and not (holds[e] and not marks & WITH_ARTICLES)
        # the header of an article holds its title
        if marked and marks == {"header"} and within[up]:
            marked = False
        out[e] = out[up] or marked
    return out


def main_text(html: str, radius: int = 1) -> str:
    """The blocks of a page's main text, joined by line feeds."""
    page = _Lines()
    for i in range(0, len(html), PIECE_CHARS):
        page.feed(html[i : i + PIECE_CHARS])
    page.finish()
    if not page.lines:
        return ""
    furniture = _furniture(page)
    element = [line[0] for line in page.lines]
    plain = np.array([not furniture[e] for e in element])
    shown = np.array([len(text) - links for _, text, links, _ in page.lines], float)
    ratios = np.where(plain, shown, 0.0) / np.array([max(tags, 1) for *_, tags in page.lines])
    smoothed = smooth(ratios, radius)
    cluster = plain & (smoothed >= smoothed.std()) & (ratios > 0)
    if not cluster.any():
        cluster = plain
    region = _region(page, element, np.where(cluster, shown, 0.0), furniture)
    inside = [False] * len(page.tag)
    inside[region] = True
    for e in range(region + 1, len(page.tag)):
        inside[e] = inside[page.parent[e]]
    chosen = [bool(kept) and inside[e] for e, kept in zip(element, plain, strict=True)]
    _headings(page, plain, chosen)
    return "\n".join(line[1] for line, kept in zip(page.lines, chosen, strict=True) if kept)


def _region(page: _Lines, element: list[int], chars: np.ndarray, furniture: list[bool]) -> int:
    """The element that holds the cluster: an article if one holds a fair share, else the innermost block with nearly all."""
    held = [0.0] * len(page.tag)
    for e, c in zip(element, chars.tolist(), strict=True):
        held[e] += c
    total = sum(held)
    if total == 0:
        return 0
    for e in range(len(held) - 1, 0, -1):
        held[page.parent[e]] += held[e]
    articles = [e for e in range(1, len(held)) if page.tag[e] in ("article", "main") and not furniture[e] and held[e] >= ARTICLE_SHARE * total]
    if articles:
        largest = max(articles, key=lambda e: held[e])
        within = {largest}
        for e in range(largest + 1, len(held)):
            if page.parent[e] in within:
                within.add(e)
        return max(e for e in articles if e in within and held[e] >= INNER_SHARE * held[largest])
    return max((e for e in range(1, len(held)) if page.tag[e] in BLOCKS and not furniture[e] and held[e] >= BLOCK_SHARE * total), default=0)


def _headings(page: _Lines, plain: np.ndarray, chosen: list[bool]) -> None:
    """Choose also the headings that stand directly before the chosen lines."""
    for i in range(chosen.index(True) - 1, -1, -1) if True in chosen else ():
        if not plain[i] or page.tag[page.lines[i][0]] not in HEADINGS:
            return
        chosen[i] = True


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), radius: int = 1) -> DataFrame:
    """One row per page: page_id, ``keep`` columns, text, n_chars."""
    src = pages.select(F.col(id_col).alias("_id"), text_or_empty(html_col).alias("_html"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    fields = [f for f in src.schema.fields if f.name != "_html"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), radius) for html in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return src.mapInArrow(releasing(run), schema).select(F.col("_id").alias("page_id"), *[F.col(f"_keep_{c}").alias(c) for c in keep], "text", "n_chars")
