"""Main text of web pages by paths that the pages of a host agree on."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm import markup
from tasteline.llm.ship import map_batches
from tasteline.session import materialize

# Elements that end a block, those without an end tag, those whose content is never
# article text, and those that hold a piece of prose rather than a whole article.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset(
    "applet aside audio button canvas datalist dialog footer form head iframe input map math menu nav noembed "
    "noframes noscript object script select style svg template textarea title video xmp".split()
)
_PROSE = frozenset(
    "address blockquote caption dd dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre summary "
    "tbody tfoot thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Start tags that close an element of these names that is innermost.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
# Words in classes and ids, and roles, of what surrounds an article.
_AROUND = frozenset(
    "nav navbar navigation navigate menu menubar submenu breadcrumb breadcrumbs pagination pager toolbar topbar "
    "masthead banner sidebar sidebars side rail footer foot colophon copyright ad ads adv advert adverts "
    "advertisement advertising adsense adslot sponsor sponsored promo promoted promotion cookie cookies consent "
    "gdpr notice notices notification popup modal overlay search searchbox searchform login signin signup register "
    "subscribe subscription newsletter form comment comments commentlist respond replies disqus discussion share "
    "sharing social related recommended recommendations popular trending widget widgets skip hidden".split()
)
_AROUND_END = ("sidebar", "navbar", "navigation", "menu", "footer", "comments", "breadcrumbs", "advert", "newsletter")
_HEADER = frozenset("header pageheader siteheader topheader".split())
_UNLESS_AFTER = frozenset("has with no without not".split())
_ARTICLE = frozenset("article post entry story content".split())
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
_KEPT_TAGS = frozenset("html body main article".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

_KEEP, _DROP, _HEADER_LIKE = range(3)


def _class_words(names: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(names)]


def _verdict(tag: str, attrs: dict[str, str]) -> int:
    """Whether an element belongs to what surrounds an article, by name, role, class, id and visibility."""
    if tag in _NEVER:
        return _DROP
    if tag in _KEPT_TAGS and tag != "article":
        return _KEEP
    if attrs:
        if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(attrs.get("style", "")):
            return _DROP
        if attrs.get("role", "").lower() in _ROLES:
            return _DROP
        header = False
        for names in (attrs.get("class", ""), attrs.get("id", "")):
            before = ""
            for word in _class_words(names):
                if before not in _UNLESS_AFTER:
                    if word in _AROUND or word.endswith(_AROUND_END):
                        return _DROP
                    header = header or word in _HEADER
                before = word
        if header and tag != "article":
            return _HEADER_LIKE
    return _HEADER_LIKE if tag == "header" else _KEEP


def _step(tag: str, attrs: dict[str, str]) -> str:
    """One step of a generalised path: the tag and its classes, in order, runs of digits as one sign."""
    classes = sorted({re.sub(r"\d+", "#", re.sub(r"[^\w-]", "_", c)) for c in attrs.get("class", "").split()})
    return ".".join([re.sub(r"[^\w:-]", "_", tag), *classes])


def _shape(tag: str, written: str) -> tuple[int, str, bool]:
    """Verdict, path step, and whether the element is named as an article."""
    attrs = markup.attributes(written) if written else {}
    named = tag == "article" or (tag in _BLOCKS and not _ARTICLE.isdisjoint(_class_words(attrs.get("class", ""))))
    return _verdict(tag, attrs), _step(tag, attrs), named


# Pages repeat their short tags; long ones are not worth the memory.
_short_shape = lru_cache(maxsize=4096)(_shape)


class Element(NamedTuple):
    parent: int
    tag: str
    step: str


class Run(NamedTuple):
    """One block of text: its element, its text, and how many characters of it are links."""

    element: int
    text: str
    linked: int


class Page(NamedTuple):
    """Elements in page order (the first is the body) and the blocks of text that may be article text."""

    elements: list[Element]
    runs: list[Run]


class _Builder:
    """Turns the pieces of a page into elements and blocks.

    ``out`` of an open element is the outermost element around it that is left
    out (-1: none), ``heads`` whether only headings count inside.
    """

    def __init__(self) -> None:
        self.elements = [Element(-1, "body", "")]
        # Blocks with the element that leaves them out, or -1.
        self.found: list[tuple[Run, int]] = []
        self.sure: set[int] = set()
        self.rescued: set[int] = set()
        self.stack: list[tuple[str, int, int, bool, bool]] = [("body", 0, -1, False, False)]
        self.open: dict[str, int] = {}
        self.pieces: list[str] = []
        self.linked = 0
        self.links = 0

    def flush(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            tag, element, out, heads, _ = self.stack[-1]
            if not heads or any(t in _HEADINGS for t, *_ in self.stack[-4:]):
                self.found.append((Run(element, text, min(self.linked, len(text))), out))
        self.pieces, self.linked = [], 0

    def pop(self) -> None:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1

    def start(self, tag: str, written: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        block = tag in _BLOCKS
        if block:
            self.flush()
            self.links = 0
            if self.stack[-1][0] == "p" and len(self.stack) > 1:
                self.pop()
            closes = _CLOSES.get(tag)
            while closes and self.stack[-1][0] in closes:
                self.pop()
        if tag in _VOID or tag in ("html", "body"):
            return
        if tag == "a":
            self.links = 1
        verdict, step, named = (_short_shape if len(written) < 200 else _shape)(tag, written)
        if not block and verdict == _KEEP:
            return
        _, parent, out, heads, article = self.stack[-1]
        self.elements.append(Element(parent, tag, step))
        number = len(self.elements) - 1
        if verdict == _HEADER_LIKE:
            # The header of an article holds its title, any other the name of the site.
            heads, verdict = (True, _KEEP) if article else (heads, _DROP)
        if verdict == _DROP and out < 0:
            out = number
            if tag in _NEVER or tag == "header":
                self.sure.add(number)
        elif verdict == _KEEP and tag in ("article", "main") and out >= 0:
            self.rescued.add(out)
        self.stack.append((tag, number, out, heads, article or named))
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag in _BLOCKS or tag in _NEVER:
            self.flush()
            self.links = 0
        elif tag == "a":
            self.links = 0
        if not self.open.get(tag):
            return
        self.flush()
        while self.stack[-1][0] != tag:
            self.pop()
        self.pop()

    def text(self, value: str) -> None:
        value = html.unescape(value) if "&" in value else value
        self.pieces.append(value)
        if self.links:
            self.linked += len(value.strip())

    def page(self) -> Page:
        self.flush()
        # What names leave out stays if an article stands in it: the name is one of the layout.
        back = self.rescued - self.sure
        return Page(self.elements, [run for run, out in self.found if out < 0 or out in back])


def parse(page: str) -> Page:
    """Elements and candidate blocks of a page, in one pass."""
    build = _Builder()
    for kind, name, value in markup.scan(page):
        if kind == markup.TEXT:
            build.text(value)
        elif kind == markup.START:
            build.start(name, value)
        elif kind == markup.END:
            build.end(name)
    return build.page()


def best_container(page: Page) -> int | None:
    """The element that most of the page's prose lies in, or None without any.

    A container scores the characters outside links of its own blocks, and half
    of what the containers directly inside score. The article around the winner,
    or else an ancestor that adds the first heading and little more, takes its place.
    """
    elements, n = page.elements, len(page.elements)
    holds = [e.tag not in _PROSE for e in elements]
    holder = [0] * n
    for i in range(1, n):
        holder[i] = i if holds[i] else holder[elements[i].parent]
    own, chars, title = [0.0] * n, [0] * n, [False] * n
    for run in page.runs:
        own[holder[run.element]] += len(run.text) - run.linked
        chars[run.element] += len(run.text)
        title[run.element] = title[run.element] or elements[run.element].tag == "h1"
    score = list(own)
    for i in range(n - 1, 0, -1):
        up = elements[i].parent
        chars[up] += chars[i]
        title[up] = title[up] or title[i]
        if holds[i]:
            score[holder[up]] += own[i] / 2
    if not chars[0]:
        return None
    best = max(range(n), key=lambda i: (score[i] if holds[i] else -1.0, -i))
    up = best
    while up > 0:
        if elements[up].tag == "article":
            return up
        up = elements[up].parent
    while best > 0 and not title[best]:
        up = holder[elements[best].parent]
        if up == 0 or chars[up] > 1.25 * chars[best] + 200:
            break
        best = up
    return best


def path_of(page: Page, element: int) -> str:
    """Steps from the body to an element, joined by ``>``; the body itself is empty."""
    steps = []
    while element > 0:
        steps.append(page.elements[element].step)
        element = page.elements[element].parent
    return ">".join(reversed(steps))


def text_at(page: Page, path: str) -> str:
    """Blocks inside all elements with the path, in page order."""
    steps = path.split(">") if path else []
    # How far each element follows the path; elements inside a match stay at its full length.
    depth = [0] * len(page.elements)
    for i, e in enumerate(page.elements[1:], 1):
        d = depth[e.parent]
        depth[i] = d if d == len(steps) else d + 1 if d >= 0 and steps[d] == e.step else -1
    return "\n\n".join(run.text for run in page.runs if depth[run.element] == len(steps))


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, chars = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            page = parse(source.as_py() or "")
            best = best_container(page)
            if best is not None:
                hosts.append(host)
                paths.append(path_of(page, best))
                chars.append(sum(len(run.text) for run in page.runs))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(chars, pa.int64())],
            names=["host", "path", "chars"],
        )


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, used = [], []
        for winner, source in zip(batch.column("winner").to_pylist(), batch.column("html")):
            page = parse(source.as_py() or "")
            text = text_at(page, winner) if winner is not None else ""
            if not text:
                best = best_container(page)
                winner = None if best is None else path_of(page, best)
                text = "" if winner is None else text_at(page, winner)
            texts.append(text)
            used.append(winner)
        arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(used, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), *arrays], names=["page_id", "url", "text", "n_chars", "path"]
        )


def host_of(url: Column) -> Column:
    """Lower-case host of an address without user and port; null where there is none."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.lower(host))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages): the path that most pages of a host vote for.

    A page votes for the path of its best container. Votes are summed by host and
    path before a host's paths meet, so a host's rows are its different paths.
    Ties go to the path whose pages have more text, then to the lesser path.
    """
    slim = pages.select(host_of(F.col("url")).alias("host"), "html").where("host IS NOT NULL AND html IS NOT NULL")
    votes = map_batches(slim, _vote_batches, "host string, path string, chars long")
    summed = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("chars").alias("chars"))
    # min_by over negated numbers lets the least path win a tie.
    order = F.struct(-F.col("votes"), -F.col("chars"), "path")
    return summed.groupBy("host").agg(
        F.min_by("path", order).alias("path"), F.max("votes").alias("votes"), F.sum("votes").alias("pages")
    )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every row of ``pages`` (page_id, url, html).

    ``text`` has the blocks of the article joined by two line feeds, white space
    inside a block as one space, character references decoded; ``path`` says where
    it was found. Every host's pages vote for a path; a page that has text there
    is read there, any other at its own best container. Pages without a host
    have no common path. Names of elements, roles, classes and ids tell menus,
    headers, footers, sidebars, notices, adverts, forms and comments; in the
    header of an article its headings stay.

    Null and empty pages, and pages without article text, have an empty text, no
    characters and a null path. Repeated rows give repeated rows and one vote
    each. Other columns are ignored; an empty frame gives an empty one. Work on a
    page is linear in its length, whatever its tags. The hosts' paths are a
    written table: the planner broadcasts it if it is small, else joins by host
    and splits hosts of very many pages.
    """
    winners = materialize(host_paths(pages).select("host", F.col("path").alias("winner")), "host-paths")
    slim = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    read = slim.join(winners, "host", "left").select("page_id", "url", "html", "winner")
    kind = slim.schema["page_id"].dataType.simpleString()
    return map_batches(read, _text_batches, f"page_id {kind}, url string, text string, n_chars long, path string")
