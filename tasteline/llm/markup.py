"""A forward scan over the tags of a page; every character is looked at a bounded number of times."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

# An attribute value is quoted only after "="; a quote that never closes is a plain character.
# Possessive repeats never go back, so a tag that does not end is found out in one pass.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")

# Elements whose content is text up to their own end tag.
RAW = ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

TEXT, START, END, RAW_TEXT = range(4)


def scan(page: str) -> Iterator[tuple[int, str, str]]:
    """(kind, name, value) of each piece of a page in order.

    TEXT has the text as value, START a lower-case name and the attributes as
    written, END a name. RAW_TEXT follows the START of an element of RAW, with its
    name and its content; the END follows. Comments, declarations and processing
    instructions are left out. A tag without ">" and a comment without "-->" reach
    to the end of the page.
    """
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield TEXT, "", page[at:]
            return
        if lt > at:
            yield TEXT, "", page[at:lt]
        tag = _TAG.match(page, lt)
        if tag:
            at = tag.end()
            name = tag[2].lower()
            if tag[1]:
                yield END, name, ""
                continue
            yield START, name, tag[3]
            if name in _RAW_END:
                end = _RAW_END[name].search(page, at)
                stop = end.start() if end else n
                yield RAW_TEXT, name, page[at:stop]
                at = stop
        elif page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else n
        elif page.startswith(("<!", "<?", "</"), lt):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else n
        elif lt + 1 < n and page[lt + 1].isascii() and page[lt + 1].isalpha():
            return
        else:
            yield TEXT, "", "<"
            at = lt + 1


def attributes(written: str) -> dict[str, str]:
    """Lower-case attribute names and decoded values; the first of equal names counts."""
    found: dict[str, str] = {}
    for part in _ATTRIBUTE.finditer(written):
        value = part[2] if part[2] is not None else part[3] if part[3] is not None else part[4] or ""
        found.setdefault(part[1].lower(), html.unescape(value))
    return found
