"""Web archive derivatives: metadata and plain-text conversion records of responses."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm import markup
from tasteline.llm.ship import map_batches

# Elements that end a line of text, those whose content is no text, and those with addresses.
_BREAKS = (
    "address article aside blockquote body br caption dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol option p pre section table tbody td tfoot th thead title tr ul"
)
_BREAK = frozenset(_BREAKS.split())
_HIDDEN = frozenset(("script", "style", "template", "noscript"))
_LINKED = frozenset(("a", "area", "link", "img", "script", "iframe"))
_LANG = re.compile("[a-zA-Z-]+")

# Columns of an input response and of an output record.
RESPONSE = ("record_id", "target_uri", "warc_date", "http_headers", "payload")
_OUT = (
    "source_id string, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, source_block_digest string, "
    "source_payload_digest string, source_headers string, warc_headers string, block string"
)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as archive records write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def linked_id(record_id: str, kind: str) -> str:
    """The record id of a derivative: a function of the source's id, so retries agree."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}')}>"


class Read(NamedTuple):
    """What one scan of a page finds: visible lines, (path, address) of links as written, title, language."""

    lines: list[str]
    places: list[tuple[str, str]]
    title: str | None
    language: str | None


def read_page(page: str) -> Read:
    """Visible text with a line per block element, white space collapsed, empty lines left out; links in page order."""
    lines: list[str] = []
    pieces: list[str] = []
    places: list[tuple[str, str]] = []
    title = language = hidden = None

    def end_line() -> None:
        line = " ".join("".join(pieces).split())
        if line:
            lines.append(line)
        pieces.clear()

    for kind, name, value in markup.scan(page):
        if kind == markup.START:
            if name in _LINKED or (name == "html" and language is None):
                found = markup.attributes(value)
                place = next((k for k in found if k in ("href", "src")), None)
                if name == "html":
                    match = _LANG.match(found.get("lang", ""))
                    language = match[0].lower() if match else None
                elif place:
                    places.append((f"{name}@{place}", found[place].strip()))
            if hidden is None and name in _HIDDEN:
                hidden = name
                pieces.append(" ")
        elif kind == markup.END and name == hidden:
            hidden = None
        elif kind == markup.RAW_TEXT and name == "title" and title is None:
            title = " ".join(html.unescape(value).split())
        if hidden is None:
            if kind in (markup.TEXT, markup.RAW_TEXT):
                pieces.append(html.unescape(value) if "&" in value else value)
            elif name in _BREAK:
                end_line()
    end_line()
    return Read(lines, places, title, language)


def plain_text(page: str) -> str:
    return "\n".join(read_page(page).lines)


def resolved(places: list[tuple[str, str]], base: str) -> list[dict[str, str]]:
    """Links with their addresses resolved against ``base``."""
    found = []
    for path, url in places:
        try:
            url = urljoin(base, url)
        except ValueError:  # not an address; kept as written
            pass
        found.append({"path": path, "url": url})
    return found


def links(page: str, base: str) -> list[dict[str, str]]:
    """Targets of links and embedded resources in page order, resolved against ``base``."""
    return resolved(read_page(page).places, base)


def _headers(text: str) -> dict[str, str]:
    lines = text.replace("\r\n", "\n").split("\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip(): value.strip() for name, value in pairs}


def _record(kind: str, source: dict, content_type: str, block: str, sums: tuple[str, str]) -> tuple:
    data = block.encode("utf-8", "surrogatepass")
    own, length = linked_id(source["record_id"], kind), len(data)
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own),
        ("WARC-Refers-To", source["record_id"]),
        ("WARC-Target-URI", source["target_uri"]),
        ("WARC-Date", source["warc_date"]),
        ("WARC-Block-Digest", digest(data)),
        ("Content-Type", content_type),
        ("Content-Length", str(length)),
    ]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return (
        source["source_id"], kind, own, source["record_id"], source["target_uri"], source["warc_date"],
        content_type, length, digest(data), *sums, source["http_headers"], text, block,
    )


def _derive(source: dict) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    page, head = source["payload"] or "", source["http_headers"] or ""
    payload = page.encode("utf-8", "surrogatepass")
    sums = (digest(head.encode() + payload), digest(payload))
    read = read_page(page)
    envelope = {
        "WARC-Refers-To": source["record_id"],
        "WARC-Target-URI": source["target_uri"],
        "Source-Block-Digest": sums[0],
        "Source-Payload-Digest": sums[1],
        "HTTP-Status-Line": head.split("\r\n", 1)[0] if head else None,
        "HTTP-Headers": _headers(head),
        "Conversion-Record-ID": linked_id(source["record_id"], "conversion"),
        "Title": read.title,
        "Language": read.language,
        "Links": resolved(read.places, source["target_uri"] or ""),
    }
    about = json.dumps(envelope, ensure_ascii=False, separators=(",", ":"))
    return [
        _record("metadata", source, "application/json", about, sums),
        _record("conversion", source, "text/plain; charset=utf-8", "\n".join(read.lines), sums),
    ]


def _derive_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _OUT.split(", ")]
    kinds = [pa.int64() if part.endswith(" long") else pa.string() for part in _OUT.split(", ")]
    for batch in batches:
        # A few pages at a time, so that records of long pages don't pile up.
        for start in range(0, batch.num_rows, 256):
            records = [r for source in batch.slice(start, 256).to_pylist() for r in _derive(source)]
            columns = list(zip(*records))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def derivatives(responses: DataFrame) -> DataFrame:
    """Two linked records, ``metadata`` and ``conversion``, of every response.

    ``responses`` has the columns ``source_id`` and RESPONSE; others are ignored.
    Both records refer to the response's id, keep its address, date, HTTP headers
    and digests of block and payload, and carry their own digest, length and
    archive headers. Work is row by row in one pass. A null payload gives an
    empty text and no links, null headers an empty set, a null address leaves
    links as written. Repeated responses give repeated records; an empty frame
    gives an empty one. A page is scanned once, in time in proportion to its length,
    whatever its tags; a tag that does not end reaches to the end of the page.
    """
    slim = responses.select("source_id", *RESPONSE)
    return map_batches(slim, _derive_batches, _OUT)


def page_responses(pages: DataFrame, warc_date: str) -> DataFrame:
    """Response records of raw pages (page_id, url, html): id from id and address, plain HTTP headers."""

    def hex_part(at: int, n: int) -> Column:
        return F.substring("sum", at, n)

    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    name = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    rows = pages.select("page_id", "url", "html", F.md5(name.cast("binary")).alias("sum"))
    return rows.select(
        F.col("page_id").cast("string").alias("source_id"),
        F.concat(
            F.lit("<urn:uuid:"),
            F.concat_ws("-", hex_part(1, 8), hex_part(9, 4), hex_part(13, 4), hex_part(17, 4), hex_part(21, 12)),
            F.lit(">"),
        ).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(warc_date).alias("warc_date"),
        head.alias("http_headers"),
        F.col("html").alias("payload"),
    )


def derivative_report(pages: DataFrame, warc_date: str) -> DataFrame:
    """The records of all pages, by integer page id."""
    made = derivatives(page_responses(pages, warc_date))
    return made.withColumn("page_id", F.col("source_id").cast("long")).drop("source_id")
