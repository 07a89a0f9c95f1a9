"""Benchmark passages in documents, by multi-pattern search with shift tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import LOWER, Block, blocks, mix64, powers, prefix_hash, range_hash, split_words
from tasteline.session import materialize

# Fixed value: ASCII bytes outside words, which are digits, letters and all beyond ASCII.
_BREAK = np.ones(256, dtype=bool)
_BREAK[0x30:0x3A] = False
_BREAK[0x61:0x7B] = False
_BREAK[0x80:] = False

WINDOW = 13
# The same words as a pattern, and the letters that are lowered.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Windows that one pass over the documents searches, passes in one stage, words in which a lane starts windows.
MAX_PATTERNS = 1 << 16
_PASSES = 4
_LANE = 256
_BITS = 20


@dataclass(frozen=True)
class Table:
    """Shift table and suffix buckets of all patterns of one length (in words).

    Patterns are in order of the hash of their last block, so a bucket is a
    stretch of them; inside it they are in order of the hash of all their words.
    """

    length: int
    shift: np.ndarray
    suffix: np.ndarray
    whole: np.ndarray
    words: list[tuple[bytes, ...]]
    items: list[tuple[int, ...]]


def _tokens(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    return np.where(_BREAK[data], np.uint8(0x20), data).tobytes().split(b" ")


def _windows(text: str | None) -> list[tuple[bytes, ...]]:
    got = [w for w in _tokens(text) if w]
    if not got:
        return []
    n = min(WINDOW, len(got))
    return [tuple(got[i : i + n]) for i in range(len(got) - n + 1)]


def _word_hashes(words: set[bytes]) -> dict[bytes, int]:
    """The hash that a scan gives each word."""
    listed = sorted(words)
    data = b" ".join(listed)
    one = Block(0, 1, np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    return dict(zip(listed, split_words(one, _BREAK, LOWER).hash.tolist()))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring words: the block of the shift table."""
    return mix64(a * np.uint64(3) + b)


def _last_block(hashes: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each place."""
    return hashes[..., last] if size == 1 else _pair(hashes[..., last - 1], hashes[..., last])


def _first_in(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First place in each stretch lo..hi-1 of rising values that is not below the one wanted."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        low = open_ & (values[np.minimum(mid, len(values) - 1)] < wanted)
        lo, hi = np.where(low, mid + 1, lo), np.where(open_ & ~low, mid, hi)
    return lo


def build_tables(items: list[tuple[object, str | None]]) -> list[Table]:
    """One table per pattern length from (item_id, text) rows; item places index the list."""
    found: dict[tuple[bytes, ...], set[int]] = {}
    for place, (_, text) in enumerate(items):
        for window in _windows(text):
            found.setdefault(window, set()).add(place)
    of = _word_hashes({word for w in found for word in w})
    tables = []
    for length in sorted({len(w) for w in found}):
        patterns = sorted(w for w in found if len(w) == length)
        hashes = np.array([[of[word] for word in w] for w in patterns], dtype=np.uint64)
        size = min(2, length)
        # A block of words not in any pattern allows a shift past the whole block.
        shift = np.full(1 << _BITS, length - size + 1, dtype=np.int64)
        for at in range(length - size + 1):
            block = hashes[:, at] if size == 1 else _pair(hashes[:, at], hashes[:, at + 1])
            np.minimum.at(shift, (block >> np.uint64(64 - _BITS)).astype(np.int64), length - size - at)
        # The same as range_hash over the words' hashes.
        whole = mix64((hashes * powers(length)[:length]).sum(axis=1, dtype=np.uint64) + np.uint64(length))
        suffix = _last_block(hashes, np.array([length - 1]), size)[:, 0]
        order = np.lexsort((whole, suffix))
        tables.append(
            Table(
                length,
                shift,
                suffix[order],
                whole[order],
                [patterns[i] for i in order],
                [tuple(sorted(found[patterns[i]])) for i in order],
            )
        )
    return tables


def _scan(table: Table, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Word places at which a pattern may start: the last block allows no shift.

    Texts are cut into lanes that advance side by side, each by its own shift.
    """
    m, size = table.length, min(2, table.length)
    last = first[1:] - m
    lanes = np.maximum(0, -(-(last - first[:-1] + 1) // _LANE))
    text = np.repeat(np.arange(len(lanes)), lanes)
    within = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = first[text] + within * _LANE
    stop = np.minimum(at + _LANE - 1, last[text])
    found = []
    while len(at):
        tail = hashes[at + m - 1]
        block = tail if size == 1 else _pair(hashes[at + m - 2], tail)
        shift = table.shift[(block >> np.uint64(64 - _BITS)).astype(np.int64)]
        found.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        alive = at <= stop
        at, stop = at[alive], stop[alive]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def search(tables: list[Table], block: Block, spans: list[list[int]] | None = None) -> tuple[np.ndarray, list[list[int]], list[set[int]]]:
    """Per text: number of words, covered runs of words (first, one past the last, ...), places of items found.

    ``spans`` are runs that are covered already.
    """
    words = split_words(block, _BREAK, LOWER)
    n = len(words.first) - 1
    cover = np.zeros(len(words.start) + 1, dtype=np.int64)
    for first, runs in zip(words.first.tolist(), spans or ()):
        for start, end in zip(runs[::2], runs[1::2]):
            cover[first + start] += 1
            cover[first + end] -= 1
    items: list[set[int]] = [set() for _ in range(n)]
    prefix = prefix_hash(words.hash)
    for table in tables:
        at = _scan(table, words.hash, words.first)
        if not len(at):
            continue
        suffix = _last_block(words.hash, at + table.length - 1, min(2, table.length))
        lo, hi = (np.searchsorted(table.suffix, suffix, side) for side in ("left", "right"))
        at, lo, hi = (x[lo < hi] for x in (at, lo, hi))
        key = range_hash(prefix, at, at + table.length)
        slot = _first_in(table.whole, lo, hi, key)
        text = np.searchsorted(words.first, at, side="right") - 1
        while len(at):
            # All patterns of the bucket with this hash, one after the other.
            same = (slot < hi) & (table.whole[np.minimum(slot, len(table.whole) - 1)] == key)
            at, slot, hi, key, text = (x[same] for x in (at, slot, hi, key, text))
            for place, which, doc in zip(at.tolist(), slot.tolist(), text.tolist()):
                got = tuple(
                    LOWER[block.data[s:e]].tobytes()
                    for s, e in zip(words.start[place : place + table.length], words.end[place : place + table.length])
                )
                if got == table.words[which]:
                    cover[place] += 1
                    cover[place + table.length] -= 1
                    items[doc].update(table.items[which])
            slot = slot + 1
    inside = np.cumsum(cover)[:-1] > 0
    edge = np.ones(len(inside), dtype=bool)
    edge[1:] = inside[1:] != inside[:-1]
    edge[words.first[:-1][words.first[:-1] < len(inside)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(inside))
    starts, ends = starts[inside[starts]], ends[inside[starts]]
    owner = np.searchsorted(words.first, starts, side="right") - 1
    found: list[list[int]] = [[] for _ in range(n)]
    for doc, start, end, first in zip(owner.tolist(), starts.tolist(), ends.tolist(), words.first[owner].tolist()):
        found[doc] += [start - first, end - first]
    return np.diff(words.first), found, items


def _pass_batches(tables: list[Table], names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, spans, items = [], [], []
        before = batch.column("spans").to_pylist()
        for block in blocks(batch.column("text")):
            n, runs, found = search(tables, block, before[block.lo : block.hi])
            words.append(n.astype(np.int64))
            spans += runs
            items += [sorted({names[i] for i in x}) for x in found]
        if batch.num_rows:
            named = [a + b if b else a for a, b in zip(batch.column("items").to_pylist(), items)]
            arrays = [batch.column("row"), batch.column("text"), pa.array(np.concatenate(words))]
            arrays += [pa.array(spans, pa.list_(pa.int32())), pa.array(named, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "text", "n_words", "spans", "items"])


def _parts(benchmark: DataFrame) -> Iterator[tuple[list[Table], list[str]]]:
    """Search tables of the benchmark in parts of about MAX_PATTERNS windows, dealt by the items' hash."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    words = F.regexp_count(F.translate("text", _UPPER, _LOWER), F.lit(_WORD))
    windows = F.greatest(words - (WINDOW - 1), F.lit(1))
    total = items.where("text IS NOT NULL").agg(F.sum(windows)).first()[0] or 0
    parts = max(1, -(-total // MAX_PATTERNS))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield build_tables([(r["item_id"], r["text"]) for r in rows]), [r["item_id"] or "" for r in rows]


def _searched(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, n_words, n_hit, items) of ``rows`` (row, text).

    Every part of the benchmark is one pass; passes unite the runs they find. After
    some passes the rows are written out, so a task holds few tables at once.
    """
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, text string, n_words long, spans array<int>, items array<string>"
    found = rows.select(
        "row",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for n, (tables, names) in enumerate(_parts(benchmark)):
        if n and n % _PASSES == 0:
            found = materialize(found, "contamination")
        found = map_batches(found, lambda b, tables=tables, names=names: _pass_batches(tables, names, b), schema)
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long"))
    hits = F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select("row", "n_words", hits.alias("n_hit"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_hit, items) of every document row.

    A word is hit if it lies in an occurrence of a benchmark window of 13 words
    (all words of an item that has fewer). The benchmark is a query set: it is
    dealt by a hash of its items into parts of about ``MAX_PATTERNS`` windows (an
    item stays whole), one pass over the documents each, and the runs that they
    find are united. Null or wordless texts have no words and no hits; items
    without words match nothing; items of equal text are all named. Rows come out
    one for one, so repeated documents are repeated. An empty frame gives an empty
    one, an empty benchmark no hits. Other columns are ignored.
    """
    found = _searched(docs.select(F.col(key).alias("row"), "text"), benchmark)
    return found.select(F.col("row").alias(key), "n_words", "n_hit", "items")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts, digest of the sorted item ids and verdict (a twentieth of the words) per document."""
    found = contamination(docs, benchmark)
    ids = F.array_sort(F.array_distinct("items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(F.array_distinct("items")).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = _searched(docs.select(F.struct("*").alias("row"), "text"), benchmark)
    return found.where(~contaminated()).select("row.*")
