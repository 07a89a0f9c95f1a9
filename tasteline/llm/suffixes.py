"""Removal of byte strings that occur elsewhere, by suffix sorting with hashed comparisons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import Block, blocks, byte_values, mix64, powers, prefix_hash
from tasteline.llm.windows import Plan, Segments, Units, covered, duplicate_spans, matched_runs, ragged, with_spans

WINDOW = 200
# Bytes of an anchor: long enough to be rare by chance.
ANCHOR = 32


def _byte_units(block: Block) -> Units:
    at = np.arange(len(block.data) + 1)
    return Units(block.starts, prefix_hash(byte_values()[block.data]), at[:-1], at[1:])


PLAN = Plan(_byte_units, WINDOW, ANCHOR, within=True)


class Suffixes:
    """Suffixes of strings inside one byte buffer, compared through prefix polynomial hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int):
        self.data, self.start, self.end = data, start, end
        self.prefix = prefix_hash(byte_values(seed)[data])
        self.inverse = powers(len(self.prefix), inverse=True)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, by binary search over prefix hashes."""
        s, t = self.start[a], self.start[b]
        low = np.zeros(len(a), dtype=np.int64)
        high = np.minimum(self.end[a] - s, self.end[b] - t)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) >> 1
            p, q = s[open_], t[open_]
            same = self.hash(p, p + mid) == self.hash(q, q + mid)
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)

    def less(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """a before b in byte order, a string before its extensions, ``ties`` deciding between equals."""
        n = self.common(a, b)
        s, t = self.start[a] + n, self.start[b] + n
        a_ends, b_ends = s == self.end[a], t == self.end[b]
        last = len(self.data) - 1
        by_byte = self.data[np.minimum(s, last)] < self.data[np.minimum(t, last)]
        return np.where(a_ends | b_ends, np.where(a_ends & b_ends, ties, a_ends), by_byte)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Merge sort within each group (groups stand together): all merges of a pass side by side.

        Each item of a run finds its place in the neighbouring run by binary
        search, so a pass takes as many rounds of comparisons as a run has bits.
        """
        n = len(group)
        order = np.arange(n)
        begin = np.searchsorted(group, group, side="left")
        finish = np.searchsorted(group, group, side="right")
        at = np.arange(n)
        widest = int((finish - begin).max()) if n else 0
        width = 1
        while width < widest:
            run = (at - begin) // width
            left = run % 2 == 0
            own = begin + run * width
            other = np.where(left, own + width, own - width)
            other_end = np.minimum(other + width, finish)
            live = np.flatnonzero(other < finish)
            low, high = other[live], other_end[live]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                # Items of the right run go after equal ones of the left.
                is_left = left[live[open_]]
                goes_on = self.less(order[mid], order[live[open_]], ~is_left)
                low[open_] = np.where(goes_on, mid + 1, low[open_])
                high[open_] = np.where(goes_on, high[open_], mid)
            place = at.copy()
            pair = np.minimum(own, other)[live]
            place[live] = pair + (live - own[live]) + (low - other[live])
            moved = np.empty(n, dtype=np.int64)
            moved[place] = order
            order, width = moved, width * 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bool:
        """The first ``n`` bytes of each pair are equal."""
        for s in range(0, len(a), 1 << 14):
            p, q, k = self.start[a[s : s + (1 << 14)]], self.start[b[s : s + (1 << 14)]], n[s : s + (1 << 14)]
            if not np.array_equal(self.data[ragged(p, p + k)], self.data[ragged(q, q + k)]):
                return False
        return True


# Sets of byte values that are tried before a part is given up.
_SEEDS = 100


def _sorted_suffixes(
    segments: Segments, anchor: np.ndarray, end: np.ndarray, least_seed: int
) -> tuple[Suffixes, np.ndarray, np.ndarray, int]:
    """Order of the suffixes that begin at the anchors, common lengths of neighbours (first: 0), and the seed used.

    Every common length is compared byte by byte; a collision of hashes repeats
    the sort with other byte values.
    """
    first = np.argsort(segments.key, kind="stable")
    group = segments.key[first]
    for seed in range(least_seed, _SEEDS):
        suffixes = Suffixes(segments.data, anchor[first], end[first], seed)
        order = suffixes.sort(group)
        a, b = order[:-1], order[1:]
        common = suffixes.common(a, b)
        common[group[a] != group[b]] = 0
        if suffixes.verified(a, b, common):
            return suffixes, first[order], np.concatenate([[0], common]), seed
    raise AssertionError("hashes collide with every set of byte values")


def other_windows(segments: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows whose bytes also start elsewhere, within one part.

    Suffixes at equal anchors are sorted. A window that starts l bytes before its
    anchor equals another one if both suffixes stand in one stretch of neighbours
    with 200 - l common bytes and the l bytes before the anchors are equal.
    """
    size = segments.windows + WINDOW  # one byte of separation
    begin = np.cumsum(size) - size
    anchor, end = begin + segments.anchor, begin + size - 1
    seed = 0
    while True:
        suffixes, order, common, seed = _sorted_suffixes(segments, anchor, end, seed + 1)
        flag = _repeated(segments, suffixes, order, common, anchor)
        if flag is not None:
            return matched_runs(segments, flag)


def _repeated(
    segments: Segments, suffixes: Suffixes, order: np.ndarray, common: np.ndarray, anchor: np.ndarray
) -> np.ndarray | None:
    """A flag per window, or None if hashes of different bytes before two anchors are equal."""
    # Bytes before the anchor in a segment's first and last window.
    most, least = segments.anchor[order], segments.anchor[order] - segments.windows[order] + 1
    base = (np.cumsum(segments.windows) - segments.windows)[order]
    place = anchor[order]
    marks, slots, lengths = [], [], []
    for l in range(int(least.min()), int(most.max()) + 1):
        stretch = np.cumsum(common < WINDOW - l)
        own = np.flatnonzero((least <= l) & (l <= most))
        if not len(own):
            continue
        before = suffixes.hash(place[own] - l, place[own])
        marks.append(mix64(before ^ mix64(stretch[own].astype(np.uint64) * np.uint64(512) + np.uint64(l))))
        slots.append(base[own] + most[own] - l)
        lengths.append(np.full(len(own), l, dtype=np.int16))
    mark, slot = np.concatenate(marks), np.concatenate(slots)
    by = np.argsort(mark, kind="stable")
    same = mark[by][1:] == mark[by][:-1]
    if not _left_equal(segments, anchor, slot[by], np.concatenate(lengths)[by], same):
        return None
    twice = np.zeros(len(by), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    flag = np.zeros(int(segments.windows.sum()), dtype=bool)
    flag[slot[by[twice]]] = True
    return flag


def _left_equal(segments: Segments, anchor: np.ndarray, slot: np.ndarray, l: np.ndarray, same: np.ndarray) -> bool:
    """Windows found equal have equal bytes before their anchors; compared where no longer
    stretch of the same two segments has been."""
    owner = np.searchsorted(np.cumsum(segments.windows), slot, side="right")
    a, b = owner[:-1][same], owner[1:][same]
    n = l[1:][same].astype(np.int64)
    order = np.lexsort((-n, b, a))
    a, b, n = a[order], b[order], n[order]
    head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    for s in range(0, len(head), 1 << 14):
        h = head[s : s + (1 << 14)]
        p, q, k = anchor[a[h]], anchor[b[h]], n[h]
        if not np.array_equal(segments.data[ragged(p - k, p)], segments.data[ragged(q - k, q)]):
            return False
    return True


def _strip_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count removed bytes and runs of them, and hash the bytes that stay."""
    for batch in batches:
        ids, copies = batch.column("doc_id").to_pylist(), batch.column("copies").to_pylist()
        pieces = batch.column("spans")
        out: list[tuple] = []
        for block in blocks(batch.column("text")):
            for i in range(block.hi - block.lo):
                row = block.lo + i
                own = block.data[block.starts[i] : block.starts[i + 1]]
                gone = np.zeros(len(own), dtype=bool)
                if len(own) >= WINDOW:
                    if copies[row] > 1:
                        gone[:] = True
                    elif pieces[row].is_valid:
                        span = pieces[row].values
                        gone = covered(span.field("low").to_numpy(), span.field("high").to_numpy(), len(own))
                n = int(gone.sum())
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                left = own[~gone] if n else own
                out.append((ids[row], len(own), n, runs, hashlib.sha256(left.tobytes()).hexdigest()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(zip(*out), kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rep, copies, spans): byte spans of every document that occur elsewhere too.

    Strings of 200 bytes are compared, in the same document or any other. A text
    of several rows (``copies``) occurs elsewhere from end to end; ``spans`` are
    those of texts of one row. Texts are told apart by their bytes, so rows without
    a doc_id count like any others. Rows without text have null ``copies`` and no
    spans.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = slim.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("rows", F.lit(1).cast("long"))
    # Of rows without an id each text is compared once; any id will do.
    nameless = slim.where("doc_id IS NULL AND text IS NOT NULL").groupBy("text").agg(F.count("*").alias("rows"))
    usable = usable.unionByName(nameless.withColumn("doc_id", F.lit(0).cast("long")))
    classes, found = duplicate_spans(usable, PLAN, other_windows)
    return with_spans(slim, classes, found)


def string_report(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes, runs of removed bytes and hash of the rest of every document.

    Null and empty texts have no bytes. Rows that share a doc_id are different
    places. Other columns are ignored; an empty frame gives an empty one.
    """
    return map_batches(
        repeated_strings(docs),
        _strip_batches,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    )
