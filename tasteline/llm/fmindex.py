"""Removal of repeated word passages, found by backward search in compressed FM-indexes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import Block, blocks, prefix_hash, range_hash, split_words
from tasteline.llm.windows import Plan, Segments, Units, covered, duplicate_spans, matched_runs, ragged, with_spans

WINDOW = 13
# Words of an anchor: long enough to be rare by chance.
ANCHOR = 4


class WaveletMatrix:
    """Symbols as bit levels with sampled ranks: one bit per symbol and level plus a count per 64."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, dtype=bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.zeros(len(words) + 1, dtype=np.uint32)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.bits.append(words)
            self.counts.append(counts)
            self.zeros.append(int((~bit).sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        # Where each symbol's run begins once all levels are sorted out.
        self.origin = self.place(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word].astype(np.int64) + np.bitwise_count(self.bits[level][word] & mask)

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            one = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            ones = self._ones(i, at)
            at = np.where(one, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self.place(symbol, at) - self.origin[symbol]


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by their next ``depth`` symbols at least, by doubling."""
    rank, have, n = symbols.astype(np.int64), 1, len(symbols)
    order = np.argsort(rank, kind="stable")
    while have < depth:
        right = np.zeros(n, dtype=np.int64)
        right[: n - have] = rank[have:] + 1
        both = rank * (int(rank.max()) + 2) + right
        order = np.argsort(both, kind="stable")
        new = np.concatenate([[0], np.cumsum(both[order][1:] != both[order][:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        have *= 2
    return order


class FmIndex:
    """Burrows-Wheeler text of a shard in a wavelet matrix, for patterns of up to ``depth`` symbols.

    Suffixes are ordered by their first ``depth`` symbols, which is all that
    counting patterns of that length needs.
    """

    def __init__(self, symbols: np.ndarray, sigma: int, depth: int):
        self.order = suffix_order(symbols, depth)
        self.wavelet = WaveletMatrix(symbols[self.order - 1], sigma)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])

    def search(self, symbols: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of symbols[end - length:end], grown leftwards one symbol at a time.

        A pattern found in a single place can't match elsewhere: its search stops
        there, with an empty interval.
        """
        lo, hi = self.below[symbols[end - 1]], self.below[symbols[end - 1] + 1]
        live = np.flatnonzero(hi - lo > 1)
        out_lo, out_hi = np.zeros(len(end), np.int64), np.zeros(len(end), np.int64)
        lo, hi, at = lo[live], hi[live], end[live] - 1
        for _ in range(length - 1):
            at = at - 1
            c = symbols[at]
            lo = self.below[c] + self.wavelet.rank(c, lo)
            hi = self.below[c] + self.wavelet.rank(c, hi)
            keep = hi - lo > 1
            lo, hi, at, live = lo[keep], hi[keep], at[keep], live[keep]
        out_lo[live], out_hi[live] = lo, hi
        return out_lo, out_hi


def _word_units(block: Block) -> Units:
    words = split_words(block)
    return Units(words.first, prefix_hash(words.hash), words.start, words.end)


PLAN = Plan(_word_units, WINDOW, ANCHOR, within=False)


def earlier_windows(segments: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows whose words also start in a document of smaller id, within one shard.

    Equal segments enter the index once, under their least document; the others
    of larger id are matched by it throughout.
    """
    block = Block(0, 1, segments.data, np.array([0, len(segments.data)]))
    words = split_words(block)
    size = segments.windows + WINDOW - 1
    start = np.cumsum(size) - size
    whole = range_hash(prefix_hash(words.hash), start, start + size)
    order = np.lexsort((segments.id, whole))
    head = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
    lead = np.empty(len(order), np.int64)
    lead[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    leaders = np.sort(order[head])

    # The shard's text: a separator (0) after every distinct segment.
    _, codes = np.unique(words.hash, return_inverse=True)
    lengths = size[leaders] + 1
    ends = np.cumsum(lengths)
    text = np.zeros(int(ends[-1]), dtype=np.int64)
    inside = np.ones(len(text), dtype=bool)
    inside[ends - 1] = False
    text[inside] = codes[ragged(start[leaders], start[leaders] + size[leaders])] + 1
    owner = np.repeat(segments.id[leaders], lengths)
    index = FmIndex(text, int(codes.max()) + 2, WINDOW)

    windows = segments.windows[leaders]
    first = np.repeat(ends - lengths, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    found = np.zeros(len(first), dtype=bool)
    for s in range(0, len(first), 1 << 18):
        own = first[s : s + (1 << 18)]
        lo, hi = index.search(text, own + WINDOW, WINDOW)
        some = np.flatnonzero(hi > lo)
        if not len(some):
            continue
        # Least document of each distinct interval.
        low, slot = np.unique(lo[some], return_inverse=True)
        high = np.zeros(len(low), np.int64)
        high[slot] = hi[some]
        owners = np.append(owner[index.order], 0)
        least = np.minimum.reduceat(owners, np.stack([low, high], axis=1).reshape(-1))[::2]
        found[s + some] = least[slot] < owner[own[some]]

    # Flags of the leaders' windows, then of all segments'.
    base = np.full(len(size), -1, np.int64)
    base[leaders] = np.cumsum(windows) - windows
    flag = found[ragged(base[lead], base[lead] + segments.windows)]
    flag |= np.repeat(segments.id > segments.id[lead], segments.windows)
    return matched_runs(segments, flag)


def _strip_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the removed words and hash the others joined by one space."""
    for batch in batches:
        ids, reps = batch.column("doc_id").to_pylist(), batch.column("rep").to_pylist()
        pieces = batch.column("spans")
        out: list[tuple] = []
        for block in blocks(batch.column("text")):
            words = split_words(block)
            for i in range(block.hi - block.lo):
                row = block.lo + i
                s, e = int(words.first[i]), int(words.first[i + 1])
                kept, removed = np.ones(e - s, dtype=bool), 0
                if ids[row] is not None and e - s >= WINDOW:
                    if ids[row] > reps[row]:
                        kept[:] = False
                    elif pieces[row].is_valid:
                        span = pieces[row].values
                        kept = ~covered(span.field("low").to_numpy(), span.field("high").to_numpy(), e - s)
                    removed = int(e - s - kept.sum())
                own = block.data[block.starts[i] : block.starts[i + 1]].tobytes()
                text = own.split()
                if removed:
                    text = [w for w, k in zip(text, kept.tolist()) if k]
                out.append((ids[row], e - s, removed, hashlib.sha256(b" ".join(text)).hexdigest()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(zip(*out), kinds)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rep, copies, spans): word spans of every document seen in one of smaller id.

    The corpus is sharded by content: segments of windows that share an anchor go
    to one shard, where an FM-index of its distinct segments is searched backwards
    for every window of 13 words. ``spans`` are those of the class's least
    document ``rep``; a copy of larger id is repeated from end to end. Rows
    without doc_id or text have null ``rep`` and no spans, and nothing is removed
    from them or because of them.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = slim.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    usable = usable.withColumn("rows", F.lit(1).cast("long"))
    classes, found = duplicate_spans(usable, PLAN, earlier_windows)
    return with_spans(slim, classes, found)


def passage_report(docs: DataFrame) -> DataFrame:
    """Words, removed words and hash of the kept words of every document.

    Null and blank texts have no words. Rows that share a doc_id are judged one by
    one, and none because of the other. Other columns are ignored; an empty frame
    gives an empty one.
    """
    return map_batches(
        repeated_passages(docs), _strip_batches, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
