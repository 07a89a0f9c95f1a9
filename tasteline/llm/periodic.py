"""Periodic runs of words: maximal pairs of the LCP-interval tree at bounded distances."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import blocks


@dataclass(frozen=True)
class RunSpec:
    """A run of period q has at least ``words`` words and ``periods`` periods."""

    words: int = 6
    periods: int = 4

    @property
    def depth(self) -> int:
        """Words that a run shares with itself one period on, at the least."""
        return max(self.words - 1, self.periods - 1)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words of one text only, and where each text begins (n + 1)."""
    ids: list[int] = []
    first = [0]
    seen = 0
    for words in texts:
        of: dict[bytes, int] = {}
        ids.extend([of.setdefault(w, len(of)) + seen for w in words])
        seen += len(of)
        first.append(len(ids))
    return np.array(ids, dtype=np.int64), np.array(first, dtype=np.int64)


def _sorted_suffixes(ids: np.ndarray, end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes that share a prefix of ``least`` words (a power of two) with another, in order,
    and the number of each one's group of equal prefixes.

    Groups of equal prefixes are split by the groups that follow them, prefixes
    doubling each round; a suffix alone in its group is done. Words of different
    texts have different numbers, so texts never mix.
    """
    n = len(ids)
    array = np.argsort(ids, kind="stable")
    slots = np.arange(n)
    key = ids[array]
    rank = np.empty(n, dtype=np.int64)
    kept, groups = np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = 1
    pos = array
    while len(pos):
        new = np.ones(len(pos), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(pos)))
        rank[pos] = np.repeat(slots[starts], size)
        array[slots] = pos
        many = np.repeat(size > 1, size)
        pos, slots = pos[many], slots[many]
        if length == least:
            kept, groups = slots, rank[pos]
        follow = pos + length
        inside = follow < end[pos]
        second = np.where(inside, rank[np.minimum(follow, n - 1)], -1)
        key = rank[pos] * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        pos, key = pos[order], key[order]
        length *= 2
    return array[kept], groups


def _common_lengths(suffixes: list[int], groups: list[int], ids: list[int], end: list[int], least: int) -> list[int]:
    """Words that each suffix shares with the one before it (0 where they are of different groups).

    Positions are visited in text order; the length falls by one word at most
    from one to the next, so every word is compared a bounded number of times.
    """
    common = [0] * len(suffixes)
    place = {p: k for k, p in enumerate(suffixes)}
    held, last = 0, -2
    for p in sorted(suffixes):
        k = place[p]
        held = held - 1 if last == p - 1 else 0
        last = p
        if k == 0 or groups[k] != groups[k - 1]:
            held = 0
            continue
        q = suffixes[k - 1]
        held = max(held, least)
        limit = min(end[p] - p, end[q] - q)
        while held < limit and ids[p + held] == ids[q + held]:
            held += 1
        common[k] = held
    return common


class _Node:
    """Leaves below a node: their places in order, and a list of places for each word to their left."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.lists = {left: [place]}


def _merged(a: _Node, b: _Node, depth: int, spec: RunSpec, left: list[int], found: Callable[[int, int, int], None]) -> _Node:
    """Both nodes in one; pairs across them with different left words and a near enough distance are maximal.

    Every place of the smaller node looks into the larger one's places within the
    greatest distance. Counted against the list of its own left word, that tells
    if there is a pair at all. Places so near to each other are one period apart
    in a row, and all but the first of a row have the same word to the left; so
    those with another left word stand at an end, and no place is looked at that
    makes no pair.
    """
    if len(a.places) < len(b.places):
        a, b = b, a
    far = depth // (spec.periods - 1)
    places, lists = a.places, a.lists
    for i in b.places:
        lo, hi = bisect_left(places, i - far), bisect_right(places, i + far)
        if lo == hi:
            continue
        mine = left[i]
        own = lists.get(mine, ())
        other = hi - lo - (bisect_right(own, i + far) - bisect_left(own, i - far))
        while other and left[places[lo]] != mine:
            found(i, places[lo], depth)
            other, lo = other - 1, lo + 1
        while other:
            hi -= 1
            if left[places[hi]] != mine:
                found(i, places[hi], depth)
                other -= 1
    for i in b.places:
        insort(places, i)
    for word, some in b.lists.items():
        mine = lists.get(word)
        if mine is None:
            lists[word] = some
        else:
            for i in some:
                insort(mine, i)
    return a


def _maximal_pairs(suffixes: list[int], common: list[int], left: list[int], spec: RunSpec) -> dict[tuple[int, int], int]:
    """(first, one past the last word) of each run, and its least period.

    Goes through the intervals of equal prefixes from the longest up. Two places
    whose words to the left differ, and whose common words end where they meet in
    the tree, are a maximal pair; at a distance of a third of those words it is a
    run whose period is that distance, or a multiple of the run's least period.
    """
    runs: dict[tuple[int, int], int] = {}

    def found(i: int, j: int, depth: int) -> None:
        if i > j:
            i, j = j, i
        period = j - i
        if depth + period >= spec.words:
            key = (i, j + depth)
            if period < runs.get(key, period + 1):
                runs[key] = period

    least = spec.depth
    stack: list[tuple[int, _Node]] = []
    n = len(suffixes)
    for k in range(1, n + 1):
        here = common[k] if k < n else 0
        if here < least and not stack:
            continue
        node = _Node(suffixes[k - 1], left[suffixes[k - 1]])
        while stack and stack[-1][0] > here:
            depth, above = stack.pop()
            node = _merged(above, node, depth, spec, left, found)
        if stack and stack[-1][0] == here:
            stack[-1] = (here, _merged(stack[-1][1], node, here, spec, left, found))
        elif here >= least:
            stack.append((here, node))
    return runs


def find_runs(texts: list[list[bytes]], spec: RunSpec) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    ids, first = _numbered(texts)
    if not len(ids):
        return out
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    end = first[1:][owner]
    # The power of two just at or below the least common length.
    least = 1 << (spec.depth.bit_length() - 1)
    suffixes, groups = _sorted_suffixes(ids, end, least)
    if not len(suffixes):
        return out
    left = np.full(len(ids), -1, dtype=np.int64)
    left[1:] = ids[:-1]
    left[first[:-1][first[:-1] < len(ids)]] = -1
    plain = suffixes.tolist()
    common = _common_lengths(plain, groups.tolist(), ids.tolist(), end.tolist(), least)
    for (lo, hi), period in _maximal_pairs(plain, common, left.tolist(), spec).items():
        text = int(owner[lo])
        out[text].append((lo - int(first[text]), hi - lo, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; ties to the least start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, made periodic from some word on in a tenth of all, as its id says."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_OUT = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, n_dropped long, collapsed_sha256 string"
)


def _run_batches(spec: RunSpec, plant: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        for block in blocks(batch.column("text")):
            data, starts = block.data.tobytes(), block.starts.tolist()
            texts = [data[s:e].split() for s, e in zip(starts[:-1], starts[1:])]
            ids = doc_ids[block.lo : block.hi]
            if plant:
                texts = [planted(words, i) for words, i in zip(texts, ids)]
            rows = []
            for doc_id, words, runs in zip(ids, texts, find_runs(texts, spec)):
                kept, best = words, strongest(runs)
                if runs:
                    kept = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                rows.append((
                    doc_id, len(words), len(runs), *(best or (None, None, None)),
                    1000 * best[1] // best[2] if best else None,
                    hashlib.sha256(listed.encode()).hexdigest(),
                    len(words) - len(kept),
                    hashlib.sha256(b" ".join(kept)).hexdigest(),
                ))
            names = [part.split()[0] for part in _OUT.split(", ")]
            kinds = [pa.int64() if part.endswith(" long") else pa.string() for part in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _runs_list_batches(spec: RunSpec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        for block in blocks(batch.column("text")):
            data, starts = block.data.tobytes(), block.starts.tolist()
            texts = [data[s:e].split() for s, e in zip(starts[:-1], starts[1:])]
            rows = [
                (doc_id, *run, b" ".join(words[run[0] : run[0] + run[2]]).decode("utf-8", "replace"))
                for doc_id, words, runs in zip(doc_ids[block.lo : block.hi], texts, find_runs(texts, spec))
                for run in runs
            ]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "length", "period", "words"]
            )


def periodic_runs(docs: DataFrame, spec: RunSpec = RunSpec()) -> DataFrame:
    """(doc_id, start, length, period, words) of every run of every text; ``words`` are its first period.

    A run is a stretch of words whose smallest period is ``period``, of the
    lengths ``spec`` asks for, that no neighbouring word goes on. Words are cut at
    ASCII white space and numbered from 0. Texts are worked on where they are, in
    memory in proportion to the longest text; nothing is shuffled. Null and blank
    texts have no runs. Rows count by themselves, also if they share a doc_id or
    have none. Other columns are ignored; an empty frame gives an empty one.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(
        slim,
        lambda b: _runs_list_batches(spec, b),
        "doc_id long, start long, length long, period long, words string",
    )


def run_report(docs: DataFrame, spec: RunSpec = RunSpec(), plant: bool = True) -> DataFrame:
    """One row per document: its runs as a count and a digest, the strongest one, and what is left without repeats.

    ``plant`` first makes the words of a tenth of the documents periodic, as a
    function of their id; rows without one stay as they are. A word is dropped if
    a run contains it after that run's first period. Without a run the four
    columns of the strongest are null; null and blank texts have no words, and
    the digests of nothing. An empty frame gives an empty one.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(slim, lambda b: _run_batches(spec, plant, b), _OUT)
