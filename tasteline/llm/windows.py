"""Equal windows of texts brought together: anchors, candidate segments, and removal of spans.

A window of ``size`` units (words or bytes) is represented by its anchor: the place
of the least hash among its runs of ``k`` units. Equal windows have equal anchors
at equal places, so they meet if texts are spread by anchor; neighbouring windows
mostly share one and travel as one segment. Anchors that occur in one place alone
are dropped first, so only texts that can match are moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import Block, blocks, mix64, prefix_hash, range_hash
from tasteline.session import materialize


class Units(NamedTuple):
    """A block's texts as units: first unit of each text (n + 1), prefix hashes over the units,
    and the bytes where each unit begins and ends."""

    first: np.ndarray
    prefix: np.ndarray
    start: np.ndarray
    end: np.ndarray


class Plan(NamedTuple):
    """How to cut a block into units, window and anchor length, and whether a text may match itself."""

    units: Callable[[Block], Units]
    size: int
    k: int
    within: bool


class Runs(NamedTuple):
    """Maximal runs of windows with one anchor: text, first and last window start, anchor, its hash."""

    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    key: np.ndarray


def anchor_runs(units: Units, plan: Plan) -> Runs:
    """The runs of all windows of a block; texts shorter than a window have none."""
    n = int(units.first[-1])
    width = plan.size - plan.k + 1
    none = np.zeros(0, np.int64)
    if n < plan.size:
        return Runs(none, none, none, none, none.view(np.uint64))
    at = np.arange(n - plan.k + 1)
    least = range_hash(units.prefix, at, at + plan.k)
    keys, where, have = least, at, 1
    while have < width:
        step = min(have, width - have)
        right = least[step:] < least[:-step]
        where = np.where(right, where[step:], where[:-step])
        least = np.where(right, least[step:], least[:-step])
        have += step
    text = np.repeat(np.arange(len(units.first) - 1), np.diff(units.first))
    start = np.flatnonzero(text[: n - plan.size + 1] == text[plan.size - 1 :])
    if not len(start):
        return Runs(none, none, none, none, none.view(np.uint64))
    place = where[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    return Runs(text[start[head]], start[head], start[tail], place[head], keys[place[head]])


def ragged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all ranges [start, end), one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(parts)).astype(np.int64)


# First pass: which anchors occur in more than one place.

_MARK = "part int, known boolean, fp binary, n binary, keys binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("known", pa.bool_()), ("fp", pa.binary()), ("n", pa.binary()), ("keys", pa.binary())])


def _grouped(fp: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in order with the number of entries of each; entries must be sorted by text."""
    head = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
    return fp[head], np.diff(np.append(head, len(fp)))


def _mark(part: int, known: bool, fp: np.ndarray, key: np.ndarray) -> dict:
    order = np.argsort(fp, kind="stable")
    texts, n = _grouped(fp[order], key[order])
    return {"part": part, "known": known, "fp": texts.tobytes(), "n": n.astype(np.int32).tobytes(), "keys": key[order].tobytes()}


def _mark_batches(plan: Plan, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of a batch by part. Those in several texts of the batch are known to repeat:
    they go out as such, and one entry alone tells the other batches."""
    for batch in batches:
        ids = batch.column("fp").to_numpy()
        fps, keys, selfs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
        for block in blocks(batch.column("text")):
            runs = anchor_runs(plan.units(block), plan)
            if not len(runs.key):
                continue
            order = np.lexsort((runs.key, runs.text))
            text, key = runs.text[order], runs.key[order]
            head = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (key[1:] != key[:-1])]))
            fps.append(ids[block.lo + text[head]])
            keys.append(key[head])
            selfs.append(np.diff(np.append(head, len(key))) > 1)
        fp, key, twice = np.concatenate(fps), np.concatenate(keys), np.concatenate(selfs)
        if not len(key):
            continue
        order = np.lexsort((fp, key))
        fp, key, twice = fp[order], key[order], twice[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(head, len(key)))
        known = np.repeat(np.maximum.reduceat(fp, head) != np.minimum.reduceat(fp, head), size)
        if plan.within:
            known |= twice
        sent = ~known
        sent[head] = True
        rows = []
        if known.any():
            rows.append(_mark(int(part_of(key[:1], parts)[0]), True, fp[known], key[known]))
        fp, key = fp[sent], key[sent]
        part = part_of(key, parts)
        order = np.argsort(part, kind="stable")
        fp, key, part = fp[order], key[order], part[order]
        bounds = np.searchsorted(part, np.arange(parts + 1))
        rows += [_mark(int(p), False, fp[s:e], key[s:e]) for p, s, e in zip(range(parts), bounds[:-1], bounds[1:]) if e > s]
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[at : at + 64], schema=_SCHEMA)


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one part after the other; they come sorted by part."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != held[0]["part"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _per_text(fp: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(fp, kind="stable")
    texts, n = _grouped(fp[order], key[order])
    places = pa.array((np.concatenate([[0], np.cumsum(n)]) * 8).astype(np.int32))
    keys = pa.Array.from_buffers(pa.binary(), len(texts), [None, places.buffers()[1], pa.py_buffer(key[order].tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(texts), keys], names=["fp", "keys"])


def _repeat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, anchors of it that repeat somewhere)."""
    for rows in by_part(batches):
        fps, keys = [], []
        for row in rows:
            fp = np.repeat(np.frombuffer(row["fp"], np.int64), np.frombuffer(row["n"], np.int32))
            key = np.frombuffer(row["keys"], np.uint64)
            if row["known"]:
                yield _per_text(fp, key)
            else:
                fps.append(fp)
                keys.append(key)
        if not fps:
            continue
        fp, key = np.concatenate(fps), np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        fp, key = fp[order], key[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        several = np.maximum.reduceat(fp, head) != np.minimum.reduceat(fp, head)
        several = np.repeat(several, np.diff(np.append(head, len(key))))
        if several.any():
            yield _per_text(fp[several], key[several])


# Second pass: segments around repeating anchors.

_SEGMENTS = "part int, fp binary, id binary, low binary, windows binary, anchor binary, key binary, data binary"
_SEGMENT_SCHEMA = pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in "fp id low windows anchor key data".split()])


class Segments(NamedTuple):
    """Segments of one part: text, its doc_id, first window, number of windows, place of the
    anchor after the first window's start, the anchor's hash, and the bytes end to end."""

    fp: np.ndarray
    id: np.ndarray
    low: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    data: np.ndarray


def _read_segments(rows: list[dict]) -> Segments:
    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(r[name], kind) for r in rows])

    return Segments(
        column("fp", np.int64), column("id", np.int64), column("low", np.int32).astype(np.int64),
        column("windows", np.int32).astype(np.int64), column("anchor", np.int32).astype(np.int64),
        column("key", np.uint64), column("data", np.uint8),
    )


def spans(fp: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Units [low, high) of text ``fp`` to remove."""
    return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(low), pa.array(high)], names=["fp", "low", "high"])


def _same_bytes(data: np.ndarray, offset: np.ndarray, size: np.ndarray, leader: np.ndarray) -> np.ndarray:
    """Whether each segment has the bytes of its leader."""
    same = size == size[leader]
    own = np.flatnonzero(same & (leader != np.arange(len(leader))))
    for s in range(0, len(own), 1 << 14):
        a = own[s : s + (1 << 14)]
        p, q, n = offset[a], offset[leader[a]], size[a]
        equal = data[ragged(p, p + n)] == data[ragged(q, q + n)]
        same[a] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return same


def _cut_batches(plan: Plan, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a batch by part; the anchors wanted of a text come as a list of packed hashes."""
    for batch in batches:
        ids, fps = batch.column("id").to_numpy(), batch.column("fp").to_numpy()
        wanted = batch.column("keys")
        got: list[tuple] = []
        for block in blocks(batch.column("text")):
            units = plan.units(block)
            runs = anchor_runs(units, plan)
            if not len(runs.key):
                continue
            bounds = np.searchsorted(runs.text, np.arange(block.hi - block.lo + 1))
            keep = np.zeros(len(runs.key), dtype=bool)
            for i in range(block.hi - block.lo):
                keys = np.frombuffer(b"".join(wanted[block.lo + i].as_py()), np.uint64)
                s, e = bounds[i], bounds[i + 1]
                keep[s:e] = np.isin(runs.key[s:e], keys)
            text, low, high, anchor, key = (x[keep] for x in runs)
            last = high + plan.size
            begin, end = units.start[low], units.end[last - 1]
            # One byte between segments, so that their last words stay apart.
            data = np.append(block.data, np.uint8(10))
            places = ragged(begin, end + 1)
            ends = np.cumsum(end + 1 - begin) - 1
            places[ends] = len(block.data)
            got.append(
                (
                    fps[block.lo + text], ids[block.lo + text], low - units.first[text], high - low + 1, anchor - low, key,
                    range_hash(units.prefix, low, last), end + 1 - begin, data[places],
                )
            )
        if not got:
            continue
        fp, doc, low, windows, anchor, key, whole, size, data = (np.concatenate([g[i] for g in got]) for i in range(9))
        # Equal segments of the batch: the class's least document speaks for all.
        whole = mix64(whole ^ mix64(key + anchor.astype(np.uint64)))
        order = np.lexsort((doc, whole))
        head = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
        lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        leader = np.empty(len(order), np.int64)
        leader[order] = lead
        offset = np.cumsum(size) - size
        # Hashes that collide don't settle anything: such a segment goes on by itself.
        other = ~_same_bytes(data, offset, size, leader)
        leader[other] = np.flatnonzero(other)
        if plan.within:
            sent = leader == np.arange(len(leader))
            settled = np.bincount(leader, minlength=len(leader))[leader] > 1
        else:
            settled = doc > doc[leader]
            sent = ~settled
        part = np.where(sent, part_of(key, parts), -1)
        rows = []
        if settled.any():
            # Spans already known travel without bytes.
            rows.append(
                {
                    "part": int(part_of(key[:1], parts)[0]), "fp": fp[settled].tobytes(), "id": b"",
                    "low": low[settled].astype(np.int32).tobytes(), "windows": windows[settled].astype(np.int32).tobytes(),
                    "anchor": b"", "key": b"", "data": b"",
                }
            )
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        for p, s, e in zip(range(parts), bounds[:-1], bounds[1:]):
            if e > s:
                own = order[s:e]
                rows.append(
                    {
                        "part": p, "fp": fp[own].tobytes(), "id": doc[own].tobytes(), "low": low[own].astype(np.int32).tobytes(),
                        "windows": windows[own].astype(np.int32).tobytes(), "anchor": anchor[own].astype(np.int32).tobytes(),
                        "key": key[own].tobytes(), "data": data[ragged(offset[own], offset[own] + size[own])].tobytes(),
                    }
                )
        for at in range(0, len(rows), 16):
            yield pa.RecordBatch.from_pylist(rows[at : at + 16], schema=_SEGMENT_SCHEMA)


Kernel = Callable[[Segments], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _match_batches(plan: Plan, kernel: Kernel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that the kernel finds matched, and those settled before."""
    for rows in by_part(batches):
        for row in rows:
            if not row["key"]:
                low = np.frombuffer(row["low"], np.int32).astype(np.int64)
                n = np.frombuffer(row["windows"], np.int32).astype(np.int64)
                yield spans(np.frombuffer(row["fp"], np.int64), low, low + n - 1 + plan.size)
        rows = [r for r in rows if r["key"]]
        if rows:
            fp, low, high = kernel(_read_segments(rows))
            if len(fp):
                yield spans(fp, low, high + plan.size)


def matched_runs(segments: Segments, matched: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, last window) of maximal runs of matched windows within segments.

    ``matched`` has a flag per window, segment after segment.
    """
    base = np.cumsum(segments.windows) - segments.windows
    owner = np.repeat(np.arange(len(base)), segments.windows)
    inside = matched.copy()
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1] & (owner[1:] == owner[:-1])
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:] & (owner[1:] == owner[:-1])
    head, tail = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    own = owner[head]
    return segments.fp[own], segments.low[own] + head - base[own], segments.low[own] + tail - base[own]


def duplicate_spans(docs: DataFrame, plan: Plan, kernel: Kernel, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts (sum, fp, rep, copies) and spans (fp, low, high) to remove from each.

    ``docs`` has doc_id, text (neither null) and ``rows``, the number of rows that
    one stands for. Equal texts are compared once, by the least doc_id of their
    class; what follows from being a copy is up to the caller.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select("doc_id", "text", "rows", F.md5(F.col("text").cast("binary")).alias("sum"), F.xxhash64("text").alias("fp"))
    classes = named.groupBy("sum", "fp").agg(F.min("doc_id").alias("rep"), F.sum("rows").alias("copies"))
    classes = materialize(classes, "span-classes")

    marks = map_batches(named.select("fp", "text"), lambda b: _mark_batches(plan, parts, b), _MARK)
    marks = marks.repartition(tasks, "part").sortWithinPartitions("part")
    repeats = map_batches(marks, _repeat_batches, "fp long, keys binary")
    lists = repeats.groupBy("fp").agg(F.collect_list("keys").alias("keys"))
    asked = materialize(classes.select("sum", "rep", "fp").join(lists, "fp"), "span-asked")

    texts = named.drop("fp", "rows").join(asked, "sum").where(F.col("doc_id") == F.col("rep"))
    texts = texts.select("fp", F.col("rep").alias("id"), "keys", "text")
    segments = map_batches(texts, lambda b: _cut_batches(plan, parts, b), _SEGMENTS)
    segments = segments.repartition(tasks, "part").sortWithinPartitions("part")
    found = map_batches(segments, lambda b: _match_batches(plan, kernel, b), "fp long, low long, high long")
    return classes, materialize(found, "span-found")


def with_spans(docs: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with the class's ``rep`` and ``copies`` and its ``spans``."""
    pieces = found.groupBy("fp").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    verdict = materialize(classes.join(pieces, "fp", "left").drop("fp"), "span-verdicts")
    named = docs.withColumn("sum", F.md5(F.col("text").cast("binary")))
    return named.join(verdict, "sum", "left").drop("sum")


def covered(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Flags of the units 0..n-1 inside any span."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps)[:n] > 0
