"""Stupid-backoff language-model scores from count tables spread over tasks by hash."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.llm.ship import map_batches
from tasteline.llm.spans import blocks, mix64, split_words
from tasteline.session import materialize

# Score units per nat: sums of whole numbers don't depend on their order.
UNIT = 1_000_000


@dataclass(frozen=True)
class LmSpec:
    """A bigram model with stupid backoff over exact words, each occurrence left out of its own counts.

    A word w after v scores (c(vw) - 1) / (c(v) - 1) if the bigram occurs again,
    else ``alpha`` times (c(w) - 1) / (N - 1); a word that occurs once counts as
    one there. Words of a ``frequent``-th of all words or more, which are
    ``frequent`` at most, are known to every task with their counts; the counts of
    all others are joined. Bigrams of at least a ``hot_share``-th of all in some
    batch are candidates for the table of hot bigrams, which has twice
    ``hot_share`` entries at most. ``parts`` spreads the bigrams (None: by the
    number of words).
    """

    alpha: float = 0.4
    frequent: int = 1 << 20
    hot_share: int = 1024
    parts: int | None = None


# Words that a part holds on average.
_PART_WORDS = 1_000_000
# The word before the first one; no hash of a word, as these have their lowest bit set.
_START = np.uint64(0)


class Frequent(NamedTuple):
    """Hashes of the frequent words and of the start, rising, and their counts; words in all."""

    words: np.ndarray
    counts: np.ndarray
    total: int

    def places(self, words: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is rare."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)


# Bytes of text split into words at once: a task's arrays for that have some 40 times as many.
_BLOCK_BYTES = 1 << 17


def _bigrams(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: its documents' rows, and for every word the row, the word before it and the word."""
    for block in blocks(batch.column("text"), _BLOCK_BYTES):
        words = split_words(block)
        n = np.diff(words.first)
        row = block.lo + np.repeat(np.arange(len(n)), n)
        last = words.hash | np.uint64(1)
        before = np.empty_like(last)
        before[1:] = last[:-1]
        before[words.first[:-1][n > 0]] = _START
        yield row, before, last


def _pair(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix64(before * np.uint64(3) + last)


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(parts)).astype(np.int64)


# Words of a batch spread together, and counted together; counting holds more copies of them.
_WORDS = 1 << 20
_COUNT_WORDS = 1 << 18


def _gathered(batches: Iterator[pa.RecordBatch], words: int = _WORDS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, row, word before and word) of about ``words`` words at a time."""
    for batch in batches:
        held, n = [], 0
        for got in _bigrams(batch):
            held.append(got)
            n += len(got[0])
            if n >= words:
                yield batch, *(np.concatenate([h[i] for h in held]) for i in range(3))
                held, n = [], 0
        if n:
            yield batch, *(np.concatenate([h[i] for h in held]) for i in range(3))


def _word_batches(spec: LmSpec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 0, the start among them) and candidates for hot bigrams (kind 1), some words at a time.

    A bigram of a ``hot_share``-th of all words is one of a share as large of some of these stretches.
    """
    for _, _, before, last in _gathered(batches, _COUNT_WORDS):
        words, n = np.unique(last, return_counts=True)
        words, n = np.append(words, _START), np.append(n, (before == _START).sum())
        pairs, times = np.unique(_pair(before, last), return_counts=True)
        hot = times * spec.hot_share >= len(last)
        kind = np.repeat(np.array([0, 1], np.int32), [len(words), int(hot.sum())])
        keys = np.concatenate([words, pairs[hot]]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(keys), pa.array(np.concatenate([n, times[hot]]))], names=["kind", "key", "n"]
        )


def _hot_batches(hot: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact counts of the hot bigrams in each batch."""
    for batch in batches:
        for _, before, last in _bigrams(batch):
            key = _pair(before, last)
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            found, n = np.unique(at[hot[at] == key], return_counts=True)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(hot[found].view(np.int64)), pa.array(n)], names=["key", "n"])


def _known(pairs: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Score of bigrams that occur again, in units; ``pairs`` and ``before`` are counts."""
    return np.rint(np.log((pairs - 1) / (before - 1)) * UNIT).astype(np.int64)


def _backed_off(spec: LmSpec, last: np.ndarray, total: int) -> np.ndarray:
    """Score of bigrams that occur once, from the counts of their last words."""
    return np.rint(np.log(spec.alpha * np.maximum(last - 1, 1) / max(total - 1, 1)) * UNIT).astype(np.int64)


def _scores(spec: LmSpec, pairs: np.ndarray, before: np.ndarray, last: np.ndarray, total: int) -> np.ndarray:
    again = pairs > 1
    out = np.empty(len(pairs), np.int64)
    out[again] = _known(pairs[again], before[again])
    out[~again] = _backed_off(spec, last[~again], total)
    return out


# Kinds of packed rows: bigrams of frequent words, those whose last word is rare, those whose first word alone is
# rare, sums of hot bigrams, counts of rare words, and bigrams of two rare words that still lack the first one's count.
_FREQUENT, _LAST, _FIRST, _HOT, _COUNTS, _LACKING = range(6)
_FIELDS = ("doc", "n", "one", "two")
_PACK = "part int, kind int, " + ", ".join(f"{c} binary" for c in _FIELDS)
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32())] + [(c, pa.binary()) for c in _FIELDS])


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, and so on: high bytes that are the same compress."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes() if len(numbers) else b""


def _numbers(data: bytes, kind: type, width: int | None = None) -> np.ndarray:
    """What ``_planes`` packed, of ``width`` bytes each; missing high bytes are zero."""
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width or size, -1)
    out = np.zeros((planes.shape[1], size), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view(kind)


def _packed(part: int, kind: int, *arrays: np.ndarray | bytes) -> dict:
    cells = [a if isinstance(a, bytes) else _planes(a) for a in arrays]
    return {"part": part, "kind": kind, **dict(zip(_FIELDS, cells + [b""] * (4 - len(cells))))}


# Bytes that hold a bigram of two frequent words.
_KEY_BYTES = 6


def _named(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Twice the place of frequent words, the hash of rare ones, which is odd."""
    return np.where(at >= 0, at.astype(np.uint64) << np.uint64(1), words)


def _places(named: np.ndarray) -> np.ndarray:
    """Places out of ``_named``, -1 for rare words."""
    return np.where(named & np.uint64(1), -1, (named >> np.uint64(1)).astype(np.int64))


def _rows_by_part(kind: int, part: np.ndarray, parts: int, ids: np.ndarray, row: np.ndarray, *keys: np.ndarray) -> Iterator[dict]:
    """Packed rows of the bigrams of each part, by document; ``keys`` are arrays of so many bytes a bigram."""
    order = np.argsort(part, kind="stable")
    row, keys, bounds = row[order], [np.ascontiguousarray(k[order]) for k in keys], np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(bounds)).tolist():
        s, e = bounds[p], bounds[p + 1]
        first = np.flatnonzero(np.concatenate([[True], row[s + 1 : e] != row[s : e - 1]]))
        n = np.diff(np.append(first, e - s)).astype(np.int32)
        yield _packed(p, kind, ids[row[s:e][first]], n, *[k[s:e] for k in keys])


def _spread_batches(
    spec: LmSpec, frequent: Frequent, hot: tuple[np.ndarray, np.ndarray], parts: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Bigrams of each batch by part: that of the bigram, or of the rare word whose count it needs. Hot ones are scored here."""
    turn = 0
    for batch, row, before, last in _gathered(batches):
        ids, rows = batch.column("doc").to_numpy(), []
        left, right = frequent.places(before), frequent.places(last)
        if len(hot[0]):
            key = _pair(before, last)
            at = np.minimum(np.searchsorted(hot[0], key), len(hot[0]) - 1)
            # A hot bigram has two frequent words unless the hot share is set beyond theirs.
            is_hot = (hot[0][at] == key) & (left >= 0) & (right >= 0)
            pairs = hot[1][at[is_hot]]
            score = _scores(spec, pairs, frequent.counts[left[is_hot]], frequent.counts[right[is_hot]], frequent.total)
            n = np.bincount(row[is_hot], minlength=len(ids))
            known = np.bincount(row[is_hot], weights=pairs > 1, minlength=len(ids)).astype(np.int32)
            sums = np.zeros(len(ids), np.int64)
            np.add.at(sums, row[is_hot], score)
            some = n > 0
            turn += 1
            home = int(_part_of(ids[:1].view(np.uint64) + np.uint64(31 * turn), parts)[0])
            rows.append(_packed(home, _HOT, ids[some], n[some].astype(np.int32), known[some], sums[some]))
            row, before, last, left, right = (x[~is_hot] for x in (row, before, last, left, right))
        both, end, start = (left >= 0) & (right >= 0), right < 0, (left < 0) & (right >= 0)
        key = (left[both].astype(np.uint64) << np.uint64(8 * _KEY_BYTES // 2)) | right[both].astype(np.uint64)
        short = key.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]
        rows += _rows_by_part(_FREQUENT, _part_of(key, parts), parts, ids, row[both], short)
        rows += _rows_by_part(_LAST, _part_of(last[end], parts), parts, ids, row[end], last[end], _named(before, left)[end])
        rows += _rows_by_part(_FIRST, _part_of(before[start], parts), parts, ids, row[start], before[start], _named(last, right)[start])
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[at : at + 256], schema=_SCHEMA)


def _count_batches(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of rare words by part."""
    for batch in batches:
        words, n = batch.column("key").to_numpy().view(np.uint64), batch.column("n").to_numpy()
        part = _part_of(words, parts)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        rows = [
            _packed(p, _COUNTS, b"", b"", words[order[s:e]], n[order[s:e]])
            for p, s, e in zip(range(parts), bounds[:-1], bounds[1:])
            if e > s
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _joined_counts(rows: list[dict], words: np.ndarray) -> np.ndarray:
    """Counts of words from the part's rows of counts, which have all of them."""
    listed, n = (np.concatenate([_numbers(r[c], t) for r in rows]) for c, t in (("one", np.uint64), ("two", np.int64)))
    order = np.argsort(listed)
    return n[order][np.searchsorted(listed[order], words)]


class Counted(NamedTuple):
    """Bigrams of a part in order: document, the two keys, and how often the bigram occurs."""

    doc: np.ndarray
    one: np.ndarray
    two: np.ndarray
    pairs: np.ndarray


def _counted(rows: list[dict], short: bool) -> Counted:
    """Count equal bigrams; all bigrams of one pair of words are in one part."""
    doc = np.concatenate([np.repeat(_numbers(r["doc"], np.int64), _numbers(r["n"], np.int32)) for r in rows])
    if short:
        key = np.concatenate([_numbers(r["one"], np.uint64, _KEY_BYTES) for r in rows])
        half = np.uint64(8 * _KEY_BYTES // 2)
        one, two = key >> half, key & ((np.uint64(1) << half) - np.uint64(1))
        order = np.argsort(key, kind="stable")
    else:
        one, two = (np.concatenate([_numbers(r[c], np.uint64) for r in rows]) for c in ("one", "two"))
        order = np.lexsort((two, one))
    doc, one, two = doc[order], one[order], two[order]
    first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
    n = np.diff(np.append(first, len(one)))
    return Counted(doc, one, two, np.repeat(n, n))


_SUMS = "home int, doc binary, n binary, known binary, score binary"
_SUMS_SCHEMA = pa.schema([("home", pa.int32())] + [(c, pa.binary()) for c in ("doc", "n", "known", "score")])


def _per_doc(doc: np.ndarray, known: np.ndarray, score: np.ndarray) -> list[np.ndarray]:
    """(document, words, known ones, score) of single words, summed."""
    order = np.argsort(doc, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], doc[order][1:] != doc[order][:-1]]))
    sums = [np.add.reduceat(x[order].astype(np.int64), first) for x in (known, score)]
    return [doc[order][first], np.diff(np.append(first, len(doc))), *sums]


def _dealt(parts: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Partial sums (doc, n, known, score) packed by the task in which their documents meet."""
    home = _part_of(columns[0].view(np.uint64), parts)
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(parts + 1))
    rows = []
    for p in np.flatnonzero(np.diff(bounds)).tolist():
        own = order[bounds[p] : bounds[p + 1]]
        rows.append({"home": p, **{name: _planes(c[own]) for name, c in zip(("doc", "n", "known", "score"), columns)}})
    return pa.RecordBatch.from_pylist(rows, schema=_SUMS_SCHEMA)


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document; rows come sorted by home."""

    def summed(rows: list[dict]) -> pa.RecordBatch:
        doc, *values = (np.concatenate([_numbers(r[c], np.int64) for r in rows]) for c in ("doc", "n", "known", "score"))
        order = np.argsort(doc, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], doc[order][1:] != doc[order][:-1]]))
        columns = [doc[order][first], *[np.add.reduceat(v[order], first) for v in values]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "n", "known", "score"])

    home, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["home"] != home and held:
                yield summed(held)
                held = []
            home = row["home"]
            held.append(row)
    if held:
        yield summed(held)


def _score_part(
    spec: LmSpec, frequent: Frequent, parts: int, rows: list[dict]
) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Count the bigrams of one part and score every document's share of them.

    Bigrams of two rare words that occur again go on to the part of the first one.
    """
    of = {kind: [r for r in rows if r["kind"] == kind] for kind in range(6)}
    for r in of[_HOT]:
        sums = [_numbers(r[c], t).astype(np.int64) for c, t in zip(_FIELDS, (np.int64, np.int32, np.int32, np.int64))]
        yield _HOT, _dealt(parts, sums)
    if of[_FREQUENT]:
        got = _counted(of[_FREQUENT], True)
        before, last = frequent.counts[got.one.astype(np.int64)], frequent.counts[got.two.astype(np.int64)]
        score = _scores(spec, got.pairs, before, last, frequent.total)
        yield _HOT, _dealt(parts, _per_doc(got.doc, got.pairs > 1, score))
    if of[_FIRST]:
        got = _counted(of[_FIRST], False)
        before, last = _joined_counts(of[_COUNTS], got.one), frequent.counts[_places(got.two)]
        score = _scores(spec, got.pairs, before, last, frequent.total)
        yield _HOT, _dealt(parts, _per_doc(got.doc, got.pairs > 1, score))
    if of[_LAST]:
        got = _counted(of[_LAST], False)
        last, at = _joined_counts(of[_COUNTS], got.one), _places(got.two)
        lacking = (got.pairs > 1) & (at < 0)
        here = ~lacking
        score = _scores(spec, got.pairs[here], frequent.counts[at[here]], last[here], frequent.total)
        if here.any():
            yield _HOT, _dealt(parts, _per_doc(got.doc[here], got.pairs[here] > 1, score))
        if lacking.any():
            doc, two, pairs = got.doc[lacking], got.two[lacking], got.pairs[lacking]
            part = _part_of(two, parts)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [
                _packed(p, _LACKING, doc[order[s:e]], pairs[order[s:e]], two[order[s:e]])
                for p, s, e in zip(range(parts), bounds[:-1], bounds[1:])
                if e > s
            ]
            yield _LACKING, pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
    if of[_LACKING]:
        doc, pairs, two = (
            np.concatenate([_numbers(r[c], t) for r in of[_LACKING]])
            for c, t in (("doc", np.int64), ("n", np.int64), ("one", np.uint64))
        )
        score = _known(pairs, _joined_counts(of[_COUNTS], two))
        yield _HOT, _dealt(parts, _per_doc(doc, np.ones(len(doc), bool), score))


_EITHER = "home int, doc binary, n binary, known binary, score binary, part int, kind int, one binary, two binary"


def _either(kind: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Sums and lacking bigrams in one schema: fields of the other kind are null."""
    fields = [part.split() for part in _EITHER.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    named = set(batch.schema.names)
    arrays = [batch.column(c) if c in named else pa.nulls(batch.num_rows, kinds[t]) for c, t in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in fields])


def _score_batches(
    spec: LmSpec, frequent: Frequent, parts: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Score part after part; rows come sorted by part."""
    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and held:
                yield from (_either(*x) for x in _score_part(spec, frequent, parts, held))
                held = []
            part = row["part"]
            held.append(row)
    if held:
        yield from (_either(*x) for x in _score_part(spec, frequent, parts, held))


def _null_id(ids: DataFrame) -> int:
    """An id that no document has, for those without one."""
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    ends = np.iinfo(np.int64)
    if low is None or low > ends.min:
        return int(ends.min)
    if high < ends.max:
        return high + 1
    after = ids.where(F.col("doc_id") < int(ends.max)).select((F.col("doc_id") + 1).alias("doc_id"))
    return after.join(ids, "doc_id", "left_anti").agg(F.min("doc_id")).first()[0]


def score(docs: DataFrame, spec: LmSpec) -> DataFrame:
    """(doc_id, n_words, n_known, log_score) of every doc_id in ``docs``.

    Counts cover all words of all rows. ``log_score`` is the sum of the words'
    log scores in millionths of a nat, ``n_known`` the number of words whose
    bigram occurs again; the first word is scored after a start mark. The table of
    word counts is made first. Then every bigram is sent, by document, to the part
    of its two frequent words or of its rare word, where equal bigrams are counted
    and joined with the counts of the part's rare words; a bigram of two rare
    words that occurs again is joined a second time. The sums are whole numbers,
    so their order does not matter. Words are told apart by 64-bit hashes. A rare
    word is rare, and hot bigrams have a table of bounded size, so no key gathers
    a large share of the rows in one task.

    Null and wordless texts have no words and a score of 0. Rows that share a
    doc_id (or have none) count and score as one document, and any long may be an
    id. An empty frame gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    null = F.lit(_null_id(named.select("doc_id")))
    slim = named.select(F.coalesce("doc_id", null).alias("doc"), "text")
    counted = map_batches(slim.select("text"), lambda b: _word_batches(spec, b), "kind int, key long, n long")
    counts = materialize(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    words = counts.where("kind = 0").select("key", "n")
    total = words.where("key <> 0").agg(F.sum("n")).first()[0] or 0
    parts = spec.parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // _PART_WORDS))

    # Shares of the whole sum to one, so at most ``frequent`` words and 2 * hot_share bigrams pass.
    often = (spec.frequent * F.col("n") >= total) | (F.col("key") == 0)
    table = words.where(often).toArrow()
    listed, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(listed)
    frequent = Frequent(listed[order], n[order], int(total))
    if not total:
        frequent = Frequent(np.zeros(1, np.uint64), np.zeros(1, np.int64), 0)
    likely = counts.where((F.col("kind") == 1) & (2 * spec.hot_share * F.col("n") >= total)).select("key").toArrow()
    hot = (np.sort(likely.column("key").to_numpy().view(np.uint64)), np.zeros(0, np.int64))
    if len(hot[0]):
        keys = hot[0]
        found = map_batches(slim.select("text"), lambda b: _hot_batches(keys, b), "key long, n long")
        got = found.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        order = np.argsort(got.column("key").to_numpy().view(np.uint64))
        hot = (got.column("key").to_numpy().view(np.uint64)[order], got.column("n").to_numpy()[order])

    def in_parts(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "part").sortWithinPartitions("part")

    def scored(rows: DataFrame) -> DataFrame:
        return map_batches(in_parts(rows), lambda b: _score_batches(spec, frequent, parts, b), _EITHER)

    rare = map_batches(words.where(~often), lambda b: _count_batches(parts, b), _PACK)
    packed = map_batches(slim, lambda b: _spread_batches(spec, frequent, hot, parts, b), _PACK)
    first = materialize(scored(packed.unionByName(rare)), "lm-scored")
    lacking = first.where(F.col("kind") == _LACKING).select("part", "kind", *_FIELDS)
    second = scored(lacking.unionByName(rare))
    sums = first.where("home IS NOT NULL").unionByName(second).select("home", "doc", "n", "known", "score")
    met = sums.repartition(parts, "home").sortWithinPartitions("home")
    sums = map_batches(met, _sum_batches, "doc long, n long, known long, score long")
    out = slim.select("doc").distinct().join(sums, "doc", "left")
    return out.select(
        F.when(F.col("doc") != null, F.col("doc")).alias("doc_id"),
        F.coalesce("n", F.lit(0)).alias("n_words"),
        F.coalesce("known", F.lit(0)).alias("n_known"),
        F.coalesce("score", F.lit(0)).alias("log_score"),
    )


def score_report(docs: DataFrame, spec: LmSpec) -> DataFrame:
    """Scores with the perplexity per word (null without words)."""
    mean = F.col("log_score") / F.col("n_words") / UNIT
    return score(docs, spec).withColumn(
        "perplexity", F.when(F.col("n_words") > 0, F.round(F.exp(-mean), 4))
    )
