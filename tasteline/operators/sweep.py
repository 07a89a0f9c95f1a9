"""Top-k matches of many left rows: each task sweeps the whole right side and keeps its lists."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.session import discard, materialize

# List entries and left-out pairs that a task holds, and scores that are held at a time.
LIST_CELLS = 2_000_000
PAIRS = 4_000_000
_CELLS = 2_000_000
# Whole numbers below this are exact in single precision, in any order of summation.
_EXACT = 2**24
# monotonically_increasing_id keeps the row number in its low 33 bits.
_ROW_BITS = 33

Batches = Iterator[pa.RecordBatch]


def swept(left: DataFrame, right: DataFrame, k: int, taken: DataFrame | None, blocks: int) -> DataFrame:
    """(id, other, rating): the ``k`` best ``right`` rows of each ``left`` row, as two arrays.

    ``right`` (id, features, _norm, _block) is packed once into binary rows, a file
    for each block. ``left`` is dealt into ``blocks`` parts with their pairs of
    ``taken`` (id, other), a task each. A task reads the blocks one after the other
    and keeps the k best of its rows; a list leaves it once, when it is whole, and
    is never shuffled or written. The blocks are read from the shared folder by
    every task, so neither side is copied: scratch space is one copy of each.
    """
    packed = _packed(right)
    mine = left.select("id", "features", F.lit(None).cast("int").alias("other"))
    if taken is not None:
        pairs = taken.where(F.col("id").isNotNull() & F.col("other").isNotNull())
        mine = mine.unionByName(pairs.select("id", F.lit(None).cast("array<float>").alias("features"), "other"))
    parts = mine.repartitionById(blocks, F.pmod(F.hash("id"), F.lit(blocks))).mapInArrow(
        _pack_left, "part int, left_ids binary, left_features binary, owners binary, others binary"
    )
    # The block of the longest vectors first, for early bounds; every order gives the same lists.
    ordered = packed.where(F.col("_block") == 0).union(packed.where(F.col("_block") > 0)).coalesce(1)
    paired = ordered.hint("shuffle_replicate_nl").crossJoin(parts)
    # A partition of the pairs has one part of the left side; its bytes go to the worker once.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**_ROW_BITS - 1))
    once = [F.when(row == 0, F.col(c)).alias(c) for c in parts.columns[1:]]
    return paired.select("ids", "features", "longest", "part", *once).mapInArrow(
        _sweep(k), "id int, other array<int>, rating array<double>"
    )


def _packed(right: DataFrame) -> DataFrame:
    """(_block, longest, ids, features), one row per block."""
    last = right.agg(F.max("_block")).first()[0] or 0
    dealt = right.select(F.col("_block").cast("int").alias("_block"), "id", "features", "_norm")
    packed = dealt.repartitionById(last + 1, F.col("_block")).mapInArrow(
        _pack_right, "_block int, longest double, ids binary, features binary"
    )
    packed = materialize(packed, "topk-packed")
    discard(right, "topk-right")
    return packed


def matrix(features: pa.ChunkedArray) -> np.ndarray:
    features = features.combine_chunks()
    if features.null_count:
        raise ValueError("a row without features can't be matched")
    return features.flatten().to_numpy().reshape(len(features), -1)


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Scalar products of row pairs in double, summed in the order of the dimensions."""
    total = np.zeros(len(left))
    for d in range(left.shape[1]):
        total += left[:, d].astype(np.float64) * right[:, d]
    return total


def _ints(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int32)


def _pack_right(batches: Batches) -> Batches:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    ids, features = _ints(table.column("id")), matrix(table.column("features"))
    order = np.argsort(ids, kind="stable")
    columns = [
        table.column("_block").slice(0, 1).combine_chunks(),
        pa.array([max(table.column("_norm").to_pylist())]),
        pa.array([ids[order].tobytes()], pa.binary()),
        pa.array([features[order].astype(np.float32).tobytes()], pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["_block", "longest", "ids", "features"])


def _pack_left(batches: Batches) -> Batches:
    """One row: ids and features by rising id, and the left-out pairs by rising right id."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    own = table.filter(table.column("other").is_null())
    if not own.num_rows:
        return
    ids, features = _ints(own.column("id")), matrix(own.column("features")).astype(np.float32)
    order = np.argsort(ids, kind="stable")
    ids, features = ids[order], features[order]
    cut = table.filter(table.column("other").is_valid())
    owner, other = _ints(cut.column("id")), _ints(cut.column("other"))
    # Rows that share an id have the same pairs left out.
    pair, row = _expanded(np.searchsorted(ids, owner), np.searchsorted(ids, owner, "right"))
    other = other[pair]
    by_other = np.argsort(other, kind="stable")
    columns = (ids, features, row[by_other].astype(np.int32), other[by_other])
    names = ["part", "left_ids", "left_features", "owners", "others"]
    packed = [pa.array([c.tobytes()], pa.binary()) for c in columns]
    yield pa.RecordBatch.from_arrays([pa.array(ids[:1]), *packed], names=names)


def _expanded(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the ranges first..end - 1, with the number of its range."""
    sizes = end - first
    which = np.repeat(np.arange(len(first)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


def _nonzero(cells: np.ndarray) -> np.ndarray:
    """Places of the true cells of a flat array of whole words; few are."""
    words = np.flatnonzero(cells.view(np.uint64) != 0)
    places = (words[:, None] * 8 + np.arange(8)).ravel()
    return places[cells[places]]


def _sweep(k: int) -> Callable[[Batches], Batches]:
    def sweep(batches: Batches) -> Batches:
        lists = one = None
        for batch in batches:
            for ids, features, longest, part, *left in zip(*batch.columns):
                if lists is None:
                    # Copies, or the whole batch would stay.
                    lists = Lists(k, *[np.frombuffer(x.as_buffer(), t).copy() for x, t in zip(left, ("i4", "f4", "i4", "i4"))])
                    one = part
                if part != one:
                    raise ValueError("a task got more than one part of the left side")
                ids = np.frombuffer(ids.as_buffer(), "i4")
                right = np.frombuffer(features.as_buffer(), "f4").reshape(len(ids), -1)
                lists.add(ids, right, longest.as_py())
        if lists is not None:
            yield from lists.batches()

    return sweep


class Lists:
    """The best right rows of each left row so far: at least ``k`` of them, in any order, by exact ratings."""

    def __init__(self, k: int, ids: np.ndarray, features: np.ndarray, owners: np.ndarray, others: np.ndarray):
        n, width = len(ids), k + max(k, 32)
        self.k, self.ids, self.left = k, ids, features.reshape(n, -1)
        self.owners, self.taken = owners, others
        self.ratings = np.full((n, width), -np.inf)
        self.others = np.zeros((n, width), np.int32)
        self.filled = np.zeros(n, np.int64)
        # k-th rating when a row's list was last cut, and the highest id that has it there.
        self.floor = np.full(n, -np.inf)
        self.last = np.full(n, np.iinfo(np.int32).max, np.int64)
        self.norms = np.linalg.norm(self.left.astype(np.float64), axis=1)
        self.largest = self._largest(self.left)

    @staticmethod
    def _largest(features: np.ndarray) -> float:
        """Largest number of a matrix of whole numbers, infinite for others."""
        return float(np.abs(features).max(initial=0)) if np.array_equal(np.rint(features), features) else np.inf

    def add(self, ids: np.ndarray, right: np.ndarray, longest: float) -> None:
        """Score a block of the right side (by rising id, no vector longer than ``longest``) for all rows it can serve."""
        n, dims = right.shape
        whole = dims * self.largest * self._largest(right) < _EXACT
        # A single-precision product is off by less than this; the chosen are summed again.
        error = 0.0 if whole else 4 * dims * np.finfo(np.float32).eps * longest
        rows = np.flatnonzero(self.norms * longest * (1 + 1e-9) >= self.floor)
        own, column = self._left_out(ids, rows)
        step = min(max(1, _CELLS // n), len(rows))
        # Made once: fresh memory for each product would cost nearly as much as the product.
        space, flags = np.empty((step, n), np.float32), np.zeros(-(-step * n // 8) * 8, bool)
        for start in range(0, len(rows), step or 1):
            part = rows[start : start + step]
            scores = np.matmul(self.left[part], right.T, out=space[: len(part)])
            cut = slice(*np.searchsorted(own, [start, start + step]))
            scores[own[cut] - start, column[cut]] = -np.inf
            cells = self._reached(scores, flags, part, error * self.norms[part])
            row, place = np.divmod(cells, n)
            if whole:
                ratings = scores.ravel()[cells].astype(np.float64)
            else:
                ratings = exact(self.left[part[row]], right[place])
            self._put(part[row], ids[place], ratings)

    def _left_out(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``rows`` and column of the pairs to leave out, by rising place."""
        column, pair = _expanded(np.searchsorted(self.taken, ids), np.searchsorted(self.taken, ids, "right"))
        place = np.full(len(self.ids), -1)
        place[rows] = np.arange(len(rows))
        own = place[self.owners[pair]]
        order = np.argsort(own, kind="stable")
        order = order[own[order] >= 0]
        return own[order], column[order]

    def _reached(self, scores: np.ndarray, flags: np.ndarray, rows: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """Flat places of the scores that may be among a row's ``k`` best."""
        n = scores.shape[1]
        limit = self.floor[rows] - slack
        unbound = np.flatnonzero(np.isneginf(limit))
        if len(unbound) and n > self.k:
            least = np.partition(scores[unbound], n - self.k, axis=1)[:, n - self.k]
            limit[unbound] = least - 2 * slack[unbound]
        # Pairs left out are below every limit.
        limit = np.nextafter(np.maximum(limit, np.finfo(np.float32).min / 2).astype(np.float32), np.float32(-np.inf))
        np.greater_equal(scores, limit[:, None], out=flags[: scores.size].reshape(scores.shape))
        flags[scores.size :] = False
        return _nonzero(flags)

    def _put(self, rows: np.ndarray, others: np.ndarray, ratings: np.ndarray) -> None:
        """Add entries, given by rising row; lists that are full are cut to the ``k`` best."""
        while True:
            floor = self.floor[rows]
            better = (ratings > floor) | ((ratings == floor) & (others < self.last[rows]))
            rows, others, ratings = rows[better], others[better], ratings[better]
            if not len(rows):
                return
            start = np.flatnonzero(np.diff(rows, prepend=-1))
            touched, sizes = rows[start], np.diff(start, append=len(rows))
            place = np.arange(len(rows)) + np.repeat(self.filled[touched] - start, sizes)
            fits = place < self.ratings.shape[1]
            self.ratings[rows[fits], place[fits]] = ratings[fits]
            self.others[rows[fits], place[fits]] = others[fits]
            wanted = self.filled[touched] + sizes
            self.filled[touched] = np.minimum(wanted, self.ratings.shape[1])
            # Full lists, and those that have a bound for the first time.
            unbound = np.isneginf(self.floor[touched]) & (wanted >= self.k)
            self._cut(touched[unbound | (wanted > self.ratings.shape[1])])
            rows, others, ratings = rows[~fits], others[~fits], ratings[~fits]

    def _cut(self, rows: np.ndarray) -> None:
        """Keep the ``k`` best of rows that have as many, equal ratings by rising id."""
        k = self.k
        if not len(rows):
            return
        ratings, others = self.ratings[rows], self.others[rows]
        least = np.partition(ratings, ratings.shape[1] - k, axis=1)[:, -k, None]
        none = np.iinfo(np.int64).max
        order = np.where(ratings > least, np.iinfo(np.int64).min, np.where(ratings == least, others.astype(np.int64), none))
        kept = np.argpartition(order, k - 1, axis=1)[:, :k]
        ratings, others = np.take_along_axis(ratings, kept, 1), np.take_along_axis(others, kept, 1)
        self.ratings[rows, :k], self.ratings[rows, k:] = ratings, -np.inf
        self.others[rows, :k] = others
        self.filled[rows] = k
        self.floor[rows] = least[:, 0]
        self.last[rows] = np.where(ratings == least, others, np.iinfo(np.int32).min).max(axis=1)

    def batches(self) -> Iterable[pa.RecordBatch]:
        """(id, other, rating) of all rows, the lists in falling order, equal ratings by rising id."""
        step = max(1, _CELLS // (4 * self.ratings.shape[1]))
        for start in range(0, len(self.ids), step):
            rows = np.arange(start, min(start + step, len(self.ids)))
            self._cut(rows[self.filled[rows] > self.k])
            ratings, others = self.ratings[rows, : self.k], self.others[rows, : self.k]
            order = np.lexsort((others, -ratings), axis=-1)
            listed = np.arange(self.k) < self.filled[rows, None]
            ends = np.concatenate([[0], np.cumsum(self.filled[rows])]).astype(np.int32)
            ratings, others = (np.take_along_axis(x, order, 1)[listed] for x in (ratings, others))
            columns = [
                pa.array(self.ids[rows]),
                pa.ListArray.from_arrays(ends, pa.array(others)),
                pa.ListArray.from_arrays(ends, pa.array(ratings + 0.0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "other", "rating"])
