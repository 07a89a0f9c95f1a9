"""Top-k matches between two factor tables, block by block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.operators.numbering import number_rows
from tasteline.operators.sweep import LIST_CELLS, PAIRS, exact, matrix, swept
from tasteline.session import discard, materialize

# Rows of either side in a block, and pairs to leave out in a pair of blocks.
BLOCK_ROWS = 16_384
BLOCK_PAIRS = 4_000_000
_MIN_ROWS = 256
_CELLS = 2_000_000


def top_matches(
    left: DataFrame,
    right: DataFrame,
    k: int,
    taken: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, matches): for each ``left`` row the ``k`` best ``right`` rows by scalar product.

    ``left`` and ``right`` are (id, features) tables, ``matches`` an array of
    (id, rating) in falling order, equal ratings by rising id. Pairs in
    ``taken`` (id, other) are left out, and the next best ones move up.

    Left rows that are enough for all cores are dealt into parts, and a task for each
    sweeps the whole right side (``sweep``), so a list is made in one place and moves
    no more. Fewer left rows share the right side out as well, as follows.

    The right side is cut into blocks of ``block_rows`` rows by falling length of
    the vectors, and worked off in waves of ever more blocks. After a wave a row's
    k-th rating is a bound: a block whose longest vector, times the row's own, is
    below it is not scored for that row, and no lesser rating leaves a task. So
    about k entries a row and wave move, whatever the number of blocks. A pair of
    a left and a right block is one group: a matrix product and a partial top-k.
    Taken pairs are cut by both blocks too, so a row with very many of them is
    spread like everything else. Ratings are summed in double, dimension after
    dimension, so they and the order don't depend on the blocks. Null features
    fail the job.
    """
    blocks = max(1, -(-right.count() // block_rows))
    if blocks == 1:
        whole = right.select("id", "features", F.lit(0).cast("long").alias("_block"))
        cut = None if taken is None else taken.select("id", "other", F.lit(0).cast("long").alias("_block"))
        return _partial(left.withColumn("_bound", _no_bound()), whole, cut, (0, 1), [None], k, block_rows)
    longest = [F.col("_norm").desc(), F.col("id")]
    right = number_rows(right.withColumn("_norm", _norm("features")), longest, "topk-right", "_place")
    left = materialize(left, "topk-left")
    tasks, n_left = _wanted_tasks(left), left.count()
    if n_left >= tasks * _MIN_ROWS:
        n_taken = 0 if taken is None else taken.count()
        rows = max(1, min(BLOCK_ROWS, LIST_CELLS // k))
        parts = max(-(-n_left // rows), -(-n_taken // PAIRS), tasks)
        right = right.withColumn("_block", F.floor(F.col("_place") / BLOCK_ROWS))
        return _listed(swept(left, right, k, taken, parts))
    right = right.withColumn("_block", F.floor(F.col("_place") / block_rows))
    # One number per block of right rows.
    norms = [r["m"] for r in right.groupBy("_block").agg(F.max("_norm").alias("m")).orderBy("_block").collect()]
    if taken is not None:
        place = right.select(F.col("id").alias("other"), "_block")
        taken = materialize(taken.select("id", "other").join(place, "other").select("id", "other", "_block"), "topk-taken")
    lists, first, last = None, 0, 1
    while True:
        rows = left.withColumn("_bound", _no_bound()) if lists is None else left.join(lists.select("id", "_bound"), "id", "left")
        found = _partial(rows, right, taken, (first, last), norms, k, block_rows)
        lists = _merged(found, lists, k)
        if last == blocks:
            return lists.select("id", "matches")
        before, lists = rows, materialize(lists, "topk-lists")
        discard(before, "topk-lists")
        first, last = last, min(blocks, last * _GROWTH)


# Blocks that are done after a wave, as a multiple of those before it.
_GROWTH = 4


def _wanted_tasks(df: DataFrame) -> int:
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def _no_bound() -> Column:
    return F.lit(None).cast("double")


def _norm(features: str) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _merged(found: DataFrame, lists: DataFrame | None, k: int) -> DataFrame:
    """(id, matches, _bound): the k best of a row's lists, and its k-th rating (null while there are fewer)."""
    if lists is not None:
        found = found.unionByName(lists.select("id", "matches"))
    merged = F.sort_array(F.transform(F.flatten(F.collect_list("matches")), lambda m: F.struct(-m["rating"], m["id"])))
    joined = found.groupBy("id").agg(F.slice(merged, 1, k).alias("_m"))
    back = F.transform("_m", lambda m: F.struct(m["id"].alias("id"), (-m["col1"]).alias("rating")))
    out = joined.select("id", back.alias("matches"))
    return out.withColumn("_bound", F.get("matches", F.lit(k - 1))["rating"])


def _partial(
    rows: DataFrame,
    right: DataFrame,
    taken: DataFrame | None,
    wave: tuple[int, int],
    norms: list[float | None],
    k: int,
    block_rows: int,
) -> DataFrame:
    """(id, matches) of each row and each block of a wave that can hold one of its k best."""
    first, last = wave
    n_rows = rows.count()
    n_taken = 0 if taken is None else taken.where(F.col("_block").between(first, last - 1)).count()
    left_blocks = max(
        -(-n_rows // block_rows),
        -(-n_taken // (BLOCK_PAIRS * (last - first))),
        min(-(-_wanted_tasks(rows) // (last - first)), n_rows // _MIN_ROWS),
        1,
    )
    left_block = F.pmod(F.hash("id"), F.lit(left_blocks))

    def numbered(left: Column, block: Column) -> Column:
        return (left * (last - first) + block - first).cast("int").alias("_block")

    no_ids, no_features = F.lit(None).cast("array<int>"), F.lit(None).cast("array<float>")
    until = F.lit(last)
    if first:
        # Lengths fall from block to block, so what can't be reached is the tail.
        own = _norm("features") * (1 + 1e-9)
        reach = F.size(F.filter(F.lit(norms[first:last]), lambda m: m * own >= F.col("_bound")))
        until = F.when(F.col("_bound").isNull(), F.lit(last)).otherwise(first + reach)
    each = F.when(until > first, F.sequence(F.lit(first), until - 1))
    dealt = rows.select("id", "features", "_bound", F.explode(each).alias("_b")).select(
        numbered(left_block, F.col("_b")), "id", "features", "_bound", no_ids.alias("_taken")
    )
    if taken is not None:
        cut = (
            taken.where(F.col("_block").between(first, last - 1))
            .groupBy("id", "_block")
            .agg(F.collect_set("other").alias("_taken"))
            .select(
                numbered(left_block, F.col("_block")),
                "id",
                no_features.alias("features"),
                _no_bound().alias("_bound"),
                "_taken",
            )
        )
        dealt = dealt.unionByName(cut)
    others = right.where(F.col("_block").between(first, last - 1))
    others = others.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(left_blocks - 1)))).select(
        numbered(F.col("_l"), F.col("_block")), F.col("id").alias("other"), "features"
    )
    # The groups are heavy to work on but small in bytes; one task for each block
    # keeps them from being merged by size or meeting in one partition by hash.
    tasks, block = left_blocks * (last - first), F.col("_block")
    best = (
        dealt.repartitionById(tasks, block)
        .groupBy("_block")
        .cogroup(others.repartitionById(tasks, block).groupBy("_block"))
        .applyInArrow(_rank_block(k), "id int, other array<int>, rating array<double>")
    )
    return _listed(best)


def _listed(best: DataFrame) -> DataFrame:
    matches = F.arrays_zip(F.col("other").alias("id"), F.col("rating")).cast("array<struct<id:int,rating:double>>")
    return best.select("id", matches.alias("matches"))


def _rank_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("id", pa.int32()), ("other", pa.list_(pa.int32())), ("rating", pa.list_(pa.float64()))])

    def rank(rows: pa.Table, others: pa.Table) -> pa.Table:
        scored = rows.filter(rows.column("_taken").is_null())
        if not scored.num_rows or not others.num_rows:
            return schema.empty_table()
        cut = rows.filter(rows.column("_taken").is_valid())
        others = others.sort_by("other")
        ids = others.column("other").to_numpy().astype(np.int32)
        right = matrix(others.column("features"))
        left_ids = scored.column("id").to_numpy().astype(np.int32)
        order = np.argsort(left_ids)
        left_ids, left = left_ids[order], matrix(scored.column("features"))[order]
        bound = scored.column("_bound").to_numpy().astype(np.float64)[order]
        bound[np.isnan(bound)] = -np.inf
        row, place = _places(left_ids, ids, cut)
        # A single-precision product is off by less than this; the chosen are summed again.
        error = 4 * right.shape[1] * np.finfo(np.float32).eps * np.linalg.norm(right, axis=1).max()
        slack = error * np.linalg.norm(left, axis=1)
        n, keep = len(ids), min(k, len(ids))
        step, pieces = max(1, _CELLS // n), []
        for start in range(0, len(left), step):
            part = left[start : start + step]
            scores = part @ right.T
            own = slice(*np.searchsorted(row, [start, start + step]))
            scores[row[own] - start, place[own]] = -np.inf
            floor = bound[start : start + step]
            least = np.maximum(np.partition(scores, n - keep, axis=1)[:, n - keep], floor)
            near = np.nonzero((scores >= (least - slack[start : start + step])[:, None]) & (scores > -np.inf))
            ratings = exact(part[near[0]], right[near[1]])
            near, ratings = tuple(x[ratings >= floor[near[0]]] for x in near), ratings[ratings >= floor[near[0]]]
            by = np.lexsort((near[1], -ratings, near[0]))
            at = near[0][by]
            first = np.arange(len(at)) - np.searchsorted(at, at) < keep
            ends = pa.array(np.searchsorted(at[first], np.arange(len(part) + 1)).astype(np.int32))
            columns = [
                pa.array(left_ids[start : start + step]),
                pa.ListArray.from_arrays(ends, pa.array(ids[near[1][by][first]])),
                pa.ListArray.from_arrays(ends, pa.array(ratings[by][first] + 0.0)),
            ]
            pieces.append(pa.table(columns, schema=schema))
        # Left in pieces, so the lists of a block are held once and leave the task batch by batch.
        return pa.concat_tables(pieces)

    return rank


def _places(left_ids: np.ndarray, ids: np.ndarray, cut: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every pair to leave out, by row."""
    if not cut.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists = cut.column("_taken").combine_chunks()
    owner = np.repeat(cut.column("id").to_numpy(), np.diff(lists.offsets.to_numpy()))
    other = lists.flatten().to_numpy()
    row = np.minimum(np.searchsorted(left_ids, owner), len(left_ids) - 1)
    place = np.minimum(np.searchsorted(ids, other), len(ids) - 1)
    known = (left_ids[row] == owner) & (ids[place] == other)
    order = np.argsort(row[known], kind="stable")
    return row[known][order], place[known][order]
