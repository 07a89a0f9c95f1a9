"""Implicit-feedback factor models: fit, top-k lists, pair scores, factors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.operators.blocks import BLOCK_ROWS, top_matches
from tasteline.operators.numbering import number_rows
from tasteline.session import materialize, shared_root

# (user blocks, item blocks) of a fit. They seed the start factors, so a model is
# a function of them; about four million ratings a block fit one task.
BLOCKS = (10, 10)


class AlsParams(NamedTuple):
    rank: int = 10
    reg: float = 1.0
    alpha: float = 1.0
    max_iter: int = 5


def fit_als(
    train: DataFrame,
    params: AlsParams = AlsParams(),
    blocks: tuple[int, int] = BLOCKS,
    seed: int = 42,
) -> ALSModel:
    """Fit on distinct (user_index, track_index, count) rows.

    One row per pair bounds the ratings of one user by the catalogue, however
    many plays the user has; the ratings of one track stay in one item block.
    ``blocks`` is (user blocks, item blocks), to be set for the data at hand: the
    same blocks and seed give the same model, whatever the size of the data.
    """
    shared_root(train.sparkSession)
    als = ALS(
        userCol="user_index",
        itemCol="track_index",
        ratingCol="count",
        implicitPrefs=True,
        coldStartStrategy="drop",
        rank=params.rank,
        regParam=params.reg,
        alpha=params.alpha,
        maxIter=params.max_iter,
        numUserBlocks=blocks[0],
        numItemBlocks=blocks[1],
        seed=seed,
    )
    return als.fit(train.select("user_index", "track_index", "count"))


class FactorTables(NamedTuple):
    """(id, features) tables of both sides, by the ids of the ratings."""

    users: DataFrame
    items: DataFrame


def spread_codes(train: DataFrame, column: str) -> DataFrame:
    """(column, code): dense codes by falling number of rows.

    A fit puts an id into the block that its rest of division names, so ids that
    follow each other in this order go to different blocks, and the blocks' rows
    differ by no more than those of the most frequent id.
    """
    degrees = train.groupBy(column).agg(F.count("*").alias("_n"))
    order = [F.col("_n").desc(), F.col(column).asc()]
    return number_rows(degrees, order, "spread-codes", "code").select(column, F.col("code").cast("int").alias("code"))


def fit_spread(
    train: DataFrame, params: AlsParams = AlsParams(), blocks: tuple[int, int] = BLOCKS, seed: int = 42
) -> FactorTables:
    """``fit_als`` on relabelled ids, which spread frequent users and tracks over the blocks; factors by the old ids.

    The start factors follow from block and place, so the model is not the one
    that the old ids give, but as good a one.
    """
    users = materialize(spread_codes(train, "user_index"), "spread-users")
    items = materialize(spread_codes(train, "track_index"), "spread-items")
    coded = train.join(users.withColumnRenamed("code", "_user"), "user_index")
    coded = coded.join(items.withColumnRenamed("code", "_item"), "track_index")
    coded = coded.select(F.col("_user").alias("user_index"), F.col("_item").alias("track_index"), "count")
    model = fit_als(coded, params, blocks, seed)

    def named(factors: DataFrame, codes: DataFrame, column: str) -> DataFrame:
        back = factors.join(codes, factors["id"] == codes["code"])
        return back.select(F.col(column).alias("id"), "features")

    return FactorTables(named(model.userFactors, users, "user_index"), named(model.itemFactors, items, "track_index"))


# Rows of one user whose normal equations one task sums at a time.
FOLD_ROWS = 10_000


def _outer_sum(features: pa.ChunkedArray, weights: np.ndarray) -> np.ndarray:
    matrix = features.combine_chunks().flatten().to_numpy().reshape(len(features), -1).astype(np.float64)
    return (matrix * weights[:, None]).T @ matrix


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the outer products of the vectors of a partition, as one row."""
    total = 0
    for batch in batches:
        if batch.num_rows:
            total = total + _outer_sum(pa.chunked_array([batch.column("features")]), np.ones(batch.num_rows))
    if not np.isscalar(total):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gram"])


def fold_in(
    plays: DataFrame, items: DataFrame, params: AlsParams, fold_rows: int = FOLD_ROWS
) -> DataFrame:
    """(id, features) of the users of ``plays`` (user_index, track_index, count), with the track factors held fixed.

    One step of the fit for these users alone, also for such as it never saw: each
    solves its own normal equations, the sum of a part common to all (the products
    of the track factors) and one of the user's tracks. A user's rows are summed in
    groups of about ``fold_rows``, which are added before they are solved, so no
    task needs all rows of a user with very many. Tracks without factors are left
    out; users without any other drop out. Equal rows count each.
    """
    # One square of the rank per partition comes to the driver.
    grams = [np.frombuffer(r["gram"]) for r in items.select("features").mapInArrow(_gram_batches, "gram binary").collect()]
    gram = np.sum(grams, axis=0)
    rank = int(len(gram) ** 0.5) if grams else 0
    gram = gram.reshape(rank, rank) if rank else np.zeros((0, 0))
    alpha, reg = params.alpha, params.reg
    kind = "user_index int, products binary, sums binary, n long"

    def summed(table: pa.Table) -> pa.Table:
        count = table.column("count").to_numpy().astype(np.float64)
        c, liked = alpha * np.abs(count), count > 0
        vectors = table.column("features").combine_chunks().flatten().to_numpy().reshape(len(count), -1).astype(np.float64)
        products = (vectors * c[:, None]).T @ vectors
        sums = vectors.T @ np.where(liked, 1 + c, 0.0)
        user = table.column("user_index").slice(0, 1)
        return pa.table([user, pa.array([products.tobytes()], pa.binary()), pa.array([sums.tobytes()], pa.binary()),
                         pa.array([int(liked.sum())])], names=["user_index", "products", "sums", "n"])

    def solved(table: pa.Table) -> pa.Table:
        products = np.sum([np.frombuffer(x.as_buffer()) for x in table.column("products")], axis=0).reshape(rank, rank)
        sums = np.sum([np.frombuffer(x.as_buffer()) for x in table.column("sums")], axis=0)
        n = sum(table.column("n").to_pylist())
        matrix = gram + products + reg * n * np.eye(rank)
        x = np.linalg.lstsq(matrix, sums, rcond=None)[0].astype(np.float32)
        return pa.table([table.column("user_index").slice(0, 1), pa.array([x], pa.list_(pa.float32()))], names=["id", "features"])

    wide = plays.select("user_index", F.col("track_index").alias("id"), F.col("count").cast("double").alias("count")).join(items, "id")
    sizes = materialize(plays.groupBy("user_index").agg(F.ceil(F.count("*") / fold_rows).alias("_parts")), "fold-sizes")
    dealt = wide.join(sizes, "user_index").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))
    parts = dealt.groupBy("user_index", "_part").applyInArrow(summed, kind)
    return parts.groupBy("user_index").applyInArrow(solved, "id int, features array<float>")


def recommend(
    model: ALSModel,
    users: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(user_index, recommendations): top ``k`` tracks, without those in ``seen``.

    Same lists as the model's own method for a subset of users, which does not
    leave out seen tracks; equal ratings come by rising track. Users without
    factors drop out.
    """
    return recommend_by(user_factors(model), item_factors(model), users, k, seen, block_rows)


def recommend_by(
    user_vectors: DataFrame,
    track_vectors: DataFrame,
    users: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``recommend`` for any two (id, features) tables."""
    wanted = users.select(F.col("user_index").alias("id"))
    rows = user_vectors.join(wanted, "id", "left_semi")
    taken = None
    if seen is not None:
        taken = seen.select(F.col("user_index").alias("id"), F.col("track_index").alias("other"))
        taken = taken.join(wanted, "id", "left_semi")
    best = top_matches(rows, track_vectors, k, taken, block_rows)
    return best.select(
        F.col("id").alias("user_index"),
        F.col("matches").cast("array<struct<track_index:int,rating:float>>").alias("recommendations"),
    )


def recommend_items(model: ALSModel, tracks: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(track_index, recommendations): top ``k`` users of each track."""
    return recommend_items_by(user_factors(model), item_factors(model), tracks, k, block_rows)


def recommend_items_by(
    user_vectors: DataFrame, track_vectors: DataFrame, tracks: DataFrame, k: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``recommend_items`` for any two (id, features) tables."""
    wanted = tracks.select(F.col("track_index").alias("id"))
    rows = track_vectors.join(wanted, "id", "left_semi")
    best = top_matches(rows, user_vectors, k, block_rows=block_rows)
    return best.select(
        F.col("id").alias("track_index"),
        F.col("matches").cast("array<struct<user_index:int,rating:float>>").alias("recommendations"),
    )


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction`` to (user_index, track_index) pairs; unknown ids drop out."""
    return model.transform(pairs)


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors


def item_factors(model: ALSModel) -> DataFrame:
    return model.itemFactors


def dot(left: str, right: str) -> Column:
    """Scalar product of two float arrays of the same length, in double."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def score_factors(pairs: DataFrame, users: DataFrame, tracks: DataFrame) -> DataFrame:
    """Add ``prediction`` to pairs from two given (id, features) tables."""
    left = users.select(F.col("id").alias("user_index"), F.col("features").alias("_u"))
    right = tracks.select(F.col("id").alias("track_index"), F.col("features").alias("_t"))
    scored = pairs.join(left, "user_index").join(right, "track_index")
    return scored.select(*pairs.columns, dot("_u", "_t").alias("prediction"))
