"""Damped-bias and popularity baselines."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.operators.shared import HEADROOM, recommend_shared, shared_hits
from tasteline.session import materialize


class BiasPoint(NamedTuple):
    """One parameter point; the points of a model are numbered from 0."""

    items: bool = True
    users: bool = False
    damping: float = 5.0


@dataclass(frozen=True)
class BiasModel:
    """Terms of one or more points, told apart by ``run_no``."""

    points: tuple[BiasPoint, ...]
    mean: DataFrame
    items: DataFrame
    users: DataFrame | None

    @property
    def runs(self) -> list[int]:
        return list(range(len(self.points)))

    def mu(self) -> Column:
        return self.mean.scalar()


def point_rows(points: tuple[BiasPoint, ...]) -> Column:
    """The parameter points as an array of structs, for ``inline``."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("run_no"),
                F.lit(bool(p.items)).alias("items"),
                F.lit(bool(p.users)).alias("users"),
                F.lit(float(p.damping)).alias("damping"),
            )
            for i, p in enumerate(points)
        ]
    )


def fit_bias(train: DataFrame, *points: BiasPoint) -> BiasModel:
    """Fit all points from the same per-track sums.

    mu is the mean count, an item's term (sum - n * mu) / (n + damping), a
    user's term the same on what mu and the items leave over. Sums of counts are
    whole numbers, so item terms do not depend on the order of the rows. The
    terms are written out: they are read several times, their size is then known
    to the planner, and a track with very many rows can be split in a join.
    """
    points = points or (BiasPoint(),)
    mean = train.agg((F.sum("count") / F.count("*")).alias("mu"))
    sums = train.groupBy("track_index").agg(F.sum("count").alias("_sum"), F.count("*").alias("_n"))
    surplus = (F.col("_sum") - F.col("_n") * F.col("_mu")) / (F.col("_n") + F.col("damping"))
    items = (
        sums.withColumn("_mu", mean.scalar())
        .select("track_index", "_sum", "_n", "_mu", F.inline(point_rows(points)))
        .select(
            "run_no",
            "track_index",
            F.when(F.col("items"), surplus).otherwise(F.lit(0.0)).alias("item_bias"),
        )
    )
    items = materialize(items, "bias-items")
    users = None
    if any(p.users for p in points):
        with_users = [i for i, p in enumerate(points) if p.users]
        terms = items.where(F.col("run_no").isin(with_users))
        damping = F.element_at(F.lit([float(p.damping) for p in points]), F.col("run_no") + 1)
        rest = F.col("_sum") - F.col("_n") * F.col("_mu") - F.col("_items")
        users = (
            train.select("user_index", "track_index", "count")
            .join(terms, "track_index")
            .groupBy("run_no", "user_index")
            .agg(F.sum("count").alias("_sum"), F.count("*").alias("_n"), F.sum("item_bias").alias("_items"))
            .withColumn("_mu", mean.scalar())
            .select("run_no", "user_index", (rest / (F.col("_n") + damping)).alias("user_bias"))
        )
        users = materialize(users, "bias-users")
    return BiasModel(points, mean, items, users)


def predict_bias(model: BiasModel, pairs: DataFrame, run_no: int = 0) -> DataFrame:
    """Add ``prediction`` to (user_index, track_index) pairs; missing terms are 0."""
    items = model.items.where(F.col("run_no") == run_no).drop("run_no")
    scored = pairs.join(items, "track_index", "left")
    user_term = F.lit(0.0)
    if model.users is not None:
        users = model.users.where(F.col("run_no") == run_no).drop("run_no")
        scored = scored.join(users, "user_index", "left")
        user_term = F.coalesce("user_bias", F.lit(0.0))
    prediction = model.mu() + F.coalesce("item_bias", F.lit(0.0)) + user_term
    return scored.select(*pairs.columns, prediction.alias("prediction"))


def recommend_bias(
    model: BiasModel,
    users: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    headroom: int = HEADROOM,
) -> DataFrame:
    """(run_no, user_index, recommendations), ties by rising track.

    mu and the user's term shift all scores of a user alike, so the order is
    that of the item terms.
    """
    scores = model.items.withColumnRenamed("item_bias", "rating")
    recs = recommend_shared(scores, users, k, model.runs, seen, headroom)
    base = F.col("_mu")
    recs = recs.withColumn("_mu", model.mu())
    if model.users is not None:
        recs = recs.join(model.users, ["run_no", "user_index"], "left")
        base = base + F.coalesce("user_bias", F.lit(0.0))
    shifted = F.transform(
        "recommendations",
        lambda r: F.struct(r["track_index"].alias("track_index"), (base + r["rating"]).alias("rating")),
    )
    return recs.select("run_no", "user_index", shifted.alias("recommendations"))


def bias_hits(
    model: BiasModel,
    users: DataFrame,
    truth: DataFrame,
    k: int,
    seen: DataFrame,
    headroom: int = HEADROOM,
) -> DataFrame:
    """Hits of the lists of ``recommend_bias`` without seen tracks, per run and user."""
    scores = model.items.withColumnRenamed("item_bias", "rating")
    return shared_hits(scores, users, truth, k, model.runs, seen, headroom)


def popularity(train: DataFrame) -> DataFrame:
    """(track_index, n_users, n_plays)."""
    return train.groupBy("track_index").agg(F.count("*").alias("n_users"), F.sum("count").alias("n_plays"))


def recommend_popular(
    train: DataFrame,
    users: DataFrame,
    k: int,
    by: str = "n_plays",
    exclude_seen: bool = False,
    headroom: int = HEADROOM,
) -> DataFrame:
    """(user_index, recommendations): the most popular tracks, ties by rising track."""
    # exploded, not a constant: the run stays a join key.
    scores = popularity(train).select(
        F.explode(F.lit([0])).alias("run_no"), "track_index", F.col(by).cast("double").alias("rating")
    )
    seen = train if exclude_seen else None
    return recommend_shared(scores, users, k, [0], seen, headroom).drop("run_no")
