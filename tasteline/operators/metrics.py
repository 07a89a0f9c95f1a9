"""Scores of recommendation lists against truth lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.functions import ranking


def pair_lists(recs: DataFrame, truth: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., user_index, predicted, tracks) of the users found on both sides.

    ``by`` names further columns of ``recs`` that tell runs apart.
    """
    predicted = recs.select(*by, "user_index", F.col("recommendations.track_index").alias("predicted"))
    return predicted.join(truth.select("user_index", "tracks"), "user_index")


def user_hits(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., user_index, hits, n_truth, n_predicted), one row per user.

    Works array by array, so a user whose truth list comes in several arrays (no
    track in two of them) is put together from hit positions only. The join has already placed the rows
    by user; no further shuffle is needed.
    """
    found = F.array_intersect("predicted", "tracks")
    places = F.transform(found, lambda track: F.array_position("predicted", track).cast("int"))
    return (
        pairs.select(
            *by,
            "user_index",
            places.alias("_places"),
            F.size(F.array_distinct("tracks")).alias("_n_truth"),
            F.size("predicted").alias("_n_predicted"),
        )
        .groupBy(*by, "user_index")
        .agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("_places")))).alias("hits"),
            F.sum("_n_truth").alias("n_truth"),
            F.max("_n_predicted").alias("n_predicted"),
        )
    )


def user_metrics(hits: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """All ranking metrics per user, cut at ``k`` where they have a cut."""
    places, n_truth, n_predicted = F.col("hits"), F.col("n_truth"), F.col("n_predicted")
    return hits.select(
        *by,
        "user_index",
        ranking.precision_at(places, n_truth, k).alias("precision_at_k"),
        ranking.precision_of_list(places, n_truth, n_predicted).alias("precision_list"),
        ranking.recall_at(places, n_truth, k).alias("recall_at_k"),
        ranking.average_precision(places, n_truth).alias("map"),
        ranking.average_precision_at(places, n_truth, k).alias("map_at_k"),
        ranking.ndcg_at(places, n_truth, k).alias("ndcg_at_k"),
    )


METRICS = ("precision_at_k", "precision_list", "recall_at_k", "map", "map_at_k", "ndcg_at_k")


def mean_metrics(
    per_user: DataFrame, by: tuple[str, ...] = (), metrics: tuple[str, ...] = METRICS
) -> DataFrame:
    """Mean over users of each metric, with the number of users."""
    means = [F.avg(m).alias(m) for m in metrics]
    return per_user.groupBy(*by).agg(F.count("*").alias("n_users"), *means)


def ranking_metrics(recs: DataFrame, truth: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    return mean_metrics(user_metrics(user_hits(pair_lists(recs, truth, by), by), k, by), by)


def precision_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    per_user = user_metrics(user_hits(pair_lists(recs, truth)), k)
    return mean_metrics(per_user, metrics=("precision_at_k",))


def precision_list(recs: DataFrame, truth: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    per_user = user_metrics(user_hits(pair_lists(recs, truth, by), by), 1, by)
    return mean_metrics(per_user, by, metrics=("precision_list",))


def ndcg_at(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    return mean_metrics(user_metrics(user_hits(pair_lists(recs, truth)), k), metrics=("ndcg_at_k",))


def rmse(scored: DataFrame, prediction: str, label: str) -> DataFrame:
    error = F.col(prediction).cast("double") - F.col(label)
    return scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("n_rows"))
