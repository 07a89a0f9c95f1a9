"""Lists out of scored rows, and back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.functions.lists import best_first
from tasteline.operators.skew import top_k

def collect_best(scored: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Top ``k`` (track_index, rating) of each user as one list."""
    keys = [*by, "user_index"]
    best = top_k(scored, keys, [F.desc("rating"), F.asc("track_index")], k)
    picked = F.collect_list(F.struct("track_index", "rating"))
    return best.groupBy(*keys).agg(best_first(picked).alias("recommendations"))


def flat_lists(recs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per recommended track, ``pos`` counted from 1.

    The outer form keeps the optimizer from adding a filter on the list's size,
    for which it would build every list twice.
    """
    flat = recs.select(*by, "user_index", F.posexplode_outer("recommendations").alias("_i", "_r"))
    return flat.where(F.col("_i").isNotNull()).select(
        *by,
        "user_index",
        (F.col("_i") + 1).alias("pos"),
        F.col("_r.track_index").alias("track_index"),
        F.col("_r.rating").alias("rating"),
    )
