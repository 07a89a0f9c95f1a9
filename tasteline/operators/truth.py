"""Per-user truth lists, in rising order of play count."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tracks in one array, and neighbouring track codes sorted by one task.
WIDTH = 100_000
_ORDER = ["count", "track_index"]


def truth_positions(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(user_index, pos, track_index): place of each distinct track in its user's list.

    Ordered by count, then track; of several rows of a (user, track) pair the
    greatest count decides. Every user's rows are cut into blocks of one count and
    ``width`` neighbouring track codes: a row's place is its place in the block
    plus the sizes of the blocks before it, so no task sorts the whole list of a
    user with very many rows, and all users go the same way.
    """
    pairs = rows.groupBy("user_index", "track_index").agg(F.max("count").alias("count"))
    block = ["count", "_range"]
    cut = pairs.withColumn("_range", F.floor(F.col("track_index") / width))
    within = Window.partitionBy("user_index", *block).orderBy("track_index")
    sizes = cut.groupBy("user_index", *block).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("user_index").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("user_index", *block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = cut.withColumn("_place", F.row_number().over(within)).join(starts, ["user_index", *block])
    return placed.select("user_index", (F.col("_start") + F.col("_place")).cast("int").alias("pos"), "track_index")


def truth_lists(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(user_index, first, tracks): the list of each user in arrays of at most ``width`` tracks.

    ``first`` is the place of an array's first track, so lists read back right
    whatever the width was. No track occurs twice among the arrays of a user.
    """
    placed = truth_positions(rows, width)
    part = F.floor((F.col("pos") - 1) / width).alias("_part")
    lists = placed.groupBy("user_index", part).agg(
        F.min("pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "track_index"))).alias("_plays")
    )
    return lists.select("user_index", "first", F.col("_plays.track_index").alias("tracks"))


def flat_truth(truth: DataFrame) -> DataFrame:
    """Truth lists back to one row per (user_index, pos, track_index)."""
    return truth.select("user_index", "first", F.posexplode("tracks").alias("_i", "track_index")).select(
        "user_index", (F.col("first") + F.col("_i")).cast("int").alias("pos"), "track_index"
    )
