"""Helpers for keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def heavy_keys(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """Keys with more than ``rows`` rows, or None if there are none.

    The counts combine on the map side. The frame carries a broadcast hint only
    after its size has been checked; a longer one is left to the planner.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("_n"))
    heavy = sizes.where(F.col("_n") > rows).select(key)
    n = heavy.limit(BROADCAST_ROWS + 1).count()
    if n == 0:
        return None
    return F.broadcast(heavy) if n <= BROADCAST_ROWS else heavy


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "pos", salts: int = 64) -> DataFrame:
    """First ``k`` rows of each group, numbered from 1.

    Up to the planner's group-limit threshold a plain ranking window is enough:
    each map task then passes on at most ``k`` rows of a group. Beyond it the
    groups are cut into ``salts`` parts first, so a hot group still never
    reaches one task whole.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        within = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn("_n", F.row_number().over(within)).where(F.col("_n") <= k).drop("_n", "_salt")
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= k)
