"""Keyed restrictions and set operations on interaction frames.

A hot user is split at run time (adaptive skew join) only if both join sides are
plain shuffles. So the user side is never a distinct computed in the same plan:
it is either not made distinct, or written out first. A written table also has a
known size, by which the planner may choose to broadcast it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.session import materialize


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def id_universe(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct ids over several frames; each branch combines before the union."""
    ids = distinct_ids(frames[0], column)
    for df in frames[1:]:
        ids = ids.union(distinct_ids(df, column))
    return ids.distinct()


def restrict_users(rows: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows whose user occurs in ``users``."""
    return rows.join(users.select(key), key, "left_semi")


def rows_of_users(rows: DataFrame, users: DataFrame, columns: list[str], key: str = "user_id") -> DataFrame:
    """The rows an inner join with the distinct users keeps, then a projection."""
    return restrict_users(rows, users, key).select(*columns)


def rows_not_of_users(rows: DataFrame, users: DataFrame, columns: list[str], key: str = "user_id") -> DataFrame:
    """Rows whose user does not occur in ``users``."""
    return rows.join(users.select(key), key, "left_anti").select(*columns)


def rows_except(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Distinct rows that do not occur in ``removed``."""
    return rows.subtract(removed.select(*rows.columns))


def flag_users(rows: DataFrame, users: DataFrame, flag: str, key: str = "user_id") -> DataFrame:
    """All rows, with a boolean telling whether the user occurs in ``users``."""
    marked = materialize(distinct_ids(users, key), "users").withColumn(flag, F.lit(True))
    return rows.join(marked, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
