"""Subsamples that depend on keys only, never on the partition layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.functions.keys import hash_bucket, in_fraction
from tasteline.operators.joins import flag_users

DEFAULT_SEED = 233
MIN_EVAL_FRACTION = 0.05


def subsample_users(train: DataFrame, validation: DataFrame, fraction: float, seed: int = DEFAULT_SEED) -> DataFrame:
    """Train rows of a fraction of the users and of every validation user.

    Whether a user is drawn follows from the id, so one pass with one join does:
    no list of drawn users has to be built and joined back.
    """
    flagged = flag_users(train, validation, "_keep")
    return flagged.where(F.col("_keep") | in_fraction(fraction, "user_id", seed=seed)).drop("_keep")


def subsample_rows(
    train: DataFrame,
    validation: DataFrame,
    fraction: float,
    seed: int = DEFAULT_SEED,
    dedup: bool = False,
) -> DataFrame:
    """Every row of the validation users and a fraction of the other rows.

    ``dedup`` collapses equal rows of the other users first. Equal rows of a bag
    share their hash, so they are drawn or left together.
    """
    columns = ["user_id", "count", "track_id"]
    flagged = flag_users(train.select(*columns), validation, "_keep").select(*columns, "_keep")
    drawn = in_fraction(fraction, "user_id", "track_id", "count", seed=seed)
    if not dedup:
        return flagged.where(F.col("_keep") | drawn).select(*columns)
    kept = flagged.where("_keep").select(*columns)
    others = flagged.where(~F.col("_keep") & drawn).select(*columns).distinct()
    return others.union(kept)


def subsample_eval_users(
    users: DataFrame, fraction: float, seed: int = DEFAULT_SEED, key: str = "user_index"
) -> DataFrame:
    """Evaluation users, never a smaller part than 5 %."""
    return users.where(in_fraction(max(fraction, MIN_EVAL_FRACTION), key, seed=seed))


def sample_n(df: DataFrame, n: int, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer), drawn by the hash of the key."""
    return df.orderBy(hash_bucket(key, seed=seed), key).limit(n)
