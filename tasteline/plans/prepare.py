"""From raw splits to the tables every later step reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tasteline.operators.encode import encode, fit_track_codes, fit_user_codes
from tasteline.operators.joins import distinct_ids
from tasteline.operators.sampling import DEFAULT_SEED, subsample_users
from tasteline.operators.truth import truth_lists
from tasteline.sources.tables import (
    Splits,
    load_encoded,
    save,
    save_truth,
    train_path,
)


def prepare(splits: Splits, path: str, unseen: str = "error") -> None:
    """Write encodings, encoded splits, evaluation users and truth lists.

    Users are coded from the train split, tracks from all three. A validation or
    test user without train rows fails the job, or with ``unseen="drop"`` its rows
    are left out of the encoded splits. All splits are encoded in one pass.
    """
    spark = splits.train.sparkSession
    save(fit_user_codes(splits.train), f"{path}/user_encoding.parquet")
    save(fit_track_codes(splits), f"{path}/track_encoding.parquet")
    users = user_encoding(spark, path)
    tracks = track_encoding(spark, path)
    save(encode(splits.stacked(), users, tracks, unseen), f"{path}/encoded", partition_by="split")
    encoded = load_encoded(spark, path)
    for name in ("validation", "test"):
        rows = getattr(encoded, name)
        save(distinct_ids(rows, "user_index"), f"{path}/users_{name}.parquet")
        save_truth(truth_lists(rows), f"{path}/truth_{name}.parquet")


def subsample(spark: SparkSession, path: str, fraction: float, seed: int = DEFAULT_SEED) -> None:
    """Write the user-level train subsample of that fraction."""
    encoded = load_encoded(spark, path)
    save(subsample_users(encoded.train, encoded.validation, fraction, seed), train_path(path, fraction))


def user_encoding(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/user_encoding.parquet")


def track_encoding(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/track_encoding.parquet")


def eval_users(spark: SparkSession, path: str, split: str = "validation") -> DataFrame:
    return spark.read.parquet(f"{path}/users_{split}.parquet")
