"""Parquet tables: interaction splits, encodings, samples, truth lists, metadata."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.functions.keys import fraction_name

# File names of the three interaction splits.
SPLIT_FILES = {
    "train": "cf_train.parquet",
    "validation": "cf_validation.parquet",
    "test": "cf_test.parquet",
}


class Splits(NamedTuple):
    train: DataFrame
    validation: DataFrame
    test: DataFrame

    def stacked(self) -> DataFrame:
        """One frame with a ``split`` column."""
        parts = [df.withColumn("split", F.lit(name)) for name, df in self._asdict().items()]
        return reduce(DataFrame.unionByName, parts)

    @classmethod
    def of(cls, stacked: DataFrame) -> Splits:
        """Cut a frame with a ``split`` column; on a table partitioned by it the
        filter prunes whole folders."""
        return cls(*[stacked.where(F.col("split") == name).drop("split") for name in cls._fields])


def load_splits(spark: SparkSession, path: str, files: Mapping[str, str] = SPLIT_FILES) -> Splits:
    return Splits(**{name: spark.read.parquet(f"{path}/{files[name]}") for name in Splits._fields})


def save(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def save_encoded(splits: Splits, path: str) -> None:
    """All splits in one table, one folder per split."""
    save(splits.stacked(), f"{path}/encoded", partition_by="split")


def load_encoded(spark: SparkSession, path: str) -> Splits:
    return Splits.of(spark.read.parquet(f"{path}/encoded"))


def train_path(path: str, fraction: float) -> str:
    return f"{path}/train_{fraction_name(fraction)}"


def load_train(spark: SparkSession, path: str, fraction: float | None = None) -> DataFrame:
    """Encoded train rows, whole or the saved subsample of that fraction."""
    if fraction is None:
        return load_encoded(spark, path).train
    return spark.read.parquet(train_path(path, fraction))


def save_truth(truth: DataFrame, path: str) -> None:
    save(truth, path)


def load_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("user_index int, first int, tracks array<int>").parquet(path)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the registered tables and views, sorted."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("name")).orderBy("name")


def split_counts(splits: Splits) -> DataFrame:
    return splits.stacked().groupBy("split").agg(F.count("*").alias("n_rows"))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """``n`` rows; the same ones each time if an order is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def load_tracks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_artist_tags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("artist_id", "mbtag")
