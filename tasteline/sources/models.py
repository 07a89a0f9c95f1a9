"""Saved factor models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import SparkSession


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    """True if a complete model folder lies at ``path``."""
    try:
        for part in ("userFactors", "itemFactors"):
            spark.read.parquet(f"{path}/{part}")
    except AnalysisException:
        return False
    return True


def load_or_fit(spark: SparkSession, path: str, fit: Callable[[], ALSModel]) -> ALSModel:
    """The saved model, or a newly fitted one that is saved first.

    Only a missing model leads to a fit; any other read error is raised.
    """
    if not model_exists(spark, path):
        save_model(fit(), path)
    return load_model(path)
