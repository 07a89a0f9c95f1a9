"""The pipeline end to end: encode, fit, recommend, score per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.operators.als import AlsParams, fit_als, recommend
from tasteline.operators.metrics import pair_lists, user_hits, user_metrics
from tasteline.plans.catalog import TOP, workspace
from tasteline.plans.prepare import eval_users
from tasteline.sources.tables import load_encoded, load_truth


def user_scores(spark: SparkSession, sf_dir: str, k: int = TOP) -> DataFrame:
    """(user_index, n_hits, metrics...) of a factor model for every validation user."""
    path = workspace(spark, sf_dir)
    model = fit_als(load_encoded(spark, path).train, AlsParams())
    recs = recommend(model, eval_users(spark, path), k)
    hits = user_hits(pair_lists(recs, load_truth(spark, f"{path}/truth_validation.parquet")))
    counts = hits.select("user_index", F.size("hits").alias("n_hits"))
    return user_metrics(hits, k).join(counts, "user_index")
