"""From raw documents to a shuffled, sharded training mix.

Each stage reads what the one before has written. Near-duplicate removal goes by
text, so of rows that share a doc_id each different text has its own group. Rows
without doc_id have no group and stay. Nulls, empty texts and empty tables are handled as each
operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.llm import contamination, mixing, neardup, quality, sharding
from tasteline.session import materialize

SHARDS = 24
SEED = 20240917

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are outliers of their language and source."""
    packed = docs.select(F.struct("*").alias("document"), "text", "lang", "source")
    judged = quality.judge(quality.text_stats(packed).drop("text"), quality.OutlierSpec())
    return judged.where("kept").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a similarity of 0.8."""
    return neardup.one_of_each(docs, neardup.JoinSpec(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth of the words lies in benchmark passages."""
    return contamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until the sources have their target shares."""
    packed = docs.select(F.struct("*").alias("document"), "doc_id", "text", "source")
    mixed = mixing.mix(packed, mixing.MixSpec(), keep=["document"])
    return mixing.repeated(mixed, ["document"]).select("document.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give every row its shard and slot."""
    return sharding.shard_rows(docs, SHARDS, SEED, ["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("shards", shards),
]

# Robust estimates, similarity components and keyed permutations have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
