"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tasteline.llm import (
    contamination,
    fmindex,
    licenses,
    lm,
    maintext,
    merkle,
    mixing,
    neardup,
    periodic,
    quality,
    sharding,
    suffixes,
    warc,
)

SHARDS = 24
SEED = 20240917
WARC_DATE = "2024-01-01T00:00:00Z"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"), SHARDS, SEED)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), quality.OutlierSpec())


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"), mixing.MixSpec())


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fmindex.passage_report(_table(spark, sf_dir, "documents"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_report(_table(spark, sf_dir, "documents"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivative_report(_table(spark, sf_dir, "pages"), WARC_DATE)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), neardup.JoinSpec(words=3, percent=85))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(_table(spark, sf_dir, "documents"), lm.LmSpec())


def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.string_report(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.main_text(_table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_quality_rules,
        op3_source_mix,
        op4_repeated_passages,
        op5_licence_scan,
        op6_warc_derivatives,
        op7_near_duplicates,
        op8_lm_scores,
        op9_repeated_strings,
        op10_decontamination,
        op11_main_text,
        op12_periodic_runs,
        op13_merkle_manifest,
        pipeline,
    )
}
