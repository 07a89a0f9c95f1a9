"""Play-count triples, track metadata and run logs out of an order/part schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.functions.labels import ALS_LINE
from tasteline.sources.tables import Splits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(prefix: str, key: str) -> Column:
    """Key as text of eight digits at least; longer keys stay whole."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, part) pair with its summed quantity as play count.

    Customers are users, parts are tracks. ``split`` cuts the pairs 8:1:1 and
    keeps the three parts disjoint.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pairs = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("int").alias("count"))
    )
    slot = (F.col("o_custkey") * 31 + F.col("l_partkey")) % 10
    return pairs.select(
        _padded("U", "o_custkey").alias("user_id"),
        "count",
        _padded("T", "l_partkey").alias("track_id"),
        F.when(slot == 8, "validation").when(slot == 9, "test").otherwise("train").alias("split"),
    )


def interaction_splits(spark: SparkSession, sf_dir: str) -> Splits:
    return Splits.of(interactions(spark, sf_dir))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _padded("T", "p_partkey").alias("track_id"), F.col("p_brand").alias("artist_id")
    )


def artist_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("artist_id"), F.col("p_type").alias("mbtag"))
        .distinct()
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given (not fitted) vectors in the layout of a factor table."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )


def whole_factors(spark: SparkSession, sf_dir: str, ids: DataFrame) -> DataFrame:
    """A vector for each of ``ids`` (id), the given ones in turn, as small whole numbers.

    Sums of their products are exact in single precision, so equal scores are
    equal in every order of summation.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = vectors.count()
    scaled = F.transform("embedding", lambda x: F.round(x.cast("double") * 64).cast("float")).alias("features")
    return ids.join(vectors, F.col("id") % n == F.col("vec_id")).select("id", scaled)


def run_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(log, value): one run line per order line, and per order one line of
    another kind and one blank line that a reader has to skip."""
    lines = table(spark, sf_dir, "lineitem")
    log = (
        F.when(F.col("l_returnflag") == "A", "stats_0_25")
        .when(F.col("l_returnflag") == "N", "stats_1_0")
        .otherwise("stats_lenskit_0_01")
    )
    runs = lines.select(
        log.alias("log"),
        F.format_string(
            ALS_LINE,
            (F.col("l_quantity") * 10).cast("int"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(10),
            F.when(F.col("l_tax") < 0.05, 1).otherwise(80),
            F.when(F.col("l_linenumber") <= 4, 5).otherwise(10),
            F.col("l_discount"),
            F.col("l_extendedprice"),
            F.col("l_tax"),
            F.col("l_quantity"),
            F.col("l_suppkey"),
        ).alias("value"),
    )
    other = table(spark, sf_dir, "orders").select(
        F.lit("stats_0_25").alias("log"),
        F.explode(F.array(F.concat(F.lit("launcher -f kernel-"), F.col("o_orderkey").cast("string"), F.lit(".json")),
                          F.lit(""))).alias("value"),
    )
    return runs.unionByName(other)
