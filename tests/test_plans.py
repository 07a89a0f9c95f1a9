"""What the plans look like: pruning, no cross products, skewed joins, shared scratch."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tasteline.operators import bias, encode, joins, runs, sampling, truth
from tasteline.plans import catalog
from tasteline.session import shared_root
from tasteline.sources import starschema


@contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "interactions",
    "encoded_val",
    "truth_val",
    "rows_of_users",
    "subsample_users",
    "subsample_rows",
    "bias_items",
    "bias_users_items",
    "bias_topk_unseen",
    "bias_tune",
    "ranking_metrics",
    "tag_embedding",
    "series_time",
    "als_topk_unseen",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_product(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["truth_val", "bias_topk_unseen", "series_time", "user_codes"])
def test_no_whole_table_in_one_task(spark, sf_dir, name):
    """Windows over data are partitioned; single-partition steps hold aggregates only."""
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    for line in text.splitlines():
        if "Window [" in line and "windowspecdefinition" in line:
            assert re.search(r"windowspecdefinition\((?!_part)", line) or "_part" in line


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(starschema.interactions(spark, sf_dir))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    text = plan(catalog.QUERIES["popularity_counts"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(split" in text and "ReadSchema: struct<count:int,track_index:int>" in text


def test_one_scan_of_train_for_a_sample(spark, sf_dir):
    raw = catalog._raw(spark, sf_dir)
    text = plan(sampling.subsample_users(raw.train, raw.validation, 0.25))
    assert len(re.findall("FileScan", text)) == 2


def hot_rows(spark):
    """User u0 holds a third of the rows."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "u0").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user_id"),
        F.col("id").cast("int").alias("count"),
        F.lpad(F.col("id").cast("string"), 40, "t").alias("track_id"),
    )


@pytest.mark.parametrize("kind", ["codes", "semi", "anti", "sample", "bias"])
def test_hot_user_is_split_in_joins(spark, kind):
    rows = hot_rows(spark)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="10KB",
    ):
        if kind == "codes":
            codes = encode.fit_codes(rows, "user_id", "user_index")
            df = encode.attach_codes(rows, codes, "user_id", "user_index")
        elif kind == "semi":
            df = joins.restrict_users(rows, rows)
        elif kind == "anti":
            others = rows.select(F.concat(F.lit("x"), F.col("user_id")).alias("user_id"))
            df = joins.rows_not_of_users(rows, others, ["user_id", "track_id"])
        elif kind == "sample":
            df = sampling.subsample_users(rows, rows, 0.0)
        else:
            coded = rows.select(
                F.col("count").alias("user_index"),
                F.when(F.col("user_id") == "u0", 0).otherwise(F.col("count")).alias("track_index"),
                "count",
            )
            df = bias.predict_bias(bias.fit_bias(coded), coded)
        assert len(df.collect()) == 60_000
        assert "skew=true" in plan(df)


def test_hot_user_has_no_long_list(spark):
    rows = hot_rows(spark).select(
        F.when(F.col("user_id") == "u0", 0).otherwise(F.col("count")).alias("user_index"),
        (F.col("count") % 5).alias("count"),
        F.col("count").alias("track_index"),
    )
    lists = truth.truth_lists(rows, width=1000)
    sizes = lists.select("user_index", F.size("tracks").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 1000
    assert sizes.agg(F.sum("n")).first()[0] == 60_000


def test_skip_first_collapses_equal_rows_before_the_shuffle(spark):
    df = spark.range(5000).select(F.lit("s").alias("series"), F.lit(1.0).alias("Rank"))
    left = runs.skip_first(df, 2, ["Rank"])
    assert left.count() == 4998


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"
        applicationId = "app"

    class Conf:
        def __init__(self, root):
            self.root = root

        def get(self, key, default=None):
            return self.root if key == "spark.checkpoint.dir" else default

    class Session:
        sparkContext = Context()

        def __init__(self, root):
            self.conf = Conf(root)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session(None))
    assert shared_root(Session("hdfs://shared/x/")) == "hdfs://shared/x"
