import duckdb
import pytest
from oracle_check import mismatch
from pyspark.errors import PySparkException
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tasteline.operators import encode
from tasteline.plans import catalog, prepare
from tasteline.plans.oracle import ORACLE_SQL
from tasteline.sources.tables import Splits


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_codes_equal_string_indexer(spark, sf_dir):
    ids = catalog._raw(spark, sf_dir).train.select("user_id").distinct()
    indexed = StringIndexer(inputCol="user_id", outputCol="user_index").fit(ids).transform(ids)
    assert rows(encode.fit_codes(ids, "user_id", "user_index"), "user_id", "user_index") == rows(
        encode.cast_index(indexed, "user_index"), "user_id", "user_index"
    )


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_codes_do_not_depend_on_layout(spark, partitions):
    ids = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("id")).repartition(partitions)
    got = rows(encode.fit_codes(ids.union(ids), "id", "code"), "code", "id")
    expected = sorted(r["id"] for r in ids.collect())
    assert got == list(enumerate(expected))


def test_arbitrary_codes_are_dense(spark):
    ids = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("id"))
    codes = encode.fit_codes(ids, "id", "code", ordered=False)
    assert sorted(r["code"] for r in codes.collect()) == list(range(500))
    assert codes.select("id").distinct().count() == 500


def test_unseen_ids(spark):
    codes = encode.fit_codes(spark.createDataFrame([("a",), ("b",), (None,)], "id string"), "id", "code")
    df = spark.createDataFrame([("a",), ("z",), (None,)], "id string")
    assert codes.count() == 2
    assert {r["id"]: r["code"] for r in encode.attach_codes(df, codes, "id", "code", "keep").collect()} == {
        "a": 0,
        "z": None,
        None: None,
    }
    assert encode.attach_codes(df, codes, "id", "code", "drop").count() == 1
    with pytest.raises(PySparkException, match="unseen id: z"):
        encode.attach_codes(df.where("id = 'z'"), codes, "id", "code").collect()
    with pytest.raises(PySparkException, match="unseen id: null"):
        encode.attach_codes(df.where("id is null"), codes, "id", "code").collect()
    with pytest.raises(ValueError):
        encode.attach_codes(df, codes, "id", "code", "other")


def test_prepare_fails_on_user_without_train_rows(spark, tmp_path):
    schema = "user_id string, count int, track_id string"
    splits = Splits(
        spark.createDataFrame([("u1", 1, "t1")], schema),
        spark.createDataFrame([("u2", 1, "t1")], schema),
        spark.createDataFrame([("u1", 1, "t2")], schema),
    )
    with pytest.raises(PySparkException, match="unseen user_id: u2"):
        prepare.prepare(splits, str(tmp_path))


def test_prepare_codes_tracks_of_all_splits(spark, tmp_path):
    schema = "user_id string, count int, track_id string"
    splits = Splits(
        spark.createDataFrame([("u1", 1, "t2"), ("u2", 4, "t2")], schema),
        spark.createDataFrame([("u2", 1, "t1")], schema),
        spark.createDataFrame([("u1", 1, "t3")], schema),
    )
    prepare.prepare(splits, str(tmp_path))
    assert rows(prepare.track_encoding(spark, str(tmp_path)), "track_id", "track_index") == [
        ("t1", 0),
        ("t2", 1),
        ("t3", 2),
    ]
    assert rows(prepare.eval_users(spark, str(tmp_path)), "user_index") == [(1,)]


def test_users_without_train_rows_are_left_out(spark, tmp_path):
    """Customer 3 bought one part only, and that pair falls into the validation split; a null customer has no code."""
    orders = [(i, i % 3) for i in range(60)] + [(60, 3), (61, None)]
    lines = [(i, i // 3, 1.0 + i % 4) for i in range(60)] + [(60, 5, 2.0), (61, 5, 2.0)]
    made = {"orders": (orders, "o_orderkey long, o_custkey long"),
            "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double")}
    con = duckdb.connect()
    for name, (values, schema) in made.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    raw = catalog._raw(spark, str(tmp_path))
    assert "U00000003" in {r["user_id"] for r in raw.validation.collect()}
    assert "U00000003" not in {r["user_id"] for r in raw.train.collect()}
    names = ["encoded_val", "encoded_test", "encoding_pairs", "truth_val", "eval_user_ids", "bias_global", "bias_items",
             "bias_precision", "bias_tune", "als_ids", "als_lists", "als_agree", "als_folded", "als_saved"]
    for name in names:
        assert mismatch(con, ORACLE_SQL[name], catalog.QUERIES[name](spark, str(tmp_path))) is None, name


def test_pairs_without_a_quantity_count_as_no_play(spark, tmp_path):
    """A fit refuses null counts; user 0 and track 2 have such a pair, and others."""
    pairs = [(u, t) for u in range(20) for t in range(25) if (u + 2 * t) % 3]
    orders = [(n, u) for n, (u, _) in enumerate(pairs)]
    lines = [(n, t, None if (u, t) == (0, 2) else 1.0 + (u * t) % 4) for n, (u, t) in enumerate(pairs)]
    made = {"orders": (orders, "o_orderkey long, o_custkey long"),
            "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double")}
    con = duckdb.connect()
    for name, (values, schema) in made.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    sf_dir = str(tmp_path)
    assert catalog._encoded(spark, sf_dir).train.where("count IS NULL").count() == 1
    for name in ("als_ids", "als_lists", "als_agree", "als_folded", "als_saved", "als_grid", "als_log"):
        assert mismatch(con, ORACLE_SQL[name], catalog.QUERIES[name](spark, sf_dir)) is None, name
    for name in ("als_factors", "als_topk", "als_topk_unseen", "als_items", "als_score", "als_rmse", "als_metrics", "als_test"):
        assert catalog.QUERIES[name](spark, sf_dir).count(), name
