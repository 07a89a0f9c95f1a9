import hashlib

import pytest
from pyspark.sql import functions as F

from tasteline.functions.keys import fraction_name
from tasteline.operators import joins, sampling
from tasteline.plans import catalog


def bucket(*key):
    return int(hashlib.md5("|".join(map(str, key)).encode()).hexdigest()[:8], 16)


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def frames(spark):
    schema = "user_id string, count int, track_id string"
    train = [(f"u{i % 40}", i % 3, f"t{i % 17}") for i in range(1200)]
    val = [(f"u{i}", 1, "t99") for i in range(0, 40, 5)]
    return spark.createDataFrame(train, schema), spark.createDataFrame(val, schema), train, {v[0] for v in val}


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.25, 1.0])
def test_user_sample(frames, fraction):
    train, val, rows, kept = frames
    limit = round(fraction * 2**32)
    expected = sorted(r for r in rows if r[0] in kept or bucket(r[0], 233) < limit)
    got = sampling.subsample_users(train, val, fraction)
    assert bag(got.select("user_id", "count", "track_id")) == expected
    again = sampling.subsample_users(train.repartition(7), val.repartition(3), fraction)
    assert bag(again.select("user_id", "count", "track_id")) == expected


@pytest.mark.parametrize("dedup", [False, True])
@pytest.mark.parametrize("fraction", [0.0, 0.05, 1.0])
def test_row_sample(frames, fraction, dedup):
    train, val, rows, kept = frames
    limit = round(fraction * 2**32)
    others = [r for r in rows if r[0] not in kept and bucket(r[0], r[2], r[1], 233) < limit]
    expected = sorted([r for r in rows if r[0] in kept] + (list(set(others)) if dedup else others))
    assert bag(sampling.subsample_rows(train.repartition(5), val, fraction, dedup=dedup)) == expected


def test_fraction_out_of_range(frames):
    with pytest.raises(ValueError):
        sampling.subsample_users(frames[0], frames[1], 1.5)


def test_eval_users_floor(spark):
    users = spark.range(20000).select(F.col("id").cast("int").alias("user_index"))
    assert bag(sampling.subsample_eval_users(users, 0.01)) == bag(sampling.subsample_eval_users(users, 0.05))
    assert 800 < sampling.subsample_eval_users(users, 0.01).count() < 1200


def test_exact_sample(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    expected = sorted(sorted(range(1000), key=lambda k: (bucket(k, 5), k))[:100])
    assert [r[0] for r in bag(sampling.sample_n(df.repartition(9), 100, "key", seed=5))] == expected
    assert sampling.sample_n(df, 5000, "key").count() == 1000


def test_restrictions(frames):
    train, val, rows, kept = frames
    columns = ["user_id", "count", "track_id"]
    inside = sorted(r for r in rows if r[0] in kept)
    outside = sorted(r for r in rows if r[0] not in kept)
    doubled = val.union(val)
    assert bag(joins.restrict_users(train, doubled).select(*columns)) == inside
    assert bag(joins.rows_of_users(train, doubled, columns)) == inside
    assert bag(joins.rows_not_of_users(train, doubled, columns)) == outside
    removed = joins.rows_of_users(train, val, columns)
    assert bag(joins.rows_except(train, removed)) == sorted(set(outside))
    assert joins.id_universe("track_id", train, val, val).count() == 18


def test_splits_are_disjoint(spark, sf_dir):
    stacked = catalog._raw(spark, sf_dir).stacked()
    assert stacked.groupBy("user_id", "track_id").count().where("count > 1").isEmpty()


def test_fraction_names():
    assert [fraction_name(f) for f in (0.01, 0.25, 1)] == ["0_01", "0_25", "1_0"]
