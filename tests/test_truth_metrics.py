import random

import pytest
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import Window
from pyspark.sql import functions as F

from tasteline.operators import metrics, truth
from tasteline.plans import catalog


def bag(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def plays(spark):
    """One user holds a third of all rows; some pairs come twice."""
    rng = random.Random(3)
    rows = [(0, rng.randint(1, 3), t) for t in range(400)]
    rows += [(u, rng.randint(1, 9), t) for u in range(1, 101) for t in rng.sample(range(400), 8)]
    rows += [(0, 2, t) for t in range(0, 400, 7)] + rows[500:520]
    return spark.createDataFrame(rows, "user_index int, count int, track_index int").repartition(6), rows


def expected_positions(rows):
    out = []
    for user in {r[0] for r in rows}:
        greatest = {}
        for _, count, track in (r for r in rows if r[0] == user):
            greatest[track] = max(count, greatest.get(track, 0))
        ranked = sorted((count, track) for track, count in greatest.items())
        out += [(user, i + 1, track) for i, (_, track) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("width", [100_000, 1000, 50, 7, 1])
def test_positions_for_any_width(plays, width):
    df, rows = plays
    assert bag(truth.truth_positions(df, width)) == expected_positions(rows)


@pytest.mark.parametrize("width", [100_000, 50, 3])
def test_lists_are_whole_and_bounded(plays, width):
    df, rows = plays
    lists = truth.truth_lists(df, width)
    assert bag(truth.flat_truth(lists)) == expected_positions(rows)
    assert lists.agg(F.max(F.size("tracks"))).first()[0] <= width
    n = lists.groupBy("user_index").agg(F.sum(F.size(F.array_distinct("tracks")))).collect()
    assert dict(map(tuple, n)) == {u: len({r[2] for r in rows if r[0] == u}) for u in {r[0] for r in rows}}


def test_lists_hold_what_the_running_window_collects(spark, sf_dir):
    rows = catalog._encoded(spark, sf_dir).validation
    window = Window.partitionBy("user_index").orderBy("count")
    running = rows.withColumn("tracks", F.collect_list("track_index").over(window))
    whole = running.groupBy("user_index").agg(F.max("tracks").alias("tracks"))
    ordered = F.sort_array("tracks")
    assert bag(whole.select("user_index", ordered)) == bag(truth.truth_lists(rows).select("user_index", ordered))


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    out = []
    for user in range(60):
        predicted = rng.sample(range(40), rng.choice([0, 1, 3, 10, 25]))
        tracks = rng.sample(range(40), rng.choice([0, 1, 4, 12, 30]))
        out.append((user, predicted, tracks))
    return out


def scored(spark, pairs, k, cut=None):
    """Metrics with each truth list in one part, or in parts of ``cut`` tracks."""
    recs = spark.createDataFrame(
        [(u, [(t, float(-i)) for i, t in enumerate(p)]) for u, p, _ in pairs],
        "user_index int, recommendations array<struct<track_index:int,rating:float>>",
    )
    parts = [
        (u, n, t[i : i + (cut or 10**6)])
        for u, _, t in pairs
        for n, i in enumerate(range(0, max(len(t), 1), cut or 10**6))
    ]
    lists = spark.createDataFrame(parts, "user_index int, part long, tracks array<int>")
    return metrics.ranking_metrics(recs, lists, k).first()


@pytest.mark.parametrize("k", [1, 5, 10, 20])
@pytest.mark.parametrize("cut", [None, 3])
def test_same_as_ranking_metrics(spark, pairs, k, cut):
    ours = scored(spark, pairs, k, cut)
    theirs = RankingMetrics(spark.sparkContext.parallelize([(p, t) for _, p, t in pairs]))
    assert ours["n_users"] == len(pairs)
    assert ours["precision_at_k"] == pytest.approx(theirs.precisionAt(k), abs=1e-12)
    assert ours["recall_at_k"] == pytest.approx(theirs.recallAt(k), abs=1e-12)
    assert ours["map"] == pytest.approx(theirs.meanAveragePrecision, abs=1e-12)
    assert ours["map_at_k"] == pytest.approx(theirs.meanAveragePrecisionAt(k), abs=1e-12)
    assert ours["ndcg_at_k"] == pytest.approx(theirs.ndcgAt(k), abs=1e-12)


def test_list_precision(spark, pairs):
    expected = [len(set(p) & set(t)) / len(p) if p else 0.0 for _, p, t in pairs]
    assert scored(spark, pairs, 5)["precision_list"] == pytest.approx(sum(expected) / len(expected))


def test_users_on_one_side_only_do_not_count(spark):
    recs = spark.createDataFrame(
        [(1, [(5, 1.0)]), (2, [(5, 1.0)])],
        "user_index int, recommendations array<struct<track_index:int,rating:float>>",
    )
    lists = spark.createDataFrame([(2, 0, [5]), (3, 0, [5])], "user_index int, part long, tracks array<int>")
    row = metrics.ranking_metrics(recs, lists, 4).first()
    assert (row["n_users"], row["precision_at_k"], row["precision_list"]) == (1, 0.25, 1.0)
    assert metrics.precision_at(recs, lists, 4).first()["precision_at_k"] == 0.25
    assert metrics.ndcg_at(recs, lists, 4).first()["ndcg_at_k"] == 1.0


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 2)], "prediction double, count int")
    assert metrics.rmse(df, "prediction", "count").first()["rmse"] == pytest.approx(2**0.5)
