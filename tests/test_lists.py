"""Top-k lists against brute force, with hot users and small block sizes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tasteline.operators import als, bias, metrics, shared, skew, sweep, toplists
from tasteline.operators import blocks as blocks_module
from tasteline.operators.blocks import top_matches
from tasteline.operators.numbering import number_rows
from tasteline.plans import catalog
from tasteline.session import materialize


@pytest.fixture(scope="module")
def plays(spark):
    """60 tracks, 40 users; user 0 has seen all tracks, user 1 all but two."""
    rng = random.Random(5)
    rows = {(0, t): rng.randint(1, 5) for t in range(60)}
    rows.update({(1, t): rng.randint(1, 5) for t in range(58)})
    for user in range(2, 40):
        rows.update({(user, t): rng.randint(1, 5) for t in rng.sample(range(60), rng.randint(1, 30))})
    flat = [(u, t, c) for (u, t), c in rows.items()]
    return spark.createDataFrame(flat, "user_index int, track_index int, count int").repartition(5), flat


def lists(recs, *by):
    return {
        tuple(r[c] for c in (*by, "user_index")): [(e["track_index"], e["rating"]) for e in r["recommendations"]]
        for r in recs.collect()
    }


def item_terms(flat, damping):
    mu = sum(c for _, _, c in flat) / len(flat)
    terms = {}
    for track in {t for _, t, _ in flat}:
        counts = [c for _, t, c in flat if t == track]
        terms[track] = (sum(counts) - len(counts) * mu) / (len(counts) + damping)
    return mu, terms


@pytest.mark.parametrize("headroom", [4096, 20, 3])
@pytest.mark.parametrize("k", [1, 7, 200])
def test_bias_lists_without_seen(spark, plays, k, headroom):
    df, flat = plays
    points = (bias.BiasPoint(True, False, 5.0), bias.BiasPoint(False, False, 0.0), bias.BiasPoint(True, True, 1.0))
    model = bias.fit_bias(df, *points)
    users = spark.createDataFrame([(u,) for u in range(40)] + [(3,), (77,)], "user_index int")
    got = lists(bias.recommend_bias(model, users, k, df, headroom), "run_no")
    seen = {}
    for u, t, _ in flat:
        seen.setdefault(u, set()).add(t)
    assert len(got) == 3 * 41
    for run, point in enumerate(points):
        mu, terms = item_terms(flat, point.damping)
        if not point.items:
            terms = dict.fromkeys(terms, 0.0)
        for user in [*range(40), 77]:
            left = [t for t in terms if t not in seen.get(user, ())]
            expected = sorted(left, key=lambda t: (-terms[t], t))[:k]
            assert [t for t, _ in got[run, user]] == expected, (run, user)
            rows = [(c, terms[t]) for u, t, c in flat if u == user]
            term = sum(c - mu - b for c, b in rows) / (len(rows) + point.damping) if point.users and rows else 0.0
            for track, rating in got[run, user]:
                assert rating == pytest.approx(mu + terms[track] + term)


@pytest.mark.parametrize("headroom", [4096, 20])
@pytest.mark.parametrize("k", [1, 7, 200])
def test_hits_without_lists(spark, plays, k, headroom):
    """Same hits as those counted in the lists, also for hot users and long truth lists."""
    df, _ = plays
    rng = random.Random(2)
    tracks = [(u, n, rng.sample(range(80), rng.choice([1, 5, 40]))) for u in range(3, 45) for n in range(1)]
    tracks += [(0, 0, [1, 2, 3]), (1, 0, [58, 59, 4]), (1, 1, [5, 79])]
    truth_df = spark.createDataFrame(tracks, "user_index int, part long, tracks array<int>")
    users = spark.createDataFrame([(u,) for u in range(42)], "user_index int")
    model = bias.fit_bias(df, bias.BiasPoint(True, False, 5.0), bias.BiasPoint(False, False, 0.0))
    recs = bias.recommend_bias(model, users, k, df)
    listed = metrics.user_hits(metrics.pair_lists(recs, truth_df, ("run_no",)), ("run_no",))
    columns = ["run_no", "user_index", "hits", "n_truth", "n_predicted"]
    direct = bias.bias_hits(model, users, truth_df, k, df, headroom)
    assert sorted(map(str, direct.select(*columns).collect())) == sorted(map(str, listed.select(*columns).collect()))


def test_bias_lists_with_seen(spark, plays):
    df, flat = plays
    users = spark.createDataFrame([(0,), (5,)], "user_index int")
    model = bias.fit_bias(df, bias.BiasPoint(True, False, 2.0))
    _, terms = item_terms(flat, 2.0)
    expected = sorted(terms, key=lambda t: (-terms[t], t))[:10]
    got = lists(bias.recommend_bias(model, users, 10), "run_no")
    assert {key: [t for t, _ in v] for key, v in got.items()} == {(0, 0): expected, (0, 5): expected}


@pytest.mark.parametrize("by", ["n_users", "n_plays"])
def test_popular_lists(spark, plays, by):
    df, flat = plays
    score = {}
    for _, t, c in flat:
        score[t] = score.get(t, 0) + (1 if by == "n_users" else c)
    users = spark.createDataFrame([(2,)], "user_index int")
    seen = {t for u, t, _ in flat if u == 2}
    ranked = sorted(score, key=lambda t: (-score[t], t))
    got = lists(bias.recommend_popular(df, users, 5, by))
    assert [t for t, _ in got[(2,)]] == ranked[:5]
    got = lists(bias.recommend_popular(df, users, 5, by, exclude_seen=True))
    assert [t for t, _ in got[(2,)]] == [t for t in ranked if t not in seen][:5]


def test_predict_bias_of_unknown_ids(spark, plays):
    df, flat = plays
    model = bias.fit_bias(df, bias.BiasPoint(True, True, 1.0))
    pairs = spark.createDataFrame([(99, 99)], "user_index int, track_index int")
    mu, _ = item_terms(flat, 1.0)
    assert bias.predict_bias(model, pairs).first()["prediction"] == pytest.approx(mu)


def test_numbers_follow_the_order(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") * 7919 % 3001 % 10).alias("v")).repartition(9)
    got = number_rows(df, [F.desc("v"), F.asc("id")], "numbers").collect()
    expected = sorted(((r["v"], r["id"]) for r in got), key=lambda r: (-r[0], r[1]))
    assert [(r["v"], r["id"]) for r in sorted(got, key=lambda r: r["number"])] == expected
    assert sorted(r["number"] for r in got) == list(range(3000))


def test_hot_user_with_a_long_list(spark):
    """More candidates than one step makes, most of them seen."""
    scores = spark.range(5000).select(
        F.explode(F.lit([0, 1])).alias("run_no"), F.col("id").cast("int").alias("track_index"),
        (F.col("id") % 100).cast("double").alias("rating"),
    )
    seen = spark.range(4500).select(F.lit(1).alias("user_index"), F.col("id").cast("int").alias("track_index"))
    users = spark.createDataFrame([(1,), (2,)], "user_index int")
    got = lists(shared.recommend_shared(scores, users, 20, [0, 1], seen, headroom=10), "run_no")
    expected = sorted(range(4500, 5000), key=lambda t: (-(t % 100), t))[:20]
    assert [t for t, _ in got[0, 1]] == expected == [t for t, _ in got[1, 1]]
    assert [t for t, _ in got[0, 2]] == sorted(range(5000), key=lambda t: (-(t % 100), t))[:20]


@pytest.mark.parametrize("limit", ["1000", "2"])
def test_top_k_beyond_the_group_limit(spark, limit):
    rows = [(0, i % 50, i) for i in range(600)] + [(g, i, i) for g in range(1, 20) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, v int, id int").repartition(8)
    expected = []
    for g in {r[0] for r in rows}:
        ranked = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:5]
        expected += [(*r, i + 1) for i, r in enumerate(ranked)]
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        got = skew.top_k(df, ["g"], [F.desc("v"), F.asc("id")], 5)
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)


def test_heavy_keys(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(i,) for i in range(1, 60)], "user_index int")
    assert skew.heavy_keys(df, "user_index", 30) is None
    assert [r[0] for r in skew.heavy_keys(df, "user_index", 29).collect()] == [0]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    left = rng.integers(-2, 3, (700, 3)).astype(np.float32)
    right = rng.integers(-2, 3, (90, 3)).astype(np.float32)
    schema = "id int, features array<float>"
    frames = [spark.createDataFrame([(i * 2, v.tolist()) for i, v in enumerate(m)], schema) for m in (left, right)]
    return left, right, *frames


@pytest.mark.parametrize("block_rows", [10**5, 25])
@pytest.mark.parametrize("k", [1, 6, 500])
@pytest.mark.parametrize("exclude", [False, True])
def test_matches_with_ties(spark, vectors, block_rows, k, exclude):
    left, right, left_df, right_df = vectors
    rng = random.Random(1)
    taken = {0: set(range(0, 180, 2)), 2: set(range(0, 170, 2))}
    taken.update({i * 2: set(rng.sample(range(0, 180, 2), 8)) for i in range(2, 700, 3)})
    pairs = [(i, t) for i, ts in taken.items() for t in ts] + [(4, 9999), (10**6, 3)]
    taken_df = spark.createDataFrame(pairs, "id int, other int") if exclude else None
    got = top_matches(left_df, right_df, k, taken_df, block_rows).collect()
    assert len(got) == 700
    scores = left @ right.T
    for row in got:
        out = taken.get(row["id"], set()) if exclude else set()
        ranked = sorted((-s, j * 2) for j, s in enumerate(scores[row["id"] // 2].tolist()) if j * 2 not in out)[:k]
        assert [(m["id"], m["rating"]) for m in row["matches"]] == [(j, -s) for s, j in ranked], row["id"]


@pytest.mark.parametrize("blocks", [4, 100])
def test_entries_per_row_stay_near_k(spark, monkeypatch, blocks):
    """Lists that leave the tasks hold about k entries a row and wave, however many blocks there are."""
    rng = np.random.default_rng(blocks)
    k, rows = 10, 4000
    left, right = rng.normal(size=(200, 6)).astype(np.float32), rng.normal(size=(rows, 6)).astype(np.float32)
    right *= rng.pareto(2.0, size=(rows, 1)).astype(np.float32) + 0.1
    schema = "id int, features array<float>"
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], schema) for m in (left, right)]
    moved, merged = [], blocks_module._merged

    def counted(found, lists, k):
        found = materialize(found, "found")
        moved.append(found.agg(F.sum(F.size("matches"))).first()[0] or 0)
        return merged(found, lists, k)

    monkeypatch.setattr(blocks_module, "_merged", counted)
    got = {r.id: [m["id"] for m in r.matches] for r in top_matches(*frames, k, block_rows=rows // blocks).collect()}
    scores = left.astype(np.float64) @ right.astype(np.float64).T
    assert got == {i: list(np.argsort(-s, kind="stable")[:k]) for i, s in enumerate(scores)}
    assert len(moved) == (2 if blocks == 4 else 5)
    # All blocks together would have moved k entries each.
    assert sum(moved) <= 3 * k * len(left)


@pytest.mark.parametrize("k", [1, 6, 500])
@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("scale", [1.0, 0.37])
def test_swept_lists_with_ties(spark, vectors, monkeypatch, k, exclude, scale):
    """Many left rows are swept: the same lists, also for ids that occur twice, in products that are not exact and small parts."""
    monkeypatch.setattr(blocks_module, "_MIN_ROWS", 1)
    monkeypatch.setattr(blocks_module, "BLOCK_ROWS", 20)
    monkeypatch.setattr(blocks_module, "_merged", None)
    left, right = (v * np.float32(scale) for v in vectors[:2])
    schema = "id int, features array<float>"
    left_df = spark.createDataFrame([(i // 2 * 2, v.tolist()) for i, v in enumerate(left)], schema)
    right_df = spark.createDataFrame([(i // 3 * 3, v.tolist()) for i, v in enumerate(right)], schema)
    rng = random.Random(1)
    taken = {0: set(range(0, 90, 3)), 2: set(range(0, 80, 3))}
    taken.update({i: set(rng.sample(range(0, 90, 3), 8)) for i in range(4, 700, 6)})
    pairs = [(i, t) for i, ts in taken.items() for t in ts] + [(4, 9999), (10**6, 3), (8, None), (None, 3)]
    taken_df = spark.createDataFrame(pairs, "id int, other int") if exclude else None
    got = top_matches(left_df, right_df, k, taken_df, 25).collect()
    scores = np.zeros((700, 90))
    for d in range(3):
        scores += left[:, d, None].astype(np.float64) * right[:, d]
    expected = []
    for i in range(700):
        out = taken.get(i // 2 * 2, set()) if exclude else set()
        ranked = sorted((-s, j // 3 * 3) for j, s in enumerate(scores[i].tolist()) if j // 3 * 3 not in out)[:k]
        expected.append((i // 2 * 2, [(j, -s + 0.0) for s, j in ranked]))
    assert sorted((r["id"], [(m["id"], m["rating"]) for m in r["matches"]]) for r in got) == sorted(expected)


def test_lists_of_many_rows_are_not_moved(spark, monkeypatch):
    """Rows that are enough for all cores: no list is written or joined on the way, each leaves its task once."""
    rng = np.random.default_rng(3)
    rows, k = 2 * spark.sparkContext.defaultParallelism * blocks_module._MIN_ROWS, 5
    left, right = (rng.normal(size=(n, 4)).astype(np.float32) for n in (rows, 60))
    schema = "id int, features array<float>"
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], schema) for m in (left, right)]
    written = []

    def noted(df, label):
        written.append(label)
        return materialize(df, label)

    monkeypatch.setattr(blocks_module, "materialize", noted)
    best = top_matches(*frames, k, block_rows=10)
    assert "topk-lists" not in written
    text = best._jdf.queryExecution().executedPlan().toString()
    assert "matches" not in "".join(line for line in text.splitlines() if "Exchange" in line)
    assert text.count("Exchange") == 1
    got = {r.id: [m["id"] for m in r.matches] for r in best.collect()}
    scores = left.astype(np.float64) @ right.astype(np.float64).T
    assert got == {i: list(np.argsort(-s, kind="stable")[:k]) for i, s in enumerate(scores)}


@pytest.mark.parametrize("same", [False, True])
def test_a_task_keeps_few_entries_a_row(monkeypatch, same):
    """Blocks of equal ratings, or of ever better ones, do not make a row's list longer than twice k."""
    monkeypatch.setattr(sweep, "_CELLS", 300)
    lists = sweep.Lists(4, np.arange(3, dtype=np.int32), np.ones(6, np.float32), *[np.zeros(0, np.int32)] * 2)
    for block in range(5):
        right = np.full((100, 2), 1 if same else 1 + block, np.float32)
        lists.add(np.arange(block * 100, block * 100 + 100, dtype=np.int32), right, float(np.linalg.norm(right[0])))
    assert lists.ratings.shape[1] <= 4 + 32
    first = 0 if same else 400
    got = [r for batch in lists.batches() for r in batch.to_pylist()]
    assert [r["other"] for r in got] == [list(range(first, first + 4))] * 3


def test_lists_of_a_block_leave_in_pieces(monkeypatch):
    """No batch holds more list entries than scores are held at a time, and every row has its list."""
    monkeypatch.setattr(blocks_module, "_CELLS", 400)
    rng, k = np.random.default_rng(9), 20
    left, right = (rng.integers(-9, 9, (n, 4)).astype(np.float32) for n in (150, 40))
    taken = [None] * 150 + [list(range(30))]
    rows = pa.table({
        "id": pa.array([*range(150), 3], pa.int32()),
        "features": pa.array([*left.tolist(), None], pa.list_(pa.float32())),
        "_bound": pa.array([None] * 151, pa.float64()),
        "_taken": pa.array(taken, pa.list_(pa.int32())),
    })
    others = pa.table({"other": pa.array(range(40), pa.int32()), "features": pa.array(right.tolist(), pa.list_(pa.float32()))})
    result = blocks_module._rank_block(k)(rows, others)
    batches = result.to_batches()
    assert len(batches) == 15 and max(len(b.column("other").flatten()) for b in batches) <= 400
    scores = left.astype(np.float64) @ right.T
    got = {r["id"]: list(zip(r["other"], r["rating"])) for r in result.to_pylist()}
    for user in range(150):
        free = range(30, 40) if user == 3 else range(40)
        assert got[user] == sorted(((t, scores[user, t]) for t in free), key=lambda e: (-e[1], e[0]))[:k]


def test_same_lists_as_the_model(spark, sf_dir):
    model = catalog._model(spark, sf_dir)
    users = catalog._users(spark, sf_dir)
    ours = lists(als.recommend(model, users, 20))
    theirs = lists(model.recommendForUserSubset(users, 20))
    assert ours.keys() == theirs.keys()
    for key, entries in ours.items():
        assert [r for _, r in entries] == pytest.approx([r for _, r in theirs[key]], abs=1e-5)
        clear = entries[-1][1] + 1e-5
        assert {t for t, r in entries if r > clear} <= {t for t, _ in theirs[key]}
    tracks = catalog._encoded(spark, sf_dir).validation.select("track_index").distinct()
    mine = {r["track_index"]: [e["rating"] for e in r["recommendations"]] for r in als.recommend_items(model, tracks, 5).collect()}
    other = {r["track_index"]: [e["rating"] for e in r["recommendations"]] for r in model.recommendForItemSubset(tracks, 5).collect()}
    assert mine.keys() == other.keys()
    for track, ratings in mine.items():
        assert ratings == pytest.approx(other[track], abs=1e-5)


def test_unseen_lists_of_a_model(spark, sf_dir):
    model = catalog._model(spark, sf_dir)
    train = catalog._encoded(spark, sf_dir).train
    recs = als.recommend(model, catalog._users(spark, sf_dir), 30, train, block_rows=64)
    flat = toplists.flat_lists(recs)
    assert flat.join(train, ["user_index", "track_index"], "left_semi").isEmpty()
    assert flat.groupBy("user_index").count().where("count != 30").isEmpty()
    scores = {(r["user_index"], r["track_index"]): r["prediction"] for r in als.score_pairs(model, flat.select("user_index", "track_index")).collect()}
    factors = {r["id"]: np.array(r["features"]) for r in als.item_factors(model).collect()}
    people = {r["id"]: np.array(r["features"]) for r in als.user_factors(model).collect()}
    seen = {}
    for r in train.collect():
        seen.setdefault(r["user_index"], set()).add(r["track_index"])
    for user, entries in lists(recs).items():
        everything = {t: float(v @ people[user[0]]) for t, v in factors.items() if t not in seen[user[0]]}
        best = sorted(everything.values(), reverse=True)[:30]
        assert [r for _, r in entries] == pytest.approx(best, abs=1e-5)
        for track, rating in entries:
            assert rating == pytest.approx(scores[user[0], track], abs=1e-5)


def test_unknown_users_drop_out(spark, sf_dir):
    users = spark.createDataFrame([(0,), (10**6,)], "user_index int")
    got = lists(als.recommend(catalog._model(spark, sf_dir), users, 3))
    assert list(got) == [(0,)]


def test_shared_lists_without_scores_beyond_head(spark):
    scores = spark.createDataFrame([(0, t, float(t % 4)) for t in range(12)], "run_no int, track_index int, rating double")
    seen = spark.createDataFrame([(1, t) for t in (3, 7, 11, 2)], "user_index int, track_index int")
    users = spark.createDataFrame([(1,), (2,)], "user_index int")
    for headroom in (1, 4, 100):
        got = lists(shared.recommend_shared(scores, users, 3, [0], seen, headroom))
        assert [t for t, _ in got[(1,)]] == [6, 10, 1]
        assert [t for t, _ in got[(2,)]] == [3, 7, 11]


def test_runs_beyond_a_broadcast_give_the_same(spark, plays, monkeypatch):
    """Common lists too long to be broadcast together are joined by shuffles, in one plan."""
    df, _ = plays
    users = spark.createDataFrame([(u,) for u in range(40)], "user_index int")
    truth_df = spark.createDataFrame([(u, 1, [u, 59 - u]) for u in range(30)], "user_index int, first int, tracks array<int>")
    model = bias.fit_bias(df, *[bias.BiasPoint(True, False, float(d)) for d in range(5)])

    def results():
        hits = bias.bias_hits(model, users, truth_df, 7, df, 20)
        return lists(bias.recommend_bias(model, users, 7, df, 20), "run_no"), sorted(map(str, hits.collect()))

    together = results()
    monkeypatch.setattr(shared, "MOST_BROADCAST", 60)
    assert results() == together


def test_hits_of_a_user_with_thousands_of_places(spark):
    """4,000 seen and 4,000 true tracks, a tenth in both; the work grows with their sum, not their product."""
    rng = random.Random(2)
    tracks = list(range(9000))
    rng.shuffle(tracks)
    scores = spark.createDataFrame([(0, t, float(9000 - i)) for i, t in enumerate(tracks)], "run_no int, track_index int, rating double")
    seen, true = rng.sample(tracks, 4000), rng.sample(tracks, 4000)
    users = spark.createDataFrame([(1,)], "user_index int")
    seen_df = spark.createDataFrame([(1, t) for t in seen], "user_index int, track_index int")
    truth = spark.createDataFrame([(1, 1, true)], "user_index int, first int, tracks array<int>")
    left = [t for t in tracks if t not in set(seen)]
    for k in (10, 3000, 9000):
        (row,) = shared.shared_hits(scores, users, truth, k, [0], seen_df, headroom=9000).collect()
        assert row.hits == [i + 1 for i, t in enumerate(left[:k]) if t in set(true)]
        assert (row.n_truth, row.n_predicted) == (4000, min(k, 5000))
    plan = shared.shared_hits(scores, users, truth, 10, [0], seen_df)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(_taken" not in plan


def test_a_large_grid_is_one_plan(spark, plays, monkeypatch):
    df, _ = plays
    users = spark.createDataFrame([(u,) for u in range(40)], "user_index int")
    truth_df = spark.createDataFrame([(u, 1, [u, 59 - u]) for u in range(30)], "user_index int, first int, tracks array<int>")
    points = [bias.BiasPoint(True, False, d / 7) for d in range(200)]
    hits = bias.bias_hits(bias.fit_bias(df, *points), users, truth_df, 7, df, 20)
    assert hits.select("run_no").distinct().count() == 200
    monkeypatch.setattr(shared, "MOST_BROADCAST", 60)
    few = bias.bias_hits(bias.fit_bias(df, *points[:2]), users, truth_df, 7, df, 20)
    many = bias.bias_hits(bias.fit_bias(df, *points), users, truth_df, 7, df, 20)
    assert sorted(map(str, many.collect())) == sorted(map(str, hits.collect()))
    sizes = [f._jdf.queryExecution().optimizedPlan().toString().count("Join ") for f in (few, many)]
    assert sizes[0] == sizes[1]


def test_relabelled_ids_balance_the_blocks(spark):
    """Frequent tracks whose codes all fall into one block are spread."""
    rng = random.Random(1)
    rows = {(u, 0): 1 for u in range(30)}
    rows.update({(u, t * 4): rng.randint(1, 5) for t in range(1, 60) for u in rng.sample(range(400), max(2, 300 // t))})
    rows.update({(u, t): 1 for t in range(240) for u in rng.sample(range(400), 2)})
    flat = [(u, t, c) for (u, t), c in rows.items()]
    train = spark.createDataFrame(flat, "user_index int, track_index int, count int").repartition(3)
    codes = {r.track_index: r.code for r in als.spread_codes(train, "track_index").collect()}
    assert sorted(codes.values()) == list(range(len(codes)))
    before, after = [0] * 4, [0] * 4
    for _, t, _ in flat:
        before[t % 4] += 1
        after[codes[t] % 4] += 1
    assert max(before) > 2 * len(flat) / 4 > max(after)
    params = als.AlsParams(3, 0.1, 1.0, 3)
    tables = als.fit_spread(train, params, (4, 4))
    users = {r.id: np.array(r.features) for r in tables.users.collect()}
    items = {r.id: np.array(r.features) for r in tables.items.collect()}
    assert users.keys() == {u for u, _, _ in flat} and items.keys() == {t for _, t, _ in flat}
    # Mapped back to the right ids: the last step of the fit solved the users from the items.
    folded = {r.id: np.array(r.features) for r in als.fold_in(train, tables.items, params).collect()}
    for user, vector in folded.items():
        assert vector == pytest.approx(users[user], abs=1e-3)


def test_folded_users_solve_their_equations(spark):
    """Whole-number factors, unknown users, a user in many groups, tracks without factors."""
    rng = np.random.default_rng(3)
    items = rng.integers(-3, 4, (50, 4)).astype(np.float32)
    factors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id int, features array<float>").repartition(3)
    rows = [(int(u), int(t), int(c)) for u, t, c in zip(rng.integers(0, 9, 200), rng.integers(0, 50, 200), rng.integers(0, 4, 200))]
    rows += [(100, t % 50, 1 + t % 3) for t in range(300)] + [(7, 999, 5), (8000, 999, 1)]
    plays = spark.createDataFrame(rows, "user_index int, track_index int, count int").repartition(4)
    params = als.AlsParams(4, 0.5, 2.0, 1)
    got = {r.id: np.array(r.features) for r in als.fold_in(plays, factors, params, fold_rows=7).collect()}
    assert got.keys() == {u for u, t, _ in rows if t < 50}
    for user, vector in got.items():
        own = [(items[t].astype(float), c) for u, t, c in rows if u == user and t < 50]
        matrix = items.T.astype(float) @ items + sum(2.0 * c * np.outer(y, y) for y, c in own)
        matrix = matrix + 0.5 * sum(c > 0 for _, c in own) * np.eye(4)
        right = sum((1 + 2.0 * c) * y for y, c in own if c > 0)
        assert matrix @ vector == pytest.approx(right, abs=1e-2)
    assert als.fold_in(plays.where("user_index = 100"), factors, params).count() == 1
