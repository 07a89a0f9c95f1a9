import math
from pathlib import Path

import pytest

from tasteline.operators import als, bias, runs
from tasteline.operators.als import AlsParams
from tasteline.operators.bias import BiasPoint
from tasteline.plans import catalog, tune
from tasteline.session import scratch_path, shared_root
from tasteline.sources import models, runlog


def test_grid_order(spark):
    assert tune.param_grid([1, 2], [True], ["a", "b"]) == [
        (1, True, "a"),
        (1, True, "b"),
        (2, True, "a"),
        (2, True, "b"),
    ]
    frame = tune.grid_frame(spark, rank=[10, 20], reg=[1.0, 2.0]).orderBy("run_no")
    assert [tuple(r) for r in frame.collect()] == [(0, 10, 1.0), (1, 10, 2.0), (2, 20, 1.0), (3, 20, 2.0)]


@pytest.fixture(scope="module")
def searched(spark, sf_dir):
    train = catalog._encoded(spark, sf_dir).train
    paths = {"runs_path": scratch_path(spark, "runs"), "model_path": scratch_path(spark, "best")}
    grid = [AlsParams(2, 1.0, 1.0, 2), AlsParams(4, 0.1, 1.0, 2)]
    records = tune.tune_als(
        train, catalog._truth(spark, sf_dir), catalog._users(spark, sf_dir), grid, 20, **paths, blocks=(4, 2)
    )
    return records, paths, grid


def test_records(spark, searched):
    records, paths, grid = searched
    stored = [r.asDict() for r in runlog.load_runs(spark, paths["runs_path"]).orderBy("run_no").collect()]
    assert stored == records
    for record in records:
        parts = record["Time_fit"] + record["Time_rec"] + record["Time_evl"]
        assert math.isclose(parts, record["Time_TTL"]) and min(record.values()) >= 0


def test_best_model_is_saved(spark, searched):
    records, paths, grid = searched
    best = max(records, key=lambda r: (r["Metric"], -r["run_no"]))
    assert models.load_model(paths["model_path"]).rank == grid[best["run_no"]].rank
    found = runs.best_run(runlog.load_runs(spark, paths["runs_path"])).first()
    assert found["run_no"] == best["run_no"]


def test_a_broken_search_goes_on(spark, sf_dir, monkeypatch):
    train, truth, users = catalog._encoded(spark, sf_dir).train, catalog._truth(spark, sf_dir), catalog._users(spark, sf_dir)
    paths = {"runs_path": scratch_path(spark, "runs"), "model_path": scratch_path(spark, "best")}
    grid = [AlsParams(2, 1.0, 1.0, 1), AlsParams(3, 1.0, 1.0, 1), AlsParams(4, 1.0, 1.0, 1)]
    fits, fit, broken = [], tune.fit_als, [True]

    def watched(rows, params, blocks):
        if params.rank == 3 and broken[0]:
            raise RuntimeError("lost")
        fits.append(params.rank)
        return fit(rows, params, blocks)

    monkeypatch.setattr(tune, "fit_als", watched)
    with pytest.raises(RuntimeError, match="lost"):
        tune.tune_als(train, truth, users, grid, 10, **paths, blocks=(2, 2))
    assert fits == [2] and len(runlog.stored_runs(spark, paths["runs_path"])) == 1
    broken[0] = False
    records = tune.tune_als(train, truth, users, grid, 10, **paths, blocks=(2, 2), at_once=2)
    assert sorted(fits) == [2, 3, 4]
    assert records == runlog.stored_runs(spark, paths["runs_path"])
    best = max(records, key=lambda r: (r["Metric"], -r["run_no"]))
    assert models.load_model(paths["model_path"]).rank == grid[best["run_no"]].rank
    # Nothing is left to do; another point of the same number is worked on and replaces the record.
    assert tune.tune_als(train, truth, users, grid, 10, **paths, blocks=(2, 2)) == records and len(fits) == 3
    again = tune.tune_als(train, truth, users, [*grid[:2], AlsParams(5, 1.0, 1.0, 1)], 10, **paths, blocks=(2, 2))
    assert fits[3:] == [5] and again[:2] == records[:2]
    assert runlog.stored_runs(spark, paths["runs_path"]) == again


def test_a_retried_run_leaves_one_record(spark):
    path = scratch_path(spark, "runs")
    names = [part.split()[0] for part in runlog.ALS_SCHEMA.split(", ")]
    for run_no, metric in ((1, 0.5), (0, 0.25), (1, 0.75)):
        runlog.append_run(spark, dict.fromkeys(names, 1) | {"run_no": run_no, "Metric": metric}, path)
    assert [(r["run_no"], r["Metric"]) for r in runlog.stored_runs(spark, path)] == [(0, 0.25), (1, 0.75)]
    assert runlog.stored_runs(spark, scratch_path(spark, "none")) == []


def test_first_of_equal_runs_wins(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.3), (2, 0.3)], "run_no int, Metric double")
    assert runs.best_run(df).first()["run_no"] == 1


def test_unseen_and_list_precision(spark, sf_dir):
    path = scratch_path(spark, "runs")
    train = catalog._encoded(spark, sf_dir).train
    records = tune.tune_als(
        train,
        catalog._truth(spark, sf_dir),
        catalog._users(spark, sf_dir),
        [AlsParams(2, 1.0, 1.0, 1)],
        10,
        path,
        exclude_seen=True,
        list_precision=True,
    )
    assert 0 <= records[0]["Metric"] <= 1


def test_lists_of_a_search_come_in_parts(spark, sf_dir, monkeypatch):
    """The same metric with few list entries on disk at a time, and no table of the top-k search left."""
    train, truth, users = catalog._encoded(spark, sf_dir).train, catalog._truth(spark, sf_dir), catalog._users(spark, sf_dir)
    n_users, sizes, write = users.count(), [], tune.materialize

    def searched():
        return tune.tune_als(train, truth, users, [AlsParams(2, 1.0, 1.0, 1)], 10, scratch_path(spark, "runs"))[0]["Metric"]

    def noted(df, label):
        sizes.append((label, df.count()))
        return write(df, label)

    whole = searched()
    monkeypatch.setattr(tune, "materialize", noted)
    monkeypatch.setattr(tune, "LIST_ENTRIES", 10 * n_users // 4)
    assert searched() == pytest.approx(whole)
    assert {label for label, _ in sizes} == {"lists"} and sum(n for _, n in sizes) == n_users
    assert len(sizes) in (4, 5) and max(n for _, n in sizes) < n_users / 2
    assert not list(Path(shared_root(spark).removeprefix("file://")).glob("tasteline/*/lists-*"))


def test_load_or_fit_fits_once(spark, sf_dir):
    path, calls = scratch_path(spark, "model"), []

    def fit():
        calls.append(1)
        return als.fit_als(catalog._encoded(spark, sf_dir).train, AlsParams(2, 1.0, 1.0, 1))

    assert not models.model_exists(spark, path)
    first = models.load_or_fit(spark, path, fit)
    again = models.load_or_fit(spark, path, fit)
    assert calls == [1] and models.model_exists(spark, path)
    assert sorted(map(tuple, first.itemFactors.collect())) == sorted(map(tuple, again.itemFactors.collect()))


def test_same_blocks_same_model(spark, sf_dir):
    train = catalog._encoded(spark, sf_dir).train
    models_ = [als.fit_als(t, AlsParams(3, 1.0, 1.0, 2)) for t in (train, train)]
    rows = [sorted((r.id, tuple(r.features)) for r in m.itemFactors.collect()) for m in models_]
    for (i, x), (j, y) in zip(*rows):
        assert i == j and x == pytest.approx(y, abs=1e-4)


def test_bias_search_is_the_sum_of_single_runs(spark, sf_dir):
    train, truth, users = (
        catalog._encoded(spark, sf_dir).train,
        catalog._truth(spark, sf_dir),
        catalog._users(spark, sf_dir),
    )
    points = [BiasPoint(True, False, 0.1), BiasPoint(True, True, 100.0), BiasPoint(False, False, 0.0)]
    together = {r["run_no"]: r for r in tune.tune_bias(train, truth, users, points, 20).collect()}
    for i, point in enumerate(points):
        alone = tune.tune_bias(train, truth, users, [point], 20).first()
        assert (together[i]["items"], together[i]["users"], together[i]["damping"]) == tuple(point)
        assert together[i]["Metric"] == pytest.approx(alone["Metric"])


def test_als_lists_do_not_depend_on_layout_of_users(spark, sf_dir):
    model, users = catalog._model(spark, sf_dir), catalog._users(spark, sf_dir)
    once = sorted(map(str, als.recommend(model, users, 5).collect()))
    assert once == sorted(map(str, als.recommend(model, users.repartition(7), 5).collect()))
    for rows in (16, 64, 100_000):
        assert once == sorted(map(str, als.recommend(model, users, 5, block_rows=rows).collect()))


def test_fit_bias_default_point(spark, sf_dir):
    model = bias.fit_bias(catalog._encoded(spark, sf_dir).train)
    assert model.points == (BiasPoint(),) and model.users is None
