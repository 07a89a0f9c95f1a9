"""Grid search over factor models and bias models."""

from __future__ import annotations

import itertools
import threading
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.operators.als import BLOCKS, AlsParams, fit_als, recommend
from tasteline.operators.bias import BiasPoint, bias_hits, fit_bias
from tasteline.operators.metrics import mean_metrics, precision_at, precision_list, ranking_metrics, user_metrics
from tasteline.session import discard, materialize
from tasteline.sources.models import save_model
from tasteline.sources.runlog import append_run, stored_runs


# List entries that the points in flight have on disk together.
LIST_ENTRIES = 200_000_000


def param_grid(*values: Iterable) -> list[tuple]:
    """All combinations, the last parameter running fastest."""
    return list(itertools.product(*values))


def grid_frame(spark: SparkSession, **values: list) -> DataFrame:
    """The same combinations as a frame with a ``run_no``."""
    names = list(values)
    rows = [(i, *point) for i, point in enumerate(param_grid(*values.values()))]
    return spark.createDataFrame(rows, ["run_no", *names])


def tune_als(
    train: DataFrame,
    truth: DataFrame,
    users: DataFrame,
    grid: list[AlsParams],
    k: int,
    runs_path: str,
    model_path: str | None = None,
    exclude_seen: bool = False,
    list_precision: bool = False,
    blocks: tuple[int, int] = BLOCKS,
    at_once: int = 1,
) -> list[dict]:
    """Fit, recommend and score each point; one record per point, in the order of the grid.

    Each record is written to ``runs_path`` when its point is done, and a point
    that has a record there (same number, parameters and blocks) is not worked on
    again, so a broken search goes on where it stopped. ``at_once`` points are in
    flight together, each in a scheduler pool of its own; with the scheduler set
    to FAIR (``spark.scheduler.mode``) they share the cores evenly. The saved
    model is that of the best metric, of the first point among equals, whatever
    order they finish in. ``list_precision`` divides by the length of the list,
    otherwise by ``k``. Lists are written out before the clock for them is read:
    ``rec`` covers the scoring and ``evl`` the metric alone; seconds of points in
    flight together overlap. Many users are worked off in parts, dealt by hash, so
    that no more than ``LIST_ENTRIES`` list entries lie on disk at a time.
    """
    spark = train.sparkSession
    points = [_point(n, params, blocks) for n, params in enumerate(grid)]
    stored = {r["run_no"]: r for r in stored_runs(spark, runs_path)}
    records = {
        n: stored[n] for n, point in enumerate(points) if n in stored and all(stored[n][c] == v for c, v in point.items())
    }
    todo = [n for n in range(len(grid)) if n not in records]
    if not todo:
        return [records[n] for n in range(len(grid))]
    train = train.select("user_index", "track_index", "count").persist(StorageLevel.MEMORY_AND_DISK)
    parts = max(1, -(-users.count() * k * at_once // LIST_ENTRIES))
    writing = threading.Lock()

    def work(run_no: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"search-{run_no % at_once}")
        start = time.monotonic()
        model = fit_als(train, grid[run_no], blocks)
        fitted = time.monotonic()
        rec = evl = 0.0
        scores = []
        for part in range(parts):
            begun = time.monotonic()
            own = users if parts == 1 else users.where(F.pmod(F.xxhash64("user_index"), F.lit(parts)) == part)
            lists = recommend(model, own, k, train if exclude_seen else None)
            recs = materialize(lists, "lists")
            recommended = time.monotonic()
            scores.append(_score(recs, truth, k, list_precision))
            done = time.monotonic()
            rec, evl = rec + recommended - begun, evl + done - recommended
            discard(recs)
            discard(lists, "topk-")
            if parts > 1:
                # Shuffle files go once the JVM has collected the frames that read them.
                del lists, recs
                spark.sparkContext._jvm.System.gc()
        n_users = sum(n for n, _ in scores)
        metric = sum(n * value for n, value in scores) / n_users if len(scores) > 1 and n_users else scores[0][1]
        times = (fitted - start + rec + evl, fitted - start, rec, evl)
        names = ("Time_TTL", "Time_fit", "Time_rec", "Time_evl")
        with writing:
            # The model first: a search broken in between works on the point again.
            better = all((metric, -run_no) > (r["Metric"], -n) for n, r in records.items())
            if better and model_path is not None:
                save_model(model, model_path)
            records[run_no] = {**points[run_no], "Metric": metric, **dict(zip(names, times))}
            append_run(spark, records[run_no], runs_path)

    try:
        if at_once == 1:
            for run_no in todo:
                work(run_no)
        else:
            with ThreadPoolExecutor(at_once) as pool:
                for task in [pool.submit(inheritable_thread_target(spark)(work), n) for n in todo]:
                    task.result()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        train.unpersist()
    return [records[n] for n in range(len(grid))]


def _point(run_no: int, params: AlsParams, blocks: tuple[int, int]) -> dict:
    """What tells one point of a search from another."""
    return {
        "run_no": run_no,
        "Rank": params.rank,
        "Reg": params.reg,
        "Alpha": params.alpha,
        "Maxiter": params.max_iter,
        "User_blocks": blocks[0],
        "Item_blocks": blocks[1],
    }


def _score(recs: DataFrame, truth: DataFrame, k: int, list_precision: bool) -> tuple[int, float]:
    """Number of users and their mean metric, 0 without users."""
    if list_precision:
        row, name = precision_list(recs, truth).first(), "precision_list"
    else:
        row, name = precision_at(recs, truth, k).first(), "precision_at_k"
    return (row["n_users"], float(row[name])) if row[name] is not None else (0, 0.0)


def evaluate(model: ALSModel, users: DataFrame, truth: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """All ranking metrics of a model on one split."""
    return ranking_metrics(recommend(model, users, k, seen), truth, k)


def tune_bias(
    train: DataFrame,
    truth: DataFrame,
    users: DataFrame,
    points: list[BiasPoint],
    k: int,
) -> DataFrame:
    """(run_no, items, users, damping, Metric), the list precision of each point.

    All points share one pass over train for the sums and one for the seen
    tracks; lists are not built.
    """
    return _bias_scores(bias_hits(fit_bias(train, *points), users, truth, k, train), points)


def _bias_scores(hits: DataFrame, points: list[BiasPoint]) -> DataFrame:
    scores = mean_metrics(user_metrics(hits, 1, ("run_no",)), ("run_no",), ("precision_list",))
    at = F.col("run_no") + 1
    return scores.select(
        "run_no",
        F.element_at(F.lit([bool(p.items) for p in points]), at).alias("items"),
        F.element_at(F.lit([bool(p.users) for p in points]), at).alias("users"),
        F.element_at(F.lit([float(p.damping) for p in points]), at).alias("damping"),
        F.col("precision_list").alias("Metric"),
    )


def timed_bias_runs(
    train: DataFrame, truth: DataFrame, users: DataFrame, points: list[BiasPoint], k: int
) -> DataFrame:
    """The records of ``tune_bias`` with elapsed seconds per stage.

    The points are worked off together, so each stage's seconds are the same in
    all records; ``rec`` covers the places of the hits, ``evl`` the metric alone.
    """
    start = time.monotonic()
    model = fit_bias(train, *points)
    fitted = time.monotonic()
    hits = materialize(bias_hits(model, users, truth, k, train), "hits")
    recommended = time.monotonic()
    scores = materialize(_bias_scores(hits, points), "scores")
    done = time.monotonic()
    discard(hits)
    return scores.select(
        "*",
        F.lit(done - start).alias("Time_TTL"),
        F.lit(fitted - start).alias("Time_fit"),
        F.lit(recommended - fitted).alias("Time_rec"),
        F.lit(done - recommended).alias("Time_evl"),
    )
