"""Run logs to tables and metric/time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.functions.labels import (
    ALS_FIELDS,
    ALS_PREFIX,
    BIAS_FIELDS,
    BIAS_FLAGS,
    BIAS_PREFIX,
    line_values,
    series_label,
)
from tasteline.operators.skew import top_k
from tasteline.session import materialize


def keep_records(lines: DataFrame, prefix: str) -> DataFrame:
    """Lines that hold a run record; anything else in a log is left out."""
    return lines.where(F.col("value").startswith(prefix))


def _parse(lines: DataFrame, prefix: str, fields: list[str], flags: list[str]) -> DataFrame:
    values = line_values(F.col("value"), fields, flags)
    labelled = keep_records(lines, prefix).select(series_label(F.col("log")).alias("series"), values.alias("_v"))
    return labelled.select("series", "_v.*")


def parse_als_runs(lines: DataFrame) -> DataFrame:
    return _parse(lines, ALS_PREFIX, ALS_FIELDS, [])


def parse_bias_runs(lines: DataFrame) -> DataFrame:
    return _parse(lines, BIAS_PREFIX, BIAS_FIELDS, BIAS_FLAGS)


def sort_runs(runs: DataFrame, *keys: str) -> DataFrame:
    # A sort reads its input twice; the logs are parsed once.
    return materialize(runs, "runs").orderBy("series", *keys)


def slice_runs(
    runs: DataFrame,
    reg: float | None = None,
    alpha: float | None = None,
    max_iter: float | None = None,
    max_rank: float | None = None,
) -> DataFrame:
    """Runs with the given parameter values; ``max_rank`` is an upper bound."""
    wanted = {"Reg": reg, "Alpha": alpha, "Maxiter": max_iter}
    for column, value in wanted.items():
        if value is not None:
            runs = runs.where(F.col(column) == value)
    return runs if max_rank is None else runs.where(F.col("Rank") <= max_rank)


def slice_bias(runs: DataFrame, items: bool, users: bool) -> DataFrame:
    return runs.where(
        (F.col("items") if items else ~F.col("items")) & (F.col("users") if users else ~F.col("users"))
    )


def by_engine(runs: DataFrame, prefix: str) -> DataFrame:
    return runs.where(F.col("series").startswith(prefix))


def skip_first(runs: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Each series without its first ``n`` rows in the given order.

    A series' n-th row in order is found first (one line per series, a few
    hundred bytes, joined back); rows after it stay, and of rows equal to it as
    many as lie beyond the n-th. Nulls come last. No task has to order a whole series.
    """
    if n == 0:
        return runs
    keys = [*order, *[c for c in runs.columns if c not in order and c != "series"]]
    first = top_k(runs, ["series"], [F.asc_nulls_last(c) for c in keys], n)
    key = F.struct(*[x for c in keys for x in (F.isnull(c).alias(f"_no_{c}"), F.col(c))])
    last = first.groupBy("series").agg(F.max(key).alias("_last"), F.max("pos").alias("_pos"))
    equal = first.join(last, "series").where(key == F.col("_last")).groupBy("series").agg(F.count("*").alias("_equal"))
    cut = last.join(equal, "series")
    marked = runs.join(cut, "series")
    after = marked.where((key > F.col("_last")) & (F.col("_pos") == n))
    same = marked.where((key == F.col("_last")) & (F.col("_pos") == n)).groupBy("series", *keys).agg(
        (F.count("*") - F.first("_equal")).cast("int").alias("_left")
    )
    rest = same.select("*", F.explode(F.array_repeat(F.lit(0), F.col("_left"))))
    return after.select(*runs.columns).unionByName(rest.select(*runs.columns))


def series(
    runs: DataFrame,
    metric: str = "Metric",
    engine: str | None = "spark",
    skip: int = 0,
    max_rank: float | None = None,
    reg: float = 1.0,
    alpha: float = 1.0,
    max_iter: float = 5.0,
) -> DataFrame:
    """(series, Rank, metric) at fixed parameters, in order of series and rank."""
    picked = slice_runs(runs, reg, alpha, max_iter, max_rank)
    if engine is not None:
        picked = by_engine(picked, engine)
    # Sorting and skipping read the slice several times; the logs are parsed once.
    curve = materialize(picked.select("series", "Rank", metric), "series")
    return skip_first(curve, skip, ["Rank"]).orderBy("series", "Rank", metric)


def bias_series(runs: DataFrame, items: bool = True, users: bool = False) -> DataFrame:
    """(series, damping, Metric) of the runs with these flags."""
    return slice_bias(runs, items, users).select("series", "damping", "Metric").orderBy("series", "damping")


def best_run(runs: DataFrame, metric: str = "Metric", order: tuple[str, ...] = ("run_no",)) -> DataFrame:
    """The run with the highest metric, the earliest one among equals; nulls come last."""
    return runs.orderBy(F.desc(metric), *[F.asc_nulls_last(c) for c in order]).limit(1)
