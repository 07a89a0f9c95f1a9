"""Top-k lists from scores that are the same for all users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.operators.metrics import pair_lists, user_hits
from tasteline.operators.numbering import number_rows
from tasteline.operators.skew import heavy_keys, top_k
from tasteline.operators.toplists import collect_best
from tasteline.session import materialize

HEADROOM = 4096
# Rows of common lists sent to all executors; more are joined by shuffles, in the same plan.
MOST_BROADCAST = 100_000
_SCORES = ["run_no", "track_index", "rating"]
_STEP = 1000


def recommend_shared(
    scores: DataFrame,
    users: DataFrame,
    k: int,
    runs: list[int],
    seen: DataFrame | None = None,
    headroom: int = HEADROOM,
) -> DataFrame:
    """(run_no, user_index, recommendations) from ``scores`` (run_no, track_index, rating).

    A user with s seen tracks needs only the first k + s of the common list.
    The first k + ``headroom`` tracks of each run, a size fixed by the arguments,
    are sent to all executors; of the seen tracks only the places in that list
    are shuffled, never a (user, track) candidate. Users with more than
    ``headroom`` seen tracks are served from the whole order, see below.
    """
    users = _spread(users)
    light, light_seen, heavy, heavy_seen = _by_seen(users, seen, headroom)
    length = k if seen is None else k + headroom
    head = _head(scores, length, len(runs))
    entries = F.sort_array(F.collect_list(F.struct("pos", "track_index", "rating")))
    common = head.groupBy("run_no").agg(entries.alias("_e")).select(
        "run_no", F.col("_e.track_index").alias("_tracks"), F.col("_e.rating").alias("_ratings")
    )
    rows = _wanted(light, runs)
    if seen is not None:
        rows = _repartitioned(rows.unionByName(_places(light_seen, light, head, len(runs) * length)))
    taken = rows.groupBy("run_no", "user_index").agg(F.collect_set("pos").alias("_taken"))
    places = F.sequence(F.lit(1), F.least(F.size("_tracks"), F.lit(k) + F.size("_taken")))
    left = F.slice(F.array_except(F.when(F.size("_tracks") > 0, places), F.col("_taken")), 1, k)
    lists = taken.join(_small(common, len(runs) * length), "run_no").select(
        "run_no",
        "user_index",
        F.transform(
            left,
            lambda pos: F.struct(
                F.get("_tracks", pos - 1).alias("track_index"), F.get("_ratings", pos - 1).alias("rating")
            ),
        ).alias("recommendations"),
    )
    if heavy is None:
        return lists
    return lists.unionByName(_from_order(scores, heavy, k, runs, heavy_seen))


def shared_hits(
    scores: DataFrame,
    users: DataFrame,
    truth: DataFrame,
    k: int,
    runs: list[int],
    seen: DataFrame,
    headroom: int = HEADROOM,
) -> DataFrame:
    """(run_no, user_index, hits, n_truth, n_predicted) of the lists of ``recommend_shared``.

    The lists need not be built for that: a truth track's place in a user's list
    is its place in the common list less the number of seen tracks before it. So
    a search over many runs moves seen and truth places only, not k entries per
    user and run.
    """
    users = _spread(users)
    light, light_seen, heavy, heavy_seen = _by_seen(users, seen, headroom)
    size = len(runs) * (k + headroom)
    head = _head(scores, k + headroom, len(runs))
    sizes = truth.groupBy("user_index").agg(F.sum(F.size(F.array_distinct("tracks"))).alias("n_truth"))
    true_rows = truth.select("user_index", F.explode("tracks").alias("track_index"))
    none = F.lit(None).cast("int")
    rows = (
        _wanted(light, runs)
        .unionByName(_places(light_seen, light, head, size))
        .withColumn("_true", none)
        .unionByName(
            _places(true_rows, light, head, size).select(
                "user_index", "run_no", none.alias("pos"), F.col("pos").alias("_true")
            )
        )
    )
    lengths = head.groupBy("run_no").agg(F.count("*").alias("_length"))
    marked = (
        _repartitioned(rows)
        .groupBy("run_no", "user_index")
        .agg(F.collect_set("pos").alias("_taken"), F.collect_set("_true").alias("_true"))
        .join(F.broadcast(lengths), "run_no")
    )
    place = _places_left("_taken", "_true")
    hits = marked.select(
        "run_no",
        "user_index",
        F.filter(place, lambda p: p <= k).alias("hits"),
        F.least(F.lit(k), F.col("_length") - F.size("_taken")).cast("int").alias("n_predicted"),
    ).join(sizes, "user_index")
    columns = ["run_no", "user_index", "hits", "n_truth", "n_predicted"]
    if heavy is None:
        return hits.select(*columns)
    lists = _from_order(scores, heavy, k, runs, heavy_seen)
    deep = user_hits(pair_lists(lists, truth, ("run_no",)), ("run_no",))
    return hits.select(*columns).unionByName(deep.select(*columns))


def _places_left(taken: str, true: str) -> Column:
    """Rising places that the ``true`` places have once the ``taken`` ones are out; those in both go too.

    Both are sorted into one list, a true place as an odd number. The i-th entry
    of the list that is the j-th true one has i - j taken ones before it, so one
    sort does, whatever the lengths.
    """
    entries = F.sort_array(
        F.concat(
            F.transform(taken, lambda p: 2 * p.cast("long")),
            F.transform(F.array_except(true, taken), lambda p: 2 * p.cast("long") + 1),
        )
    )
    numbered = F.transform(entries, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    odd = F.filter(numbered, lambda e: e["x"] % 2 == 1)
    return F.transform(odd, lambda e, j: (F.shiftright(e["x"], 1) - (e["i"] - j)).cast("int"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A frame made of ``rows`` rows, broadcast if these are few, else left to the planner."""
    return F.broadcast(df) if rows <= MOST_BROADCAST else df


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _spread(users: DataFrame) -> DataFrame:
    """Distinct users in a fixed number of partitions.

    A user's rows are few, but each grows to k entries: the number of tasks must
    not follow from the small input.
    """
    return users.select("user_index").repartition(_tasks(users), "user_index").distinct()


def _repartitioned(rows: DataFrame) -> DataFrame:
    return rows.repartition(_tasks(rows), "user_index")


def _by_seen(users: DataFrame, seen: DataFrame | None, headroom: int) -> tuple:
    """Users with at most ``headroom`` seen tracks and the others, or None for these."""
    if seen is None:
        return users, None, None, None
    seen = seen.select("user_index", "track_index")
    heavy = heavy_keys(seen, "user_index", headroom)
    if heavy is None:
        return users, seen, None, None
    return (
        users.join(heavy, "user_index", "left_anti"),
        seen.join(heavy, "user_index", "left_anti"),
        users.join(heavy, "user_index", "left_semi"),
        seen.join(heavy, "user_index", "left_semi"),
    )


def _head(scores: DataFrame, length: int, runs: int) -> DataFrame:
    """The first ``length`` tracks of each run with their place; written out if the runs are too many to broadcast."""
    head = top_k(scores.select(*_SCORES), ["run_no"], [F.desc("rating"), F.asc("track_index")], length)
    return head if runs * length <= MOST_BROADCAST else materialize(head, "shared-head")


def _wanted(users: DataFrame, runs: list[int]) -> DataFrame:
    return users.select("user_index", F.explode(F.lit(runs)).alias("run_no"), F.lit(None).cast("int").alias("pos"))


def _places(rows: DataFrame, users: DataFrame, head: DataFrame, size: int) -> DataFrame:
    """(user_index, run_no, pos) of the users' rows found in the head of a run.

    The head has a size fixed by the arguments; up to MOST_BROADCAST rows it is
    broadcast, beyond them it is joined by track.
    """
    found = rows.join(_small(head.select("run_no", "track_index", "pos"), size), "track_index")
    return found.join(users, "user_index", "left_semi").select("user_index", "run_no", "pos")


def _from_order(scores: DataFrame, users: DataFrame, k: int, runs: list[int], seen: DataFrame) -> DataFrame:
    """Lists of users with very many seen tracks, who may also have none left.

    All tracks of a run are numbered in order. A user with s seen tracks is
    joined with the first k + s of them, so the candidates of all such users are
    no more than a constant times their seen rows. They are made in steps, by
    many tasks for one user.
    """
    by_score = [F.asc("run_no"), F.desc("rating"), F.asc("track_index")]
    numbered = number_rows(scores.select(*_SCORES), by_score, "shared-order")
    # One row per run.
    ends = numbered.groupBy("run_no").agg(F.min("number").alias("_start"), F.count("*").alias("_n"))
    order = numbered.join(F.broadcast(ends), "run_no").select(
        *_SCORES, (F.col("number") - F.col("_start") + 1).alias("pos")
    )
    wanted = _wanted(users, runs).drop("pos")
    counts = seen.groupBy("user_index").agg(F.count("*").alias("_s"))
    length = F.least(F.col("_n"), F.col("_s") + k)
    steps = (
        wanted.join(counts, "user_index")
        .join(F.broadcast(ends), "run_no")
        .select("user_index", "run_no", length.alias("_length"))
        .withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_length"), F.lit(_STEP).cast("long"))))
        .repartition(_tasks(scores), "user_index", "run_no", "_from")
    )
    last = F.least(F.col("_length"), F.col("_from") + _STEP - 1)
    places = steps.select("user_index", "run_no", F.explode(F.sequence(F.col("_from"), last)).alias("pos"))
    left = (
        places.join(order, ["run_no", "pos"])
        .drop("pos")
        .join(seen, ["user_index", "track_index"], "left_anti")
    )
    best = collect_best(left, k, ("run_no",))
    nothing = F.array().cast(best.schema["recommendations"].dataType)
    return wanted.join(best, ["run_no", "user_index"], "left").withColumn(
        "recommendations", F.coalesce("recommendations", nothing)
    )
