"""Named queries over the order/part tables, one or more per operator.

Raw tables are turned into play-count triples and encoded once per session and
data folder (``workspace``); the queries then read those tables, whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteline.operators import als, bias, encode, joins, metrics, runs, sampling, tags, truth, toplists
from tasteline.operators.als import AlsParams
from tasteline.operators.bias import BiasPoint
from tasteline.plans import prepare, tune
from tasteline.session import scratch_path
from tasteline.sources import models, runlog, starschema, tables
from tasteline.sources.tables import Splits

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
# List length and cut, damping grid, factor-model grid, sample sizes.
TOP = 500
DAMPINGS = [10.0**i for i in range(-1, 10)]
BIAS_GRID = [BiasPoint(items, users, d) for items, users, d in tune.param_grid([True], [False], DAMPINGS)]
BIAS_GRID.append(BiasPoint(False, False, 0.0))
ALS_GRID = [AlsParams(*p) for p in tune.param_grid([10, 20, 30], [1.0], [1.0], [5])]
FRACTION = 0.25
SMALL_FRACTION = 0.05
DAMPING = 10.0
# Pairs are split by their keys, so all of a user's few pairs may miss the train
# split; such a user has no code, and the SQL's joins leave its rows out.
UNSEEN = "drop"
MAP_TYPES = ["STANDARD", "ECONOMY", "PROMO"]
MAP_ROWS = 4_000
GIVEN_BLOCK_ROWS = 4096
# Small enough for several waves also on small tables.
ITEM_BLOCK_ROWS = 512

_WORKSPACES: dict[tuple[str, str], str] = {}
_BIAS_LOGS: dict[str, str] = {}
_METADATA: dict[str, str] = {}
_ALS_RUNS: dict[str, str] = {}
_LOGS: dict[str, str] = {}
_METADATA: dict[str, str] = {}


def workspace(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the prepared tables of ``sf_dir``, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WORKSPACES:
        path = scratch_path(spark, "workspace")
        tables.save(starschema.interactions(spark, sf_dir), f"{path}/interactions", partition_by="split")
        prepare.prepare(_raw_at(spark, path), path, UNSEEN)
        _WORKSPACES[key] = path
    return _WORKSPACES[key]


def _raw_at(spark: SparkSession, path: str) -> Splits:
    return tables.load_splits(spark, f"{path}/interactions", {name: f"split={name}" for name in Splits._fields})


def _raw(spark: SparkSession, sf_dir: str) -> Splits:
    return _raw_at(spark, workspace(spark, sf_dir))


def _encoded(spark: SparkSession, sf_dir: str) -> Splits:
    return tables.load_encoded(spark, workspace(spark, sf_dir))


def _truth(spark: SparkSession, sf_dir: str, split: str = "validation") -> DataFrame:
    return tables.load_truth(spark, f"{workspace(spark, sf_dir)}/truth_{split}.parquet")


def _users(spark: SparkSession, sf_dir: str, split: str = "validation") -> DataFrame:
    return prepare.eval_users(spark, workspace(spark, sf_dir), split)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# Loading, encoding, truth lists


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return starschema.interactions(spark, sf_dir)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.split_counts(starschema.interaction_splits(spark, sf_dir))


def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered tables by name, with the number of rows of each."""
    counts = None
    for name in TABLES:
        df = tables.register(starschema.table(spark, sf_dir, name), name)
        n = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        counts = n if counts is None else counts.union(n)
    return tables.list_tables(spark).join(counts, "name").orderBy("name")


def user_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.fit_user_codes(_raw(spark, sf_dir).train)


def track_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.fit_track_codes(_raw(spark, sf_dir))


def arbitrary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = joins.id_universe("track_id", *_raw(spark, sf_dir))
    code = F.col("track_index")
    return encode.fit_codes(ids, "track_id", "track_index", ordered=False).agg(
        F.count("*").alias("n_codes"),
        F.min(code).alias("least"),
        F.max(code).alias("greatest"),
        F.countDistinct(code).alias("n_distinct"),
    )


def track_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.id_universe("track_id", *_raw(spark, sf_dir))


def encoding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _encoded(spark, sf_dir).stacked()
    return encode.encoding_table(rows, "track_id", "track_index")


def _encode_split(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    path = workspace(spark, sf_dir)
    rows = getattr(_raw(spark, sf_dir), split)
    coded = encode.encode(rows, prepare.user_encoding(spark, path), prepare.track_encoding(spark, path), UNSEEN)
    return encode.cast_index(coded, "user_index", "track_index")


def encoded_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_split(spark, sf_dir, "validation")


def encoded_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encode_split(spark, sf_dir, "test")


def encoded_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows with codes fitted on a part of the users: the others get null."""
    raw = _raw(spark, sf_dir)
    drawn = sampling.subsample_eval_users(
        joins.distinct_ids(raw.train, "user_id"), FRACTION, key="user_id"
    )
    codes = encode.fit_codes(drawn, "user_id", "user_index")
    return encode.attach_codes(raw.validation, codes, "user_id", "user_index", unseen="keep")


def eval_user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.distinct_ids(_encoded(spark, sf_dir).validation, "user_index")


def truth_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth.truth_positions(_encoded(spark, sf_dir).validation)


def truth_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists as saved and read back, one row per entry."""
    return truth.flat_truth(_truth(spark, sf_dir, "test"))


# Joins, set operations, samples


def _val_users(raw: Splits) -> DataFrame:
    return joins.distinct_ids(raw.validation, "user_id")


def restrict_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return joins.restrict_users(raw.train, _val_users(raw))


def rows_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return joins.rows_of_users(raw.train, _val_users(raw), ["user_id", "count", "track_id"])


def rows_not_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return joins.rows_not_of_users(raw.train, _val_users(raw), ["user_id", "count", "track_id"])


def rows_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    columns = ["user_id", "count", "track_id"]
    return joins.rows_except(raw.train.select(*columns), joins.rows_of_users(raw.train, _val_users(raw), columns))


def subsample_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeps the validation users and a quarter of all users."""
    raw = _raw(spark, sf_dir)
    return sampling.subsample_users(raw.train, _val_users(raw), FRACTION, seed=7)


def subsample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return sampling.subsample_rows(raw.train, _val_users(raw), FRACTION)


def subsample_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return sampling.subsample_rows(raw.train, _val_users(raw), SMALL_FRACTION, dedup=True)


def eval_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.subsample_eval_users(_users(spark, sf_dir), 0.01)


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-level subsample, written under its fraction and read back."""
    path = workspace(spark, sf_dir)
    prepare.subsample(spark, path, FRACTION)
    return tables.load_train(spark, path, FRACTION)


def preview_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _encoded(spark, sf_dir).train.select("user_index", "track_index", "count")
    return tables.preview(rows, 20, "user_index", "track_index")


# Baselines and metrics


def bias_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bias.fit_bias(_encoded(spark, sf_dir).train, BiasPoint(True, False, DAMPING))
    return _rounded(model.items.select("track_index", "item_bias"), "item_bias")


def bias_users_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bias.fit_bias(_encoded(spark, sf_dir).train, BiasPoint(True, True, DAMPING))
    return _rounded(model.users.select("user_index", "user_bias"), "user_bias")


def bias_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = _encoded(spark, sf_dir)
    model = bias.fit_bias(splits.train, BiasPoint(False, False, 0.0))
    pairs = splits.validation.select("user_index", "track_index")
    return _rounded(bias.predict_bias(model, pairs), "prediction")


def _bias_lists(spark: SparkSession, sf_dir: str, exclude_seen: bool, point: BiasPoint) -> DataFrame:
    train = _encoded(spark, sf_dir).train
    model = bias.fit_bias(train, point)
    return bias.recommend_bias(model, _users(spark, sf_dir), TOP, train if exclude_seen else None)


def bias_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _bias_lists(spark, sf_dir, False, BiasPoint(True, False, DAMPING))
    return _rounded(toplists.flat_lists(recs), "rating")


def bias_topk_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _bias_lists(spark, sf_dir, True, BiasPoint(True, True, DAMPING))
    return _rounded(toplists.flat_lists(recs), "rating")


def bias_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _bias_lists(spark, sf_dir, True, BiasPoint(True, False, DAMPING))
    scores = metrics.ranking_metrics(recs, _truth(spark, sf_dir), TOP)
    return _rounded(scores.select("n_users", "precision_at_k", "precision_list"), "precision_at_k", "precision_list")


def popularity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bias.popularity(_encoded(spark, sf_dir).train)


def popularity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _encoded(spark, sf_dir).train
    return toplists.flat_lists(bias.recommend_popular(train, _users(spark, sf_dir), TOP))


def ranking_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity lists without seen tracks, scored at 10 of 500."""
    train = _encoded(spark, sf_dir).train
    recs = bias.recommend_popular(train, _users(spark, sf_dir), TOP, by="n_users", exclude_seen=True)
    scores = metrics.ranking_metrics(recs, _truth(spark, sf_dir), 10)
    return _rounded(scores, *metrics.METRICS)


def rmse_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = _encoded(spark, sf_dir)
    model = bias.fit_bias(splits.train, BiasPoint(True, True, DAMPING))
    pairs = splits.validation.select("user_index", "track_index", "count")
    return _rounded(metrics.rmse(bias.predict_bias(model, pairs), "prediction", "count"), "rmse")


def bias_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _encoded(spark, sf_dir).train
    scores = tune.tune_bias(train, _truth(spark, sf_dir), _users(spark, sf_dir), BIAS_GRID, TOP)
    return _rounded(scores, "Metric")


# Factor models


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows for a fit, which refuses null counts.

    A pair without any known quantity counts as no play: it weighs nothing, and its
    user and track keep their factors, as the SQL has them.
    """
    return _encoded(spark, sf_dir).train.withColumn("count", F.coalesce("count", F.lit(0)))


def _model(spark: SparkSession, sf_dir: str) -> ALSModel:
    path = workspace(spark, sf_dir)
    return models.load_or_fit(spark, f"{path}/als_model", lambda: als.fit_als(_plays(spark, sf_dir), AlsParams()))


def _given(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A given vector for every validation user and every train track."""
    splits = _encoded(spark, sf_dir)
    users = joins.distinct_ids(splits.validation, "user_index").withColumnRenamed("user_index", "id")
    tracks = joins.distinct_ids(splits.train, "track_index").withColumnRenamed("track_index", "id")
    return starschema.whole_factors(spark, sf_dir, users), starschema.whole_factors(spark, sf_dir, tracks)


def factor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation pairs scored by given vectors."""
    pairs = _encoded(spark, sf_dir).validation.select("user_index", "track_index")
    return als.score_factors(pairs, *_given(spark, sf_dir))


def _factor_lists(spark: SparkSession, sf_dir: str, exclude_seen: bool) -> DataFrame:
    seen = _encoded(spark, sf_dir).train if exclude_seen else None
    recs = als.recommend_by(*_given(spark, sf_dir), _users(spark, sf_dir), TOP, seen, GIVEN_BLOCK_ROWS)
    return toplists.flat_lists(recs).withColumn("rating", F.col("rating").cast("double"))


def factor_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_lists(spark, sf_dir, False)


def factor_topk_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factor_lists(spark, sf_dir, True)


def _flat_items(recs: DataFrame) -> DataFrame:
    flat = recs.select("track_index", F.posexplode_outer("recommendations").alias("_i", "_r"))
    return flat.where(F.col("_i").isNotNull()).select(
        "track_index", (F.col("_i") + 1).alias("pos"), "_r.user_index", "_r.rating"
    )


def factor_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best validation users of every train track, by given vectors."""
    tracks = joins.distinct_ids(_encoded(spark, sf_dir).train, "track_index")
    recs = als.recommend_items_by(*_given(spark, sf_dir), tracks, 10, ITEM_BLOCK_ROWS)
    return _flat_items(recs).withColumn("rating", F.col("rating").cast("double"))


def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return als.item_factors(_model(spark, sf_dir)).withColumn("n_features", F.size("features"))


def als_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toplists.flat_lists(als.recommend(_model(spark, sf_dir), _users(spark, sf_dir), TOP))


def als_topk_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _encoded(spark, sf_dir).train
    return toplists.flat_lists(als.recommend(_model(spark, sf_dir), _users(spark, sf_dir), TOP, train))


def als_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best users of every validation track."""
    tracks = joins.distinct_ids(_encoded(spark, sf_dir).validation, "track_index")
    return _flat_items(als.recommend_items(_model(spark, sf_dir), tracks, 10))


def als_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _encoded(spark, sf_dir).validation.select("user_index", "track_index", "count")
    return als.score_pairs(_model(spark, sf_dir), pairs)


def als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rmse(als_score(spark, sf_dir), "prediction", "count")


def als_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.evaluate(_model(spark, sf_dir), _users(spark, sf_dir), _truth(spark, sf_dir), TOP)


def als_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.evaluate(
        _model(spark, sf_dir), _users(spark, sf_dir, "test"), _truth(spark, sf_dir, "test"), TOP
    )


def als_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of a small grid, searched once per workspace; the best model is saved on the way."""
    path = workspace(spark, sf_dir)
    if path not in _ALS_RUNS:
        runs_path = scratch_path(spark, "runs")
        train, truth_rows, users = _plays(spark, sf_dir), _truth(spark, sf_dir), _users(spark, sf_dir)
        tune.tune_als(train, truth_rows, users, ALS_GRID, TOP, runs_path, f"{path}/als_best", at_once=3)
        _ALS_RUNS[path] = runs_path
    return runlog.load_runs(spark, _ALS_RUNS[path]).orderBy("run_no")


# What can be said of fitted models without their values


def als_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and lengths of the track factors."""
    return als.item_factors(_model(spark, sf_dir)).select("id", F.size("features").alias("n_features"))


def als_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each user's list without seen tracks, distinct tracks and seen tracks in it, and its order."""
    train = _encoded(spark, sf_dir).train
    recs = als.recommend(_model(spark, sf_dir), _users(spark, sf_dir), TOP, train)
    seen = train.groupBy("user_index").agg(F.collect_set("track_index").alias("_seen"))
    listed, ratings = F.col("recommendations.track_index"), F.col("recommendations.rating")
    # Only the tracks move to the join, not the ratings.
    moved = recs.select(
        "user_index",
        listed.alias("_listed"),
        F.size(listed).alias("n_list"),
        F.size(F.array_distinct(listed)).alias("n_distinct"),
        (ratings == F.reverse(F.array_sort(ratings))).alias("falling"),
    )
    n_seen = F.size(F.array_intersect("_listed", "_seen")).alias("n_seen")
    return moved.join(seen, "user_index").select("user_index", "n_list", "n_distinct", n_seen, "falling")


def als_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation pairs whose score is the product of the exported factors."""
    model, pairs = _model(spark, sf_dir), _encoded(spark, sf_dir).validation.select("user_index", "track_index")
    scored = als.score_pairs(model, pairs).withColumnRenamed("prediction", "_model")
    both = als.score_factors(scored, als.user_factors(model), als.item_factors(model))
    close = F.abs(F.col("_model") - F.col("prediction")) <= 1e-4 * (1 + F.abs("prediction"))
    return both.select("user_index", "track_index", close.alias("agrees"))


def als_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train users solved anew from the track factors: the same vectors as the fit's, which ends with that step."""
    model, train = _model(spark, sf_dir), _plays(spark, sf_dir)
    folded = als.fold_in(train, als.item_factors(model), als.AlsParams())
    own = als.user_factors(model).select(F.col("id").alias("user_index"), F.col("features").alias("_own"))
    far = F.aggregate(
        F.zip_with("features", "_own", lambda x, y: F.abs(x - y)), F.lit(0.0).cast("float"), lambda a, x: F.greatest(a, x)
    )
    return folded.join(own, folded["id"] == own["user_index"]).select("user_index", (far < 1e-3).alias("agrees"))


def track_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train rows per item block of a fit on relabelled tracks."""
    train = _encoded(spark, sf_dir).train
    coded = train.join(als.spread_codes(train, "track_index"), "track_index")
    block = (F.col("code") % als.BLOCKS[1]).alias("block")
    return coded.groupBy(block).agg(F.count("*").alias("n_rows"))


def als_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors of a model, saved and loaded again, that are as they were."""
    model = _model(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    loaded = als.item_factors(models.load_model(path)).withColumnRenamed("features", "_again")
    return als.item_factors(model).join(loaded, "id").select("id", (F.col("features") == F.col("_again")).alias("same"))


def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of each run of the search, and whether its metric and times can be true."""
    parts = F.col("Time_fit") + F.col("Time_rec") + F.col("Time_evl")
    return als_tune(spark, sf_dir).select(
        "run_no",
        "Rank",
        "Reg",
        "Alpha",
        "Maxiter",
        "User_blocks",
        "Item_blocks",
        F.col("Metric").between(0, 1).alias("metric_ok"),
        (F.abs(parts - F.col("Time_TTL")) < 1e-6).alias("times_ok"),
    )


def als_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search's records as text log and back."""
    lines = als_tune(spark, sf_dir).select(F.lit("stats_1_0").alias("log"), runlog.als_line().alias("value"))
    path = scratch_path(spark, "als-logs")
    runlog.write_logs(lines, path)
    parsed = runs.parse_als_runs(runlog.read_logs(spark, path))
    return parsed.select("series", "Rank", "Reg", "Alpha", "Maxiter", F.col("Metric").between(0, 1).alias("metric_ok"))


# The test split


def bias_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damped-bias lists without seen tracks, all metrics on the test split."""
    train = _encoded(spark, sf_dir).train
    model = bias.fit_bias(train, BiasPoint(True, False, DAMPING))
    recs = bias.recommend_bias(model, _users(spark, sf_dir, "test"), TOP, train)
    return _rounded(metrics.ranking_metrics(recs, _truth(spark, sf_dir, "test"), TOP), *metrics.METRICS)


def popularity_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _encoded(spark, sf_dir).train
    recs = bias.recommend_popular(train, _users(spark, sf_dir, "test"), TOP, by="n_users", exclude_seen=True)
    return _rounded(metrics.ranking_metrics(recs, _truth(spark, sf_dir, "test"), 10), *metrics.METRICS)


# Tag map


def _metadata(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The song table and the table of artists' tags, written once per workspace."""
    path = workspace(spark, sf_dir)
    if path not in _METADATA:
        folder = scratch_path(spark, "metadata")
        starschema.tracks(spark, sf_dir).write.parquet(f"{folder}/tracks")
        starschema.artist_tags(spark, sf_dir).write.parquet(f"{folder}/artist_tags")
        _METADATA[path] = folder
    folder = _METADATA[path]
    return tables.load_tracks(spark, f"{folder}/tracks"), tables.load_artist_tags(spark, f"{folder}/artist_tags")


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tracks with a tag, their codes and a given vector each."""
    codes = prepare.track_encoding(spark, workspace(spark, sf_dir))
    vectors = starschema.whole_factors(spark, sf_dir, codes.select(F.col("track_index").alias("id")))
    return tags.tag_embedding(*_metadata(spark, sf_dir), codes, vectors)


def artist_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.one_tag_per_artist(_metadata(spark, sf_dir)[1])


def tag_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of the vectors, rounded, in one string."""
    rounded = F.transform("features", lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string"))
    columns = ["track_id", "track_index", "mbtag", "id", "n_features"]
    return _tagged(spark, sf_dir).select(*columns, F.array_join(rounded, " ").alias("millionths"))


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.tag_counts(_tagged(spark, sf_dir))


def n_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = tags.encode_tags(
        prepare.track_encoding(spark, workspace(spark, sf_dir)),
        tags.tracks_with_tag(*_metadata(spark, sf_dir)),
    )
    return tags.n_tags(coded)


def map_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = tags.map_sample(_tagged(spark, sf_dir), MAP_TYPES, MAP_ROWS)
    return sample.select("track_id", "track_index", "mbtag", "mbtag_with_order")


def map_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = tags.map_sample(_tagged(spark, sf_dir), MAP_TYPES, MAP_ROWS)
    return tags.project_2d(sample).select("track_index", "mbtag_with_order", "x", "y")


def map_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbour graph under the map."""
    sample = tags.map_sample(_tagged(spark, sf_dir), MAP_TYPES, MAP_ROWS)
    return tags.neighbour_graph(sample, block_rows=256)


def map_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map that keeps neighbours together."""
    sample = tags.map_sample(_tagged(spark, sf_dir), MAP_TYPES, MAP_ROWS)
    return tags.project_neighbours(sample).select("track_index", "mbtag_with_order", "x", "y")


# Run logs


def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the run logs, written once per workspace."""
    path = workspace(spark, sf_dir)
    if path not in _LOGS:
        logs = scratch_path(spark, "logs")
        runlog.write_logs(starschema.run_log_lines(spark, sf_dir), logs)
        _LOGS[path] = logs
    return runlog.read_logs(spark, _LOGS[path])


def _als_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.parse_als_runs(_log_lines(spark, sf_dir))


def als_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.sort_runs(_als_log(spark, sf_dir), "Rank")


def log_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.log_names(_log_lines(spark, sf_dir))


def series_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.series(_als_log(spark, sf_dir))


def series_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.series(_als_log(spark, sf_dir), "Time_TTL", skip=2)


def series_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.series(_als_log(spark, sf_dir), "Time_TTL", engine=None, skip=2)


def series_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.series(_als_log(spark, sf_dir), engine=None, max_rank=310)


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best metric of all log records, the earliest by the other fields."""
    order = ("series", "Rank", "Reg", "Alpha", "Maxiter", "Time_TTL", "Time_fit", "Time_rec", "Time_evl")
    return runs.best_run(_als_log(spark, sf_dir), order=order)


def _bias_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text log of a bias search, written once per workspace and parsed."""
    path = workspace(spark, sf_dir)
    if path not in _BIAS_LOGS:
        records = tune.timed_bias_runs(
            _encoded(spark, sf_dir).train, _truth(spark, sf_dir), _users(spark, sf_dir), BIAS_GRID, TOP
        )
        log = scratch_path(spark, "bias-logs")
        lines = records.select(F.lit("stats_lenskit_0_01").alias("log"), runlog.bias_line().alias("value"))
        runlog.write_logs(lines, log)
        _BIAS_LOGS[path] = log
    return runs.parse_bias_runs(runlog.read_logs(spark, _BIAS_LOGS[path]))


def bias_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = runs.sort_runs(_bias_log(spark, sf_dir), "items", "damping")
    return _rounded(parsed.select("series", "items", "users", "damping", "Metric"), "Metric")


def series_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(runs.bias_series(_bias_log(spark, sf_dir)), "Metric")


def series_no_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(runs.bias_series(_bias_log(spark, sf_dir), items=False, users=False), "Metric")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        interactions,
        split_counts,
        list_tables,
        user_codes,
        track_codes,
        arbitrary_codes,
        track_universe,
        encoding_pairs,
        encoded_val,
        encoded_test,
        encoded_left,
        eval_user_ids,
        truth_val,
        truth_test,
        restrict_users,
        rows_of_users,
        rows_not_of_users,
        rows_except,
        subsample_users,
        subsample_rows,
        subsample_except,
        eval_users,
        roundtrip,
        preview_top,
        bias_items,
        bias_users_items,
        bias_global,
        bias_topk,
        bias_topk_unseen,
        bias_precision,
        popularity_counts,
        popularity_topk,
        ranking_metrics,
        rmse_bias,
        bias_tune,
        factor_scores,
        factor_topk,
        factor_topk_unseen,
        factor_items,
        als_factors,
        als_topk,
        als_topk_unseen,
        als_items,
        als_score,
        als_rmse,
        als_metrics,
        als_test,
        als_tune,
        als_ids,
        als_lists,
        als_agree,
        als_folded,
        track_blocks,
        als_saved,
        als_grid,
        als_log,
        bias_test,
        popularity_test,
        artist_tag,
        tag_embedding,
        tag_counts,
        n_tags,
        map_sample,
        map_2d,
        map_edges,
        map_neighbours,
        als_runs,
        log_names,
        series_metric,
        series_time,
        series_all,
        series_capped,
        best_run,
        bias_runs,
        series_bias,
        series_no_flags,
    )
}
