import duckdb
import numpy as np
import pytest
from oracle_check import mismatch
from pyspark.sql import functions as F

from tasteline.functions.labels import MAP_TAGS, log_name
from tasteline.operators import runs, tags
from tasteline.plans.oracle import ORACLE_SQL
from tasteline.session import scratch_path
from tasteline.sources import runlog, starschema, tables


@pytest.fixture(scope="module")
def log_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    line = "With Rank:{}, Reg:1, Alpha:1, Maxiter:{}, Metric: {}, time TTL: {}, fit: 1.5, rec: 0.25, evl: 3e-05\n"
    spark_lines = [line.format(r, 5, r / 1000, r * 2.0) for r in (190, 100, 130, 160)]
    (folder / "stats_0_25.txt").write_text("launcher.py -f kernel.json\n\n" + "".join(spark_lines) + line.format(50, 10, 9, 9))
    (folder / "stats_1_0.txt").write_text("".join(line.format(r, 5, 0.5, 7.0) for r in (100, 100, 100)))
    (folder / "stats_lenskit_0_01.txt").write_text(line.format(340, 5, 0.2, 1.0) + line.format(310, 5, 0.1, 1.0))
    bias_line = "items:{}, users:{}, damping:{}, Metric: {}, time TTL: 4.0, fit: 1.0, rec: 1.0, evl: 2.0\n"
    other = tmp_path_factory.mktemp("bias")
    (other / "stats_lenskit_1_0.txt").write_text(
        "launcher.py\n"
        + bias_line.format(True, False, 10, 0.25)
        + bias_line.format(True, False, 0.1, 0.5)
        + bias_line.format(False, False, 0.0, 0.125)
        + bias_line.format(True, True, 1000000000, 0.75)
    )
    return str(folder), str(other)


def bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_als_log(spark, log_dir):
    lines = runlog.read_logs(spark, log_dir[0] + "/*.txt")
    assert [r[0] for r in runlog.log_names(lines).collect()] == ["stats_0_25", "stats_1_0", "stats_lenskit_0_01"]
    parsed = runs.parse_als_runs(lines)
    assert parsed.count() == 10
    first = runs.sort_runs(runs.by_engine(parsed, "spark 0.25"), "Rank").collect()
    assert [r["Rank"] for r in first] == [50, 100, 130, 160, 190]
    assert tuple(first[1]) == ("spark 0.25", 100.0, 1.0, 1.0, 5.0, 0.1, 200.0, 1.5, 0.25, 3e-05)


def test_series(spark, log_dir):
    parsed = runs.parse_als_runs(runlog.read_logs(spark, log_dir[0]))
    metric = [tuple(r) for r in runs.series(parsed).collect()]
    assert metric[:4] == [("spark 0.25", float(r), r / 1000) for r in (100, 130, 160, 190)]
    assert metric[4:] == [("spark 1.0", 100.0, 0.5)] * 3
    late = [tuple(r) for r in runs.series(parsed, "Time_TTL", skip=2).collect()]
    assert late == [("spark 0.25", 160.0, 320.0), ("spark 0.25", 190.0, 380.0), ("spark 1.0", 100.0, 7.0)]
    capped = runs.series(parsed, engine=None, max_rank=310)
    assert [r["Rank"] for r in capped.where("series = 'lenskit 0.01'").collect()] == [310]
    assert runs.series(parsed, engine=None, skip=5).count() == 0


def test_bias_log(spark, log_dir):
    parsed = runs.parse_bias_runs(runlog.read_logs(spark, log_dir[1]))
    assert [f.dataType.simpleString() for f in parsed.schema][:4] == ["string", "boolean", "boolean", "double"]
    assert [tuple(r) for r in runs.bias_series(parsed).collect()] == [("lenskit 1.0", 0.1, 0.5), ("lenskit 1.0", 10.0, 0.25)]
    assert bag(runs.bias_series(parsed, False, False)) == [("lenskit 1.0", 0.0, 0.125)]
    assert bag(runs.bias_series(parsed, True, True)) == [("lenskit 1.0", 1e9, 0.75)]


def test_records_as_text_and_back(spark):
    rows = [(0, 100.0, 1.0, 1.0, 5.0, 10, 10, 0.0125, 30.5, 20.25, 4.0, 6.25), (1, 200.0, 10.0, 80.0, 10.0, 8, 4, 1e-05, 1.0, 0.5, 0.25, 0.25)]
    df = spark.createDataFrame(rows, runlog.ALS_SCHEMA)
    path = scratch_path(spark, "text")
    lines = df.select(F.lit("stats_1_0").alias("log"), runlog.als_line().alias("value"))
    assert lines.first()["value"] == (
        "With Rank:100.0, Reg:1.0, Alpha:1.0, Maxiter:5.0, Metric: 0.0125, time TTL: 30.5, fit: 20.25, rec: 4.0, evl: 6.25"
    )
    runlog.write_logs(lines, path)
    back = runs.parse_als_runs(runlog.read_logs(spark, path))
    assert bag(back.drop("series")) == bag(df.drop("run_no", "User_blocks", "Item_blocks"))


def test_last_name_in_a_path_counts(spark):
    paths = ["/data/stats_logs/stats_0_25.txt", "/stats_a/log=stats_1_0/part-0.txt", "stats_lenskit_0_01.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(log_name(F.col("p")))
    assert [r[0] for r in df.collect()] == ["stats_0_25", "stats_1_0", "stats_lenskit_0_01"]


def test_broken_record_fails(spark):
    whole = "With Rank:{}, Reg:1, Alpha:1, Maxiter:5, Metric: 0.5, time TTL: 1, fit: 1, rec: 1, evl: 1"
    for line in (whole.format("ten"), "With Rank:10, Reg:1"):
        lines = spark.createDataFrame([("stats_1_0", line)], "log string, value string")
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            runs.parse_als_runs(lines).collect()


def test_missing_values_in_a_log_are_null(spark, tmp_path):
    """Every field but the order key is null once; of two best records the one without a rank comes last."""
    whole = (1, 3, 2, 4.0, 50.0, 0.25, 0.5, "A", "O")
    rows = [tuple(None if i == n > 0 else x for i, x in enumerate(whole)) for n in range(len(whole))]
    kinds = ("l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string")  # fmt: skip
    rows += [(1, 3, 2, None, 50.0, 0.75, 0.5, "A", "O"), (1, 3, 2, 9.0, 50.0, 0.75, 0.5, "A", "O")]
    con = duckdb.connect()
    for name, (values, schema) in {"lineitem": (rows, kinds), "orders": ([(1, 1)], "o_orderkey long, o_custkey long")}.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    logs = scratch_path(spark, "logs")
    runlog.write_logs(starschema.run_log_lines(spark, str(tmp_path)), logs)
    parsed = runs.parse_als_runs(runlog.read_logs(spark, logs))
    assert mismatch(con, ORACLE_SQL["als_runs"], runs.sort_runs(parsed, "Rank")) is None
    best = runs.best_run(parsed, order=("series", "Rank"))
    assert mismatch(con, ORACLE_SQL["best_run"], best) is None
    assert best.first()["Rank"] == 90.0


def test_skipped_runs_with_nulls(spark):
    """Nulls come last, and of equal rows as many stay as lie beyond the skipped ones."""
    rows = [("s", None, 0.1), ("s", 2.0, None), ("s", 1.0, 0.5), ("s", None, 0.1), ("s", 2.0, 0.5)]
    curve = spark.createDataFrame(rows, "series string, Rank double, Metric double")
    left = {n: sorted([tuple(r) for r in runs.skip_first(curve, n, ["Rank"]).collect()], key=str) for n in (2, 4, 5)}
    assert left == {2: [("s", 2.0, None), ("s", None, 0.1), ("s", None, 0.1)], 4: [("s", None, 0.1)], 5: []}


@pytest.fixture(scope="module")
def music(spark):
    tracks = spark.createDataFrame([("t1", "a1"), ("t1", "a1"), ("t2", "a2"), ("t3", "a3"), ("t4", "a1")], "track_id string, artist_id string")
    artist_tags = spark.createDataFrame(
        [("a1", "jazz and blues"), ("a1", "folk"), ("a2", "metal"), ("a9", "folk")], "artist_id string, mbtag string"
    )
    codes = spark.createDataFrame([("t1", 0), ("t2", 1), ("t3", 2), ("t4", 3)], "track_id string, track_index int")
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [2.0, 2.0])], "id int, features array<float>")
    return tracks, artist_tags, codes, vectors


def test_tag_table(spark, music):
    tagged = tags.tag_embedding(*music)
    rows = {r["track_id"]: r for r in tagged.collect()}
    assert set(rows) == {"t1", "t2", "t4"} and tagged.count() == 3
    assert rows["t1"]["mbtag"] == rows["t4"]["mbtag"] and rows["t1"]["mbtag"] in ("folk", "jazz and blues")
    assert rows["t2"]["n_features"] == 2
    again = tags.tag_embedding(*(df.repartition(3) for df in music))
    assert {r["track_id"]: r["mbtag"] for r in again.collect()} == {k: v["mbtag"] for k, v in rows.items()}
    assert bag(tags.tag_counts(tagged)) == sorted([("metal", 1), (rows["t1"]["mbtag"], 2)])
    assert tags.tag_counts(tagged).first()["n_tracks"] == 2
    assert tags.n_tags(tagged).first()["n_tags"] == 2


def test_map_sample_labels(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*MAP_TAGS, "pop"] * 20)], "track_index int, mbtag string")
    sample = tags.map_sample(df, n=100)
    assert sample.count() == 100 and sample.where("mbtag = 'pop'").isEmpty()
    assert {r["mbtag"]: r["mbtag_with_order"] for r in tags.map_sample(df).collect()} == {
        t: f"{i}_{t}" for i, t in enumerate(MAP_TAGS)
    }


def test_projection_is_the_principal_plane(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(200, 6)) * np.array([9, 5, 1, 1, 0.5, 0.1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "track_index int, features array<float>")
    got = np.array([(r["x"], r["y"]) for r in tags.project_2d(df).orderBy("track_index").collect()])
    _, _, axes = np.linalg.svd(points - points.mean(axis=0), full_matrices=False)
    expected = points @ axes[:2].T
    for i in range(2):
        assert min(np.abs(got[:, i] - s * expected[:, i]).max() for s in (1, -1)) < 1e-3


def trustworthiness(points, places, k=10):
    """1 if all k neighbours on the map are neighbours of the points too, less by how far down they rank there."""
    n = len(points)
    apart = [((m[:, None] - m[None, :]) ** 2).sum(axis=2) for m in (points, places)]
    for d in apart:
        np.fill_diagonal(d, np.inf)
    rank = np.argsort(np.argsort(apart[0], axis=1), axis=1) + 1
    near = np.argsort(apart[1], axis=1)[:, :k]
    lost = np.maximum(np.take_along_axis(rank, near, axis=1) - k, 0).sum()
    return 1 - 2 * lost / (n * k * (2 * n - 3 * k - 1))


def test_map_keeps_neighbours(spark):
    """Groups in many dimensions, which no plane shows, stay together on the map."""
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=12) * 4 + rng.normal(size=(10, 12)) for _ in range(30)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    df = spark.createDataFrame(rows, "track_index int, features array<float>").repartition(3)
    graph = {}
    for r in tags.neighbour_graph(df, 5, block_rows=64).collect():
        graph.setdefault(r.track_index, {})[r.pos] = (r.other, r.distance2)
    apart = ((points[:, None].astype(float) - points[None, :]) ** 2).sum(axis=2)
    np.fill_diagonal(apart, np.inf)
    for i, near in graph.items():
        assert [near[p][0] for p in range(1, 6)] == list(np.argsort(apart[i])[:5])
        assert near[1][1] == pytest.approx(apart[i].min(), rel=1e-3)

    def places(frame):
        return np.array([(r.x, r.y) for r in frame.orderBy("track_index").collect()])

    flat, kept = places(tags.project_2d(df)), places(tags.project_neighbours(df, epochs=15))
    assert trustworthiness(points, kept, 8) > trustworthiness(points, flat, 8) + 0.02
    again = places(tags.project_neighbours(df.repartition(5), epochs=15))
    assert np.abs(again - kept).max() < 0.05
    few = spark.createDataFrame(rows[:2], "track_index int, features array<float>")
    assert tags.project_neighbours(few).count() == 2


def test_tables(spark, sf_dir, tmp_path):
    df = spark.createDataFrame([("u", 1, "t")], "user_id string, count int, track_id string")
    for name in tables.SPLIT_FILES.values():
        tables.save(df, f"{tmp_path}/{name}")
    splits = tables.load_splits(spark, str(tmp_path))
    assert bag(tables.split_counts(splits)) == [("test", 1), ("train", 1), ("validation", 1)]
    coded = df.withColumns({"user_index": F.lit(0), "track_index": F.lit(0)})
    for _ in range(2):
        tables.save_encoded(tables.Splits(coded, coded, coded), str(tmp_path))
    assert bag(tables.load_train(spark, str(tmp_path))) == bag(coded)
    tables.register(df, "zz_plays")
    names = [r["name"] for r in tables.list_tables(spark).collect()]
    assert "zz_plays" in names and names == sorted(names)
    assert bag(tables.load_tracks(spark, f"{tmp_path}/cf_train.parquet")) == [("u", 1, "t")]
    tables.save(spark.createDataFrame([("a", "folk", 3)], "artist_id string, mbtag string, x int"), f"{tmp_path}/tags")
    assert tables.load_artist_tags(spark, f"{tmp_path}/tags").columns == ["artist_id", "mbtag"]
