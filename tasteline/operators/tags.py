"""Tracks with a tag and their learned vectors, for a two-dimensional map."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteline.functions.keys import hash_bucket
from tasteline.functions.labels import MAP_TAGS, ordered_tag
from tasteline.operators.blocks import BLOCK_ROWS, top_matches
from tasteline.operators.numbering import number_rows
from tasteline.operators.sampling import DEFAULT_SEED, sample_n
from tasteline.session import materialize

N_MAP_TRACKS = 4000


def one_row_per_track(tracks: DataFrame) -> DataFrame:
    """(track_id, artist_id), the least artist if a track has several rows."""
    return tracks.groupBy("track_id").agg(F.min("artist_id").alias("artist_id"))


def one_tag_per_artist(tags: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """(artist_id, mbtag) with one tag drawn per artist by hash."""
    draw = F.struct(hash_bucket("artist_id", "mbtag", seed=seed), F.col("mbtag"))
    return tags.groupBy("artist_id").agg(F.min_by("mbtag", draw).alias("mbtag"))


def tracks_with_tag(tracks: DataFrame, tags: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """(track_id, mbtag) of the tracks whose artist has a tag.

    The artists' tags are written first: an artist with very many tracks can then
    be split in the join, and a small table is broadcast by its known size.
    """
    chosen = materialize(one_tag_per_artist(tags, seed), "artist-tags")
    return one_row_per_track(tracks).join(chosen, "artist_id").select("track_id", "mbtag")


def encode_tags(track_codes: DataFrame, tagged: DataFrame) -> DataFrame:
    return track_codes.join(tagged, "track_id")


def tag_factors(coded: DataFrame, factors: DataFrame) -> DataFrame:
    return coded.join(factors, F.col("track_index") == F.col("id"))


def tag_embedding(
    tracks: DataFrame,
    tags: DataFrame,
    track_codes: DataFrame,
    factors: DataFrame,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """(track_id, track_index, mbtag, id, features, n_features)."""
    coded = encode_tags(track_codes, tracks_with_tag(tracks, tags, seed))
    return tag_factors(coded, factors).withColumn("n_features", F.size("features"))


def tag_counts(tagged: DataFrame) -> DataFrame:
    """Tracks per tag, most frequent first."""
    counted = tagged.groupBy("mbtag").agg(F.count("track_index").alias("n_tracks"))
    return counted.orderBy(F.desc("n_tracks"), "mbtag")


def n_tags(tagged: DataFrame) -> DataFrame:
    return tagged.agg(F.countDistinct("mbtag").alias("n_tags"))


def filter_tags(tagged: DataFrame, tags: list[str]) -> DataFrame:
    return tagged.where(F.col("mbtag").isin(tags))


def map_sample(
    tagged: DataFrame, tags: list[str] = MAP_TAGS, n: int = N_MAP_TRACKS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """``n`` tracks of the chosen tags with a label that sorts in tag order."""
    drawn = sample_n(filter_tags(tagged, tags), n, "track_index", seed)
    return drawn.withColumn("mbtag_with_order", ordered_tag(F.col("mbtag"), tags))


def project_2d(sample: DataFrame) -> DataFrame:
    """Add the two principal coordinates ``x`` and ``y`` of ``features``."""
    vectors = materialize(sample, "map-sample").withColumn("_v", array_to_vector("features"))
    fitted = PCA(k=2, inputCol="_v", outputCol="_xy").fit(vectors)
    xy = fitted.transform(vectors).withColumn("_xy", vector_to_array("_xy"))
    return xy.select(*sample.columns, F.col("_xy")[0].alias("x"), F.col("_xy")[1].alias("y"))


# Neighbours of a track in the graph, steps of the layout, and tracks drawn to push one away in a step.
NEIGHBOURS = 15
EPOCHS = 30
_PUSHES = 12


def neighbour_graph(sample: DataFrame, k: int = NEIGHBOURS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(track_index, other, pos, distance2): the ``k`` nearest other tracks of each, by squared distance.

    Nearest is what the scalar product with the squared length as one more
    dimension ranks first, so the graph comes from the same search as the top-k
    lists. Equal distances go by rising track.
    """
    own = sample.select(F.col("track_index").alias("id"), F.col("features").cast("array<float>").alias("features"))
    own = materialize(own, "graph-vectors")
    half = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / 2
    left = own.withColumn("features", F.array_append("features", F.lit(1.0).cast("float")))
    right = own.withColumn("features", F.array_append("features", (-half).cast("float")))
    itself = own.select("id", F.col("id").alias("other"))
    best = top_matches(left, right, k, itself, block_rows)
    near = best.join(own.select("id", (2 * half).alias("_own")), "id")
    flat = near.select(F.col("id").alias("track_index"), "_own", F.posexplode("matches").alias("_i", "_m"))
    return flat.select(
        "track_index",
        F.col("_m.id").alias("other"),
        (F.col("_i") + 1).alias("pos"),
        (F.col("_own") - 2 * F.col("_m.rating")).alias("distance2"),
    )


def _weighted(graph: DataFrame) -> DataFrame:
    """(a, b, w): both directions of each edge, its weight falling with the distance at the scale of the track's own."""
    scale = F.avg("distance2").over(Window.partitionBy("track_index"))
    one = graph.select("track_index", "other", F.exp(-F.col("distance2") / (scale + 1e-9)).alias("w"))
    both = one.toDF("a", "b", "w").union(one.select("other", "track_index", "w"))
    return both.groupBy("a", "b").agg(F.max("w").alias("w"))


def project_neighbours(
    sample: DataFrame, k: int = NEIGHBOURS, epochs: int = EPOCHS, seed: int = DEFAULT_SEED, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add coordinates ``x`` and ``y`` that keep the neighbours of ``features`` together.

    Starts from the principal coordinates. In every step the edges of the
    neighbour graph pull and some tracks drawn by a hash push; the step length
    falls to nothing. A step is a join of the edges with the places, and sums per
    track; places are written out after each, so a lost executor costs one step.
    The sample has a size fixed by its argument, so its places may be broadcast.
    The same sample and seed give the same map, up to the order of float sums.
    """
    flat = materialize(project_2d(sample).select("track_index", "x", "y"), "map-start")
    spread = flat.agg(F.stddev("x").alias("x"), F.stddev("y").alias("y"), F.count("*").alias("n")).first()
    n = spread["n"]
    if n < 3:
        return sample.join(flat, "track_index")
    unit = [max(spread[c] or 0.0, 1e-9) for c in ("x", "y")]
    jitter = [(F.pmod(F.xxhash64("track_index", F.lit(seed + i)), F.lit(1000)) / 1000 - 0.5) * 1e-2 for i in (0, 1)]
    start = flat.select("track_index", (F.col("x") / unit[0] * 4 + jitter[0]).alias("x"), (F.col("y") / unit[1] * 4 + jitter[1]).alias("y"))
    places = materialize(number_rows(start, [F.col("track_index")], "map-numbers"), "map-places")
    edges = materialize(_weighted(neighbour_graph(sample, min(k, n - 1), block_rows)), "map-edges")
    for epoch in range(epochs):
        step = 1 - epoch / epochs
        one = places.select(F.col("track_index").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
        two = places.select(F.col("track_index").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
        dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
        d2 = dx * dx + dy * dy
        pulled = edges.join(F.broadcast(one), "a").join(F.broadcast(two), "b")
        pull = 2 * F.col("w") / (1 + d2)
        draw = F.explode(F.sequence(F.lit(1), F.lit(_PUSHES)))
        drawn = places.select(F.col("track_index").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), draw.alias("s"))
        drawn = drawn.withColumn("number", F.pmod(F.xxhash64("a", "s", F.lit(seed + epoch)), F.lit(n)))
        met = drawn.join(F.broadcast(places.select("number", F.col("x").alias("bx"), F.col("y").alias("by"))), "number")
        push = -2 / ((0.05 + d2) * (1 + d2))

        def moved(f: Column, d: Column) -> Column:
            return F.greatest(F.lit(-4.0), F.least(F.lit(4.0), f * d))

        forces = pulled.select("a", moved(pull, dx).alias("fx"), moved(pull, dy).alias("fy")).union(
            met.select("a", moved(push, dx).alias("fx"), moved(push, dy).alias("fy"))
        )
        sums = forces.groupBy("a").agg(F.sum("fx").alias("fx"), F.sum("fy").alias("fy"))
        shift = 0.1 * step
        new = places.join(F.broadcast(sums), places["track_index"] == sums["a"], "left")
        places = materialize(
            new.select(
                "track_index",
                (F.col("x") + shift * F.coalesce("fx", F.lit(0.0))).alias("x"),
                (F.col("y") + shift * F.coalesce("fy", F.lit(0.0))).alias("y"),
                "number",
            ),
            "map-places",
        )
    return sample.join(places.drop("number"), "track_index")
