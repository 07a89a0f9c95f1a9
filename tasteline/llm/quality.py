"""Quality rules: fixed limits, then robust multivariate outliers per language and source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteline.llm.text import SPACE, without, words
from tasteline.session import materialize

# Characters counted as symbols, and words of a window.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Steps per natural-log unit (or per unit of a share) of a transformed statistic.
_SCALE = 1024
_BINS_PER_LOG = 32

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("z_words", "z_length", "z_symbols", "z_lines", "z_repeats")
P = len(FEATURES)

# Groups (a line of numbers each) up to which estimates are broadcast.
MOST_BROADCAST = 20_000


@dataclass(frozen=True)
class OutlierSpec:
    """Parameters of the outlier rule.

    ``cutoff`` bounds the squared distance: the 0.999 quantile of a chi-square
    with five degrees of freedom. ``floors`` are lower bounds of the standard
    deviations of the transformed statistics, given those before them. They only
    take the place of a smaller spread: in a group whose nearest half agrees in a
    statistic, a small difference rejects no document. Groups of fewer than
    ``least_rows`` documents are pooled by language, then all together; if even
    those are too few, they are judged by the estimate of all rows. Only where all
    rows are too few is no document an outlier.
    """

    cutoff: float = 20.515
    floors: tuple[float, ...] = (0.1, 0.1, 0.05, 0.1, 0.1)
    least_rows: int = 50
    steps: int = 5


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` (long) to the rows.

    All work stays inside the row: 8-word windows are compared by 64-bit hashes,
    which are put in order only in texts that repeat one. A null or blank text
    has zero of everything. Input columns of these names are replaced.
    """
    kept = without(docs, *STATS)
    w = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("_text")).withColumn("_words", words(F.col("_text")))
    source = F.coalesce(F.col("_text"), F.lit(""))
    bare = source
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c))
    lines = F.split(source, "\n")
    n = F.size("_words")
    windows = F.size("_h") - (WINDOW - 1)
    hashes = F.transform("_words", lambda x: F.xxhash64(x))
    w = w.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.octet_length(source) - F.octet_length(bare)).cast("long"),
            "_lines": F.filter(lines, lambda x: F.btrim(x, F.lit(SPACE)) != ""),
            "_h": hashes,
        }
    )
    none = F.array().cast("array<bigint>")
    grams = F.when(
        windows > 0,
        F.transform(
            F.sequence(F.lit(0), windows - 1),
            lambda i: F.xxhash64(*[F.get(F.col("_h"), i + j) for j in range(WINDOW)]),
        ),
    ).otherwise(none)
    w = w.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_g": grams,
        }
    )
    w = w.withColumn("_twice", F.size("_g") > F.size(F.array_distinct("_g")))
    placed = F.when(
        F.col("_twice"),
        F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("g"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    w = w.withColumn("_s", placed)
    at = F.col("_s")
    again = F.filter(
        F.transform(
            "_s",
            lambda x, i: F.when(
                (F.get(at, i - 1)["g"] == x["g"]) | (F.get(at, i + 1)["g"] == x["g"]), x["i"]
            ),
        ),
        lambda x: x.isNotNull(),
    )
    w = w.withColumn("_p", F.sort_array(again))
    place = F.col("_p")
    covered = F.aggregate(
        F.transform(
            "_p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(place, i + 1) - x, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda acc, x: acc + x,
    )
    return w.withColumn("n_repeat_words", covered).select("row.*", *STATS)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _whole(x: Column) -> Column:
    return F.round(x * _SCALE).cast("long")


def _transformed() -> dict[str, Column]:
    """Logs of sizes and ratios, as whole numbers so that sums don't depend on their order."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "z_words": _whole(F.log(n)),
        "z_length": _whole(F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n)),
        "z_symbols": _whole(F.log1p(10 * F.col("n_symbols") / n)),
        "z_lines": _whole(F.log1p(10 * F.col("n_dup_lines") / n)),
        "z_repeats": _whole(F.log1p(10 * F.col("n_repeat_words") / n)),
    }


def _grouped(rows: DataFrame, least: int) -> tuple[DataFrame, bool]:
    """Add the group whose estimates judge a row, null where all are too few; whether all rows judge those."""
    by = F.struct(F.col("lang").alias("lang"), F.col("source").alias("source"), F.lit(0).alias("level"))
    table = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pooled = Window.partitionBy("lang")
    few = F.col("n") < least
    table = table.withColumn("n1", F.sum(F.when(few, F.col("n"))).over(pooled))
    small = few & (F.col("n1") < least)
    # The rest of all languages.
    sums = table.agg(F.sum(F.when(small, F.col("n"))).alias("rest"), F.sum("n").alias("all")).first()
    rest = sums["rest"] or 0
    none = F.lit(None).cast("string")
    group = (
        F.when(~few, by)
        .when(~small, F.struct(F.col("lang"), none.alias("source"), F.lit(1).alias("level")))
        .when(F.lit(rest >= least), F.struct(none.alias("lang"), none.alias("source"), F.lit(2).alias("level")))
    )
    keys = table.select("lang", "source", F.xxhash64(group).alias("grp"), group.isNull().alias("none"))
    keys = keys.select("lang", "source", F.when(~F.col("none"), F.col("grp")).alias("grp"))
    keys = materialize(keys, "quality-groups")
    same = F.col("r.lang").eqNullSafe(F.col("k.lang")) & F.col("r.source").eqNullSafe(F.col("k.source"))
    return rows.alias("r").join(keys.alias("k"), same, "left").select("r.*", "k.grp"), 0 < rest < least <= sums["all"]


def _joined(rows: DataFrame, table: DataFrame, groups: int) -> DataFrame:
    """Rows with their group's line of ``table``; few groups are broadcast, others left to the planner."""
    return rows.join(F.broadcast(table) if groups <= MOST_BROADCAST else table, "grp")


def _medians(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Lower medians of whole-number columns per group, from counts per value."""
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("e")
    counts = rows.select("grp", entries).groupBy("grp", F.col("e.c").alias("c"), F.col("e.v").alias("v")).agg(
        F.count("*").alias("n")
    )
    upto = Window.partitionBy("grp", "c").orderBy("v")
    whole = Window.partitionBy("grp", "c")
    placed = counts.select(
        "grp", "c", "v", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("all")
    )
    middle = placed.where(2 * F.col("upto") >= F.col("all")).groupBy("grp", "c").agg(F.min("v").alias("v"))
    return middle.groupBy("grp").agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).alias(c) for c in columns])


def _factor(moments: DataFrame, spec: OutlierSpec) -> DataFrame:
    """Means ``m0..`` and Cholesky factor ``l00..`` of the covariances ``c00..`` of each group.

    ``f0..`` tell which diagonal entries are the floor, for want of a spread.
    """
    for i in range(P):
        floor = F.lit((spec.floors[i] * _SCALE) ** 2)
        for j in range(i + 1):
            dot = F.lit(0.0)
            for k in range(j):
                dot = dot + F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                left = F.col(f"c{i}{i}") - dot
                moments = moments.withColumn(f"f{i}", left <= floor)
                value = F.sqrt(F.greatest(left, floor))
            else:
                value = (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}")
            moments = moments.withColumn(f"l{i}{j}", value)
    kept = [f"{x}{i}" for x in "mf" for i in range(P)] + [f"l{i}{j}" for i in range(P) for j in range(i + 1)]
    return moments.select("grp", *kept)


def _distances(rows: DataFrame, shape: DataFrame, groups: int) -> DataFrame:
    """Squared Mahalanobis distance of each row under its group's estimate.

    ``d2`` is its whole, ``spread2`` the part on the ``axes`` that have a spread
    of their own.
    """
    out = _joined(rows, shape, groups)
    for i in range(P):
        dot = F.col(FEATURES[i]) - F.col(f"m{i}")
        for k in range(i):
            dot = dot - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", dot / F.col(f"l{i}{i}"))
    total, own, axes = F.lit(0.0), F.lit(0.0), F.lit(0)
    for i in range(P):
        square = F.col(f"y{i}") * F.col(f"y{i}")
        total = total + square
        own = own + F.when(F.col(f"f{i}"), 0.0).otherwise(square)
        axes = axes + F.when(F.col(f"f{i}"), 0).otherwise(1)
    return out.select(*rows.columns, total.alias("d2"), own.alias("spread2"), axes.alias("axes"))


def _bin(d2: Column) -> Column:
    """Whole-number scale of distances, a thirty-second of a log unit wide."""
    return F.floor(F.log(d2 + 1e-3) * _BINS_PER_LOG).cast("long")


def _concentrate(rows: DataFrame, shape: DataFrame, groups: int, spec: OutlierSpec) -> DataFrame:
    """One concentration step: moments of the half of each group nearest to its estimate.

    Moments are summed per distance bin, so one pass finds both where the nearest
    half ends and its means and covariances; the half is rounded up to whole bins.
    """
    near = _distances(rows, shape, groups).withColumn("bin", _bin(F.col("d2")))
    sums = [F.count("*").alias("n")]
    for i in range(P):
        sums.append(F.sum(FEATURES[i]).alias(f"s{i}"))
        for j in range(i + 1):
            sums.append(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}{j}"))
    names = ["n"] + [f"s{i}" for i in range(P)] + [f"q{i}{j}" for i in range(P) for j in range(i + 1)]
    bins = near.groupBy("grp", "bin").agg(*sums)
    upto = Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = bins.withColumn("upto", F.sum("n").over(upto)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("grp"))
    )
    half = F.floor((F.col("all") + P + 1) / 2)
    core = placed.where(F.col("upto") - F.col("n") < half).groupBy("grp").agg(*[F.sum(c).alias(c) for c in names])
    n = F.col("n")
    means = [(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)]
    spread = [
        (F.col(f"q{i}{j}") / n - F.col(f"s{i}") / n * (F.col(f"s{j}") / n)).alias(f"c{i}{j}")
        for i in range(P)
        for j in range(i + 1)
    ]
    return materialize(_factor(core.select("grp", *means, *spread), spec), "quality-shape")


def _start(rows: DataFrame, groups: int, spec: OutlierSpec) -> DataFrame:
    """Medians, and squared scaled median deviations as a diagonal covariance."""
    middle = materialize(_medians(rows, list(FEATURES)), "quality-medians")
    named = middle.select("grp", *[F.col(c).alias(f"mid_{c}") for c in FEATURES])
    shifted = _joined(rows, named, groups)
    off = [F.abs(F.col(c) - F.col(f"mid_{c}")).alias(c) for c in FEATURES]
    mads = _medians(shifted.select("grp", *off), list(FEATURES))
    renamed = mads.select("grp", *[F.col(c).alias(f"d{i}") for i, c in enumerate(FEATURES)])
    both = middle.join(renamed, "grp")
    means = [F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(FEATURES)]
    spread = [
        (F.pow(1.4826 * F.col(f"d{i}"), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i in range(P)
        for j in range(i + 1)
    ]
    return materialize(_factor(both.select("grp", *means, *spread), spec), "quality-shape")


# Medians of chi-squares with one to five degrees of freedom.
_CHI_MEDIANS = (0.4549, 1.3863, 2.3660, 3.3567, 4.3515)

# Fixed value: the group of all rows, which judges groups that are too small.
_ALL = 0


def judge(stats: DataFrame, spec: OutlierSpec) -> DataFrame:
    """Add ``base_failed``, ``distance`` and ``kept`` to rows with the columns of ``text_stats``.

    The minimum-covariance-determinant estimate of each language and source comes
    from concentration steps that start at medians and median deviations; each
    step moves to a half of the group of lower determinant. Rows that fail the base rules take no
    part in it. ``distance`` is the squared Mahalanobis distance, of which the part
    on axes with a spread is scaled so that its median is that of a chi-square with
    as many degrees of freedom (the nearest half alone has too small a spread). It
    is null for rows that fail the base rules and for rows without a group of their
    own, whose ``kept`` follows from the estimate of all rows. Input columns of these names are replaced. Null languages and sources are groups of their own.
    """
    out = ("base_failed", "distance", "kept")
    rows = stats.select(
        F.struct(*without(stats, *out)).alias("row"),
        "lang",
        "source",
        *STATS,
        base_failed().alias("base_failed"),
        F.monotonically_increasing_id().alias("_id"),
    )
    rows = materialize(rows, "quality-stats")
    plain = rows.where(~F.col("base_failed")).select("_id", "lang", "source", *[c.alias(n) for n, c in _transformed().items()])
    placed, leftover = _grouped(plain, spec.least_rows)
    grouped = materialize(placed, "quality-rows")
    judged = F.col("grp").isNotNull()
    inside = grouped.where(judged).select("_id", "grp", F.lit(True).alias("judges"), *FEATURES)
    if leftover:
        inside = inside.union(grouped.select("_id", F.lit(_ALL).cast("long"), ~judged, *FEATURES))
    groups = inside.select("grp").distinct().count()
    shape = _start(inside, groups, spec)
    for _ in range(spec.steps):
        shape = _concentrate(inside, shape, groups, spec)
    near = materialize(_distances(inside, shape, groups), "quality-distances")
    spread = near.where("axes > 0").select("grp", "axes", _bin(F.col("spread2")).alias("bin"))
    middle = _medians(spread, ["bin"]).join(spread.groupBy("grp").agg(F.first("axes").alias("axes")), "grp")
    median = F.element_at(F.array(*map(F.lit, _CHI_MEDIANS)), F.col("axes"))
    scale = middle.select("grp", (F.exp((F.col("bin") + 0.5) / F.lit(float(_BINS_PER_LOG))) / median).alias("scale"))
    # Groups without a spread on any axis need no scale.
    scale = near.select("grp").distinct().join(scale, "grp", "left").select("grp", F.coalesce("scale", F.lit(1.0)).alias("scale"))
    scale = materialize(scale, "quality-scale")
    total = F.col("d2") - F.col("spread2") + F.col("spread2") / F.col("scale")
    scaled = _joined(near.where("judges"), scale, groups).select("_id", "grp", total.alias("total"))
    scaled = scaled.select("_id", "total", F.when(F.col("grp") != _ALL, F.col("total")).alias("distance"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("total"), F.lit(0.0)) <= spec.cutoff)
    return rows.join(scaled, "_id", "left").select("row.*", "base_failed", "distance", kept.alias("kept"))


def quality_report(docs: DataFrame, spec: OutlierSpec) -> DataFrame:
    """Statistics and verdict of every document."""
    stats = text_stats(docs.select("doc_id", "text", "lang", "source")).drop("text")
    return judge(stats, spec).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("distance", 6).alias("distance"),
    )
