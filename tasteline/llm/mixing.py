"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteline.llm.text import n_words
from tasteline.operators.numbering import number_rows
from tasteline.session import materialize

# Bits of the draw that one pass looks at, and number of such passes.
_DIGIT = 12
_LEVELS = 2
_DRAW_BITS = 60


@dataclass(frozen=True)
class MixSpec:
    """Weights that repeat over the sources, most epochs of a source, and seed."""

    weights: tuple[int, ...] = (1, 2, 3)
    max_epochs: int = 3
    seed: int = 17


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """(source, source_size, weight, target) of rows (source, size).

    Sources are ranked by code point, null last, and weighted in turn. Targets
    share the total size in proportion to the weights; a source whose share is
    above ``max_epochs`` times its size is clamped there, and what is left is
    shared again among the others until none is above. The driver holds three
    sums a round, never the sources.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(sums, [F.col("source").asc_nulls_last()], "mix-sources", "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in spec.weights]), (F.col("rank") % len(spec.weights)).cast("int") + 1)
    table = materialize(
        ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights"
    )
    cap = (F.lit(spec.max_epochs) * F.col("source_size")).cast("double")
    total = table.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        row = table.agg(
            F.sum(F.when(above, F.col("source_size") * spec.max_epochs).otherwise(0)).alias("caps"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(above.cast("long")).alias("n"),
        ).first()
        if not row["weights"] or row["n"] == clamped:
            break
        level, clamped = (total - row["caps"]) / row["weights"], row["n"]
    share = F.lit(float(level or 0.0)) * F.col("weight")
    return table.select(
        "source", "source_size", "weight", F.when(share > cap, cap).otherwise(share).alias("target")
    )


def _draw(number: Column, seed: int) -> Column:
    """A whole number of 60 bits from the row number."""
    text = F.concat(F.lit(f"{seed}-"), number.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _DRAW_BITS // 4), 16, 10).cast("long")


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, draw below which rows get one more, row to fill up with.

    Rows of a source are taken in the order of their draws while they fit into
    what is left of the target after whole repetitions. The place of the cut is
    found digit by digit from sums per source and digit, so no source is ever
    sorted whole; only the rows of the last cell are put in order.
    """
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    state = materialize(
        targets.withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * size)
        .withColumn("base", F.lit(0).cast("long"))
        .withColumn("low", F.lit(0).cast("long")),
        "mix-state",
    )
    width = _DRAW_BITS
    for _ in range(_LEVELS):
        width -= _DIGIT
        span = 1 << (width + _DIGIT)
        cell = (
            rows.alias("r")
            .join(state.alias("s"), _same_source("r", "s"))
            .where((F.col("r.draw") >= F.col("s.low")) & (F.col("r.draw") - F.col("s.low") < span))
        )
        digit = F.shiftright(F.col("r.draw") - F.col("s.low"), width).alias("digit")
        sums = cell.groupBy(F.col("s.source").alias("source"), digit).agg(F.sum("r.size").alias("size"))
        before = Window.partitionBy("source").orderBy("digit")
        upto = sums.withColumn("upto", F.sum("size").over(before))
        # The first digit that no longer fits; past the last one if all fit.
        over = (
            upto.alias("u")
            .join(state.alias("s"), _same_source("u", "s"))
            .where(F.col("s.base") + F.col("u.upto") > F.col("s.rest"))
            .groupBy(F.col("s.source").alias("source"))
            .agg(F.min(F.struct(F.col("u.digit").alias("digit"), (F.col("u.upto") - F.col("u.size")).alias("below"))).alias("cut"))
        )
        state = materialize(
            state.alias("s")
            .join(over.alias("o"), _same_source("s", "o"), "left")
            .select(
                *[f"s.{c}" for c in ("source", "source_size", "target", "whole", "rest")],
                (F.col("s.base") + F.coalesce(F.col("o.cut.below"), F.lit(0))).alias("base"),
                # If everything fits, no row lies in the cell that follows.
                F.coalesce(
                    F.col("s.low") + F.shiftleft(F.col("o.cut.digit"), width), F.lit(1 << _DRAW_BITS)
                ).alias("low"),
            ),
            "mix-state",
        )
    last = (
        rows.alias("r")
        .join(state.alias("s"), _same_source("r", "s"))
        .where((F.col("r.draw") >= F.col("s.low")) & (F.col("r.draw") - F.col("s.low") < (1 << width)))
        .select("s.source", "s.base", "s.rest", "r.draw", "r.number", "r.size")
    )
    order = Window.partitionBy("source").orderBy("draw", "number")
    placed = last.withColumn("upto", F.col("base") + F.sum("size").over(order))
    ends = placed.groupBy("source").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("draw", "number"))).alias("cut"),
        F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("got"),
    )
    cut = materialize(
        state.alias("s")
        .join(ends.alias("e"), _same_source("s", "e"), "left")
        .select(
            *[f"s.{c}" for c in ("source", "source_size", "target", "whole", "rest")],
            F.coalesce("e.cut.draw", "s.low").alias("draw"),
            F.coalesce("e.cut.number", F.lit(-1)).alias("number"),
            (F.col("s.rest") - F.coalesce("e.got", "s.base")).alias("missing"),
        ),
        "mix-cut",
    )
    # Of the rows past the cut, the one that comes nearest to what is missing.
    past = (
        rows.alias("r")
        .join(cut.alias("c"), _same_source("r", "c"))
        .where(F.struct("r.draw", "r.number") >= F.struct("c.draw", "c.number"))
        .where(F.abs(F.col("r.size") - F.col("c.missing")) < F.col("c.missing"))
        .groupBy(F.col("c.source").alias("source"))
        .agg(
            F.min(
                F.struct(F.abs(F.col("r.size") - F.col("c.missing")).alias("off"), F.col("r.draw"), F.col("r.number"))
            ).alias("fill")
        )
    )
    return materialize(
        cut.alias("c")
        .join(past.alias("p"), _same_source("c", "p"), "left")
        .select("c.*", F.coalesce("p.fill.number", F.lit(-1)).alias("fill")),
        "mix-fill",
    )


def mix(docs: DataFrame, spec: MixSpec, keep: list[str] | None = None) -> DataFrame:
    """Every row with the number of times that the mix repeats it.

    Adds ``size`` (words), ``source_size``, ``target``, ``repeats`` and ``taken``
    (size times repeats) to the columns ``keep`` (all by default); input columns
    of these names are replaced. Each source gets whole repetitions plus a seeded
    part of one more. Rows are numbered by (doc_id, text, source), so reruns agree
    and repeated rows are interchangeable. A null text has size 0; a null source
    is a source of its own; a source of size 0 has target 0 and its rows are not
    repeated. An empty frame gives an empty one.
    """
    out = ("size", "source_size", "target", "repeats", "taken")
    kept = [c for c in (keep or docs.columns) if c.lower() not in out]
    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in kept]
    packed = docs.select(
        F.struct(*quoted).alias("row"),
        "source",
        n_words(F.col("text")).alias("size"),
        F.col("doc_id").alias("id"),
        F.md5(F.col("text").cast("binary")).alias("sum"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("id", "sum", "source")]
    numbered = number_rows(packed, [*order, F.xxhash64("row").asc()], "mix-rows")
    draw = _draw(F.col("number"), spec.seed)
    rows = materialize(numbered.select("source", "size", "number", draw.alias("draw")), "mix-slim")
    cuts = _cuts(rows, source_targets(rows, spec)).withColumnRenamed("draw", "cut")
    below = F.struct(F.col("n.draw"), F.col("n.number")) < F.struct("c.cut", "c.number")
    more = (below | (F.col("n.number") == F.col("c.fill"))).cast("long")
    repeats = F.least(F.col("c.whole") + more, F.lit(spec.max_epochs).cast("long"))
    return (
        numbered.withColumn("draw", draw)
        .alias("n")
        .join(cuts.alias("c"), _same_source("n", "c"))
        .select(
            *[F.col("n.row").getField(c).alias(c) for c in kept],
            F.col("n.size").alias("size"),
            F.col("c.source_size").alias("source_size"),
            F.col("c.target").alias("target"),
            repeats.cast("int").alias("repeats"),
            (F.col("n.size") * repeats).alias("taken"),
        )
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix written out: each row as often as ``repeats`` says."""
    names = [F.col(f"`{c.replace('`', '``')}`") for c in columns]
    times = F.explode(F.array_repeat(F.lit(0), F.col("repeats")))
    return mixed.select(*names, times.alias("__copy")).drop("__copy")


def mix_report(docs: DataFrame, spec: MixSpec) -> DataFrame:
    """Size, target and words taken of every document."""
    return mix(docs, spec, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")
