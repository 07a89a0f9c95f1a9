"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every end of the links (a, b); the label is the least id reachable.

    Each round hooks every component to its least neighbour, follows the hooks
    twice, and replaces the ends of the links by their components, so links and
    components shrink together. Links stay tables; the driver sees their number.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    left = materialize(both.where("u <> v").distinct(), "links")
    labels = left.select(F.col("u").alias("id")).distinct().withColumn("label", F.col("id"))
    while left.limit(1).count():
        hook = left.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        hook = materialize(hook, "hooks")
        for _ in range(2):
            up = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
            hook = materialize(hook.join(up, "p").select("u", F.col("q").alias("p")), "hooks")
        step = hook.select(F.col("u").alias("label"), "p")
        labels = materialize(
            labels.join(step, "label", "left").select("id", F.coalesce("p", "label").alias("label")), "labels"
        )
        over = hook.select(F.col("u").alias("v"), F.col("p").alias("q"))
        left = left.join(hook, "u").select(F.col("p").alias("u"), "v").join(over, "v").select("u", F.col("q").alias("v"))
        left = materialize(left.where("u <> v").distinct(), "links")
    return labels
