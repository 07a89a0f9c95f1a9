"""Array expressions on recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def best_first(recommendations: Column) -> Column:
    """Order a list by falling rating, equal ratings by rising track."""
    keyed = F.sort_array(
        F.transform(
            recommendations,
            lambda r: F.struct((-r["rating"]).alias("low"), r["track_index"].alias("track_index")),
        )
    )
    return F.transform(
        keyed,
        lambda r: F.struct(r["track_index"].alias("track_index"), (-r["low"]).alias("rating")),
    )
