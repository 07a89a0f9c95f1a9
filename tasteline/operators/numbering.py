"""Consecutive numbers over a whole frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteline.session import materialize

# monotonically_increasing_id keeps the row number in its low 33 bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[Column], label: str, name: str = "number") -> DataFrame:
    """Add numbers 0..n-1 in the given order; without an order, in any.

    The rows are range-partitioned and sorted, numbered inside each partition and
    shifted by the number of rows in the partitions before. No step sees all
    rows: only the partition sizes come together, one row per partition. The
    numbers inside partitions are written out before they are used twice.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    slot = F.monotonically_increasing_id()
    placed = materialize(df.withColumn("_slot", slot), label).select(
        *df.columns,
        F.shiftright("_slot", _ROW_BITS).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit(2**_ROW_BITS - 1)).alias("_row"),
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the write above, so the broadcast side is bounded.
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_row")).alias(name)
    )
