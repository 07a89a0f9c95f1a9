"""Run functions of this package on Arrow batches, on workers that don't have it installed."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name)
    context.addPyFile(made)
    _SHIPPED.add(context.applicationId)


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
