"""Run records: an appended table, and the text form older logs use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tasteline.functions.labels import ALS_FIELDS, ALS_LINE, BIAS_FIELDS, BIAS_LINE, log_name

ALS_SCHEMA = (
    "run_no int, Rank double, Reg double, Alpha double, Maxiter double, User_blocks int, Item_blocks int, Metric double, "
    "Time_TTL double, Time_fit double, Time_rec double, Time_evl double"
)


def append_run(spark: SparkSession, record: dict, path: str) -> None:
    """Add one finished ALS run to the table of runs; a run of the same number is replaced.

    Each run has a partition of its own, and only that is overwritten, so a
    retried point leaves one record, and points may finish in any order.
    """
    kinds = dict(part.split() for part in ALS_SCHEMA.split(", "))
    row = Row(**{n: (int if kind == "int" else float)(record[n]) for n, kind in kinds.items()})
    writer = spark.createDataFrame([row], ALS_SCHEMA).coalesce(1).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("run_no").parquet(path)


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    names = [part.split()[0] for part in ALS_SCHEMA.split(", ")]
    return spark.read.schema(ALS_SCHEMA).parquet(path).select(*names)


def stored_runs(spark: SparkSession, path: str) -> list[dict]:
    """The finished runs in ``path``, none if nothing was written there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return [r.asDict() for r in load_runs(spark, path).orderBy("run_no").collect()]


def als_line() -> Column:
    """Text form of an ALS run record."""
    return F.format_string(ALS_LINE, *[F.col(c) for c in ALS_FIELDS])


def bias_line() -> Column:
    """Text form of a bias run record; flags read ``True`` / ``False``."""
    flags = [F.initcap(F.col(c).cast("string")) for c in BIAS_FIELDS[:2]]
    return F.format_string(BIAS_LINE, *flags, *[F.col(c) for c in BIAS_FIELDS[2:]])


def write_logs(lines: DataFrame, path: str) -> None:
    """Append (log, value) lines, one folder per log name."""
    lines.select("log", "value").write.mode("append").partitionBy("log").text(path)


def read_logs(spark: SparkSession, glob: str) -> DataFrame:
    """(log, value) lines of all files that match, with the log's name."""
    lines = spark.read.option("recursiveFileLookup", "true").text(glob)
    return lines.select(log_name(F.col("_metadata.file_path")).alias("log"), "value")


def log_names(lines: DataFrame) -> DataFrame:
    """Names of the logs read, sorted."""
    return lines.select("log").distinct().orderBy("log")
