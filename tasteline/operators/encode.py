"""String ids to dense integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteline.operators.joins import id_universe
from tasteline.operators.numbering import number_rows
from tasteline.sources.tables import Splits

def fit_codes(ids: DataFrame, id_col: str, code_col: str, ordered: bool = True) -> DataFrame:
    """(id, code) with codes 0..n-1; ``ordered`` makes the code the rank of the id.

    Nulls get no code. More ids than an int holds fail the job.
    """
    keys = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    numbered = number_rows(keys, [F.asc(id_col)] if ordered else [], f"codes-{code_col}", code_col)
    return numbered.withColumn(code_col, F.col(code_col).cast("int"))


def attach_codes(df: DataFrame, codes: DataFrame, id_col: str, code_col: str, unseen: str = "error") -> DataFrame:
    """Add the code of ``id_col``.

    ``unseen`` says what happens to an id without a code: ``error`` fails the
    job, ``keep`` leaves a null, ``drop`` removes the row.
    """
    if unseen == "drop":
        return df.join(codes, id_col)
    joined = df.join(codes, id_col, "left")
    if unseen == "keep":
        return joined
    if unseen != "error":
        raise ValueError(f"unseen must be error, keep or drop, got {unseen!r}")
    fail = F.raise_error(F.concat(F.lit(f"unseen {id_col}: "), F.coalesce(F.col(id_col), F.lit("null"))))
    checked = F.when(F.col(code_col).isNull(), fail.cast("int")).otherwise(F.col(code_col))
    return joined.withColumn(code_col, checked)


def cast_index(df: DataFrame, *columns: str) -> DataFrame:
    """Replace numeric index columns by their integer form."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def fit_user_codes(train: DataFrame) -> DataFrame:
    return fit_codes(train, "user_id", "user_index")


def fit_track_codes(splits: Splits) -> DataFrame:
    return fit_codes(id_universe("track_id", *splits), "track_id", "track_index")


def encode(rows: DataFrame, users: DataFrame, tracks: DataFrame, unseen: str = "error") -> DataFrame:
    coded = attach_codes(rows, users, "user_id", "user_index", unseen)
    return attach_codes(coded, tracks, "track_id", "track_index", unseen)


def encoding_table(df: DataFrame, id_col: str, code_col: str) -> DataFrame:
    """Distinct (id, code) pairs of an encoded frame."""
    return df.select(id_col, code_col).distinct()
