"""Column expressions on whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words.
SPACE = " \t\n\x0b\f\r"
_SPACES = "[ \\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(SPACE))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", none).otherwise(F.split(trimmed, _SPACES))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def utf8_bytes(text: Column) -> Column:
    """Number of UTF-8 bytes; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def int_div(a: Column, b: Column) -> Column:
    """Whole-number division of longs."""
    return F.call_function("div", a, b)


def without(df: DataFrame, *names: str) -> list[str]:
    """Quoted columns of ``df`` other than ``names`` (compared without case)."""
    taken = {n.lower() for n in names}
    return [f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in taken]
