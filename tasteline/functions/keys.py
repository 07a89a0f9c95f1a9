"""Repeatable hash keys and name parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def hash_bucket(*cols: str, seed: int) -> Column:
    """First 32 bits of the MD5 of the key columns and the seed, as a long.

    A function of the key alone, so a sample does not change with the partition
    layout, a retry or the number of executors.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def in_fraction(fraction: float, *cols: str, seed: int) -> Column:
    """True for about ``fraction`` of the distinct keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must lie in [0, 1], got {fraction}")
    return hash_bucket(*cols, seed=seed) < F.lit(round(fraction * HASH_RANGE))


def fraction_name(fraction: float) -> str:
    """Fraction as part of a file name: 0.25 becomes ``0_25``."""
    return str(float(fraction)).replace(".", "_")
