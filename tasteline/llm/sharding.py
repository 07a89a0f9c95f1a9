"""Reproducible shuffles by a keyed permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteline.llm.text import int_div, utf8_bytes
from tasteline.operators.numbering import number_rows

ROUNDS = 6
WALK = 64


def _permute_once(x: Column, left: int, right: int, seed: int) -> Column:
    """Alternating Feistel network on the pairs [0, left) x [0, right)."""
    a, b = int_div(x, F.lit(right)), x % F.lit(right)
    for i in range(0, ROUNDS, 2):
        a = F.pmod(a + F.pmod(F.xxhash64(b, F.lit(seed), F.lit(i)), F.lit(left)), F.lit(left))
        b = F.pmod(b + F.pmod(F.xxhash64(a, F.lit(seed), F.lit(i + 1)), F.lit(right)), F.lit(right))
    return a * F.lit(right) + b


def permuted(df: DataFrame, number: str, n: int, seed: int, name: str) -> DataFrame:
    """Add a permutation of the numbers 0..n-1 of column ``number``.

    The network permutes a grid of at least n and fewer than n + sqrt(n) + 1
    cells; a number that leaves 0..n-1 is permuted again until it is back. A walk
    is never longer than the number of cells outside, and one of more than
    ``WALK`` steps has a chance below 1e-60; it stops the job instead of giving
    a wrong place.
    """
    left = max(1, math.isqrt(max(n - 1, 0)) + 1)
    right = max(1, -(-n // left))
    steps = min(WALK, left * right - n)
    x = F.col(name)
    df = df.withColumn(name, _permute_once(F.col(number).cast("long"), left, right, seed))
    if steps:
        walk = F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            x,
            lambda acc, _: F.when(acc < F.lit(n), acc).otherwise(_permute_once(acc, left, right, seed)),
        )
        df = df.withColumn(name, F.when(x < F.lit(n), x).otherwise(walk))
        df = df.withColumn(name, F.when(x < F.lit(n), x).otherwise(F.raise_error(F.lit("walk too long")).cast("long")))
    return df


def shard_rows(df: DataFrame, n_shards: int, seed: int, order: list[str]) -> DataFrame:
    """Spread all rows over ``n_shards`` shards whose counts differ by one at most.

    Rows are numbered in the order of the columns ``order`` (nulls first), then of
    a hash of the whole row, so equal rows are interchangeable and reruns agree on
    any layout. Row g goes to place p = P(g), shard p % n_shards and slot
    p div n_shards, so slots have no gaps and both can be computed from g alone.
    Adds ``shard`` (int) and ``slot`` (long); input columns of these names are
    replaced. Nulls, empty texts and repeated rows are rows like any other; an
    empty frame gives an empty one.
    """
    keys = [F.col("row").getField(c).asc_nulls_first() for c in order]
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in kept]
    packed = df.select(F.struct(*quoted).alias("row"))
    packed = packed.withColumn("tie", F.xxhash64("row"))
    numbered = number_rows(packed, [*keys, F.col("tie").asc()], "shard-rows", "g")
    n = numbered.agg(F.count("*").alias("n")).first()["n"]
    placed = permuted(numbered.select("row", "g"), "g", n, seed, "p")
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        F.pmod("p", F.lit(n_shards)).cast("int").alias("shard"),
        int_div(F.col("p"), F.lit(n_shards).cast("long")).cast("long").alias("slot"),
    )


def shard_report(docs: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """Shard and slot of every document with the size and checksum of its text.

    A null text counts as no bytes: size 8, checksum 0.
    """
    slim = docs.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 8).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    return shard_rows(slim, n_shards, seed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
