"""Words and rolling hashes of whole Arrow columns of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; a longer text is a block by itself.
BLOCK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


class Block(NamedTuple):
    """Some texts of one batch, end to end: rows lo..hi-1, their bytes and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    starts: np.ndarray


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts (n + 1) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, places, data = column.buffers()
    starts = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in runs of about ``limit`` bytes; texts are never cut."""
    data, starts = utf8(column)
    lo, n = 0, len(starts) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield Block(lo, hi, data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo])
        lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(bits: int, inverse: bool) -> np.ndarray:
    """The first 2**bits powers of the base of the rolling hash, or of its inverse."""
    out = np.ones(1, dtype=np.uint64)
    base = _INVERSE if inverse else _ODD
    for i in range(bits):
        out = np.concatenate([out, out * np.uint64(pow(base, 1 << i, 1 << 64))])
    return out


def powers(n: int, inverse: bool = False) -> np.ndarray:
    return _powers(max(10, int(n).bit_length()), inverse)


@lru_cache(maxsize=2)
def byte_values(seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * base**i modulo 2**64, one longer than the input."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(len(values))[: len(values)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], the same wherever these values stand."""
    return mix64((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start] + (end - start).astype(np.uint64))


# Fixed value: bytes that separate words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words(NamedTuple):
    """Word starts and ends in the block's bytes, first word of each text (n + 1), hash of each word."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def split_words(block: Block, is_space: np.ndarray = _SPACE, fold: np.ndarray | None = None) -> Words:
    """Maximal runs of non-space bytes within each text, hashed after ``fold`` (a table of 256 bytes)."""
    data = block.data if fold is None else fold[block.data]
    inside = ~is_space[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    edges = block.starts[:-1]
    edges = edges[edges < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = block.starts[1:]
    after[ends[ends > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, block.starts)
    prefix = prefix_hash(byte_values()[data])
    return Words(start, end, first, range_hash(prefix, start, end))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


# Lower case of A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
