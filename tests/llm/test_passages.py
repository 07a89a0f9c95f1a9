"""Repeated passages, repeated strings and their parts against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tasteline.llm import fmindex, suffixes, windows
from tasteline.llm.spans import blocks

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_passages(rows):
    first = {}
    split = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    for i, w in split:
        if i is not None:
            for j in range(len(w) - 12):
                k = tuple(w[j : j + 13])
                first[k] = min(first.get(k, i), i)
    for i, w in split:
        keep = np.ones(len(w), bool)
        if i is not None:
            for j in range(len(w) - 12):
                if first[tuple(w[j : j + 13])] < i:
                    keep[j : j + 13] = False
        left = b" ".join(x for x, k in zip(w, keep) if k)
        yield i, len(w), int((~keep).sum()), hashlib.sha256(left).hexdigest()


def plain_strings(rows):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        seen.update(t[j : j + 200] for j in range(len(t) - 199))
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for j in range(len(t) - 199):
            if seen[t[j : j + 200]] > 1:
                gone[j : j + 200] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum()) if t else 0
        left = np.frombuffer(t, np.uint8)[~gone[:-1]].tobytes()
        yield i, len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("report, plain", [(fmindex.passage_report, plain_passages), (suffixes.string_report, plain_strings)])
def test_odd_documents(spark, odd_docs, no_docs, report, plain):
    got = Counter(map(tuple, report(odd_docs).collect()))
    assert got == Counter(plain([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert report(no_docs).count() == 0


@pytest.mark.parametrize("report, plain", [(fmindex.passage_report, plain_passages), (suffixes.string_report, plain_strings)])
def test_whole_table(spark, sf_dir, report, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = Counter(map(tuple, report(docs).collect()))
    assert got == Counter(plain([(r.doc_id, r.text) for r in docs.collect()]))


def test_strings_in_rows_without_an_id(spark):
    rng = random.Random(8)

    def letters(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    shared, twice, own = letters(400), letters(300), letters(500)
    rows = [(1, letters(50) + shared), (None, shared + letters(60)), (None, twice), (None, twice), (None, own), (0, letters(250))]
    rows += [(None, own + letters(10)), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, suffixes.string_report(docs).collect()))
    assert got == Counter(plain_strings(rows))
    assert sum(n for r, n in got.items() if r[2]) == 6


def test_segments_whose_hashes_collide_are_told_apart():
    data = np.frombuffer(b"abcabcabdab", np.uint8)
    offset, size = np.array([0, 3, 6, 9]), np.array([3, 3, 3, 2])
    assert windows._same_bytes(data, offset, size, np.array([0, 0, 0, 0])).tolist() == [True, True, False, False]


def test_equal_hashes_before_an_anchor_repeat_the_sort(monkeypatch):
    """The first byte values don't tell a from b, which stand before the anchors only."""
    rng = np.random.default_rng(2)
    tails = [bytes(rng.integers(120, 123, 200, dtype=np.uint8)) for _ in range(2)]
    heads = [bytes(rng.integers(97, 99, 60, dtype=np.uint8)) for _ in range(4)]
    texts = [heads[0] + tails[0], heads[1] + tails[0], heads[2] + tails[1], heads[3][:30] + heads[2][30:] + tails[1]]
    seeds, real = [], suffixes.byte_values

    def values(seed):
        seeds.append(seed)
        out = real(seed).copy()
        if seed == 1:
            out[97] = out[98]
        return out

    monkeypatch.setattr(suffixes, "byte_values", values)
    n = len(texts)
    segments = windows.Segments(
        np.arange(n), np.arange(n), np.zeros(n, np.int64), np.full(n, 61), np.full(n, 60), np.ones(n, np.uint64),
        np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8),
    )
    got = {(f, w) for f, low, high in zip(*suffixes.other_windows(segments)) for w in range(low, high + 1)}
    seen = Counter(t[w : w + 200] for t in texts for w in range(61))
    assert got == {(i, w) for i, t in enumerate(texts) for w in range(61) if seen[t[w : w + 200]] > 1}
    assert len(got) >= 64 and seeds == [1, 2]


def test_small_alphabet(spark):
    """Texts that repeat themselves and each other at every shift."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 60))) * rng.randint(1, 9)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, fmindex.passage_report(docs).collect())) == Counter(plain_passages(rows))
    assert Counter(map(tuple, suffixes.string_report(docs).collect())) == Counter(plain_strings(rows))


@given(st.lists(st.integers(1, 4), min_size=15, max_size=120), st.data())
@settings(max_examples=60, deadline=None)
def test_backward_search(symbols, data):
    text = np.array([*symbols, 0], dtype=np.int64)
    depth = data.draw(st.integers(2, 13))
    index = fmindex.FmIndex(text, 5, depth)
    ends = np.arange(depth, len(text))
    lo, hi = index.search(text, ends, depth)
    for e, a, b in zip(ends, lo, hi):
        pattern = symbols[e - depth : e]
        places = {i for i in range(len(symbols)) if symbols[i : i + depth] == pattern}
        assert set(index.order[a:b].tolist()) == (places if len(places) > 1 else set())


@given(st.lists(st.integers(0, 6), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_wavelet_rank(symbols):
    text = np.array(symbols)
    matrix = fmindex.WaveletMatrix(text, 7)
    at = np.arange(len(text) + 1)
    for c in range(7):
        assert matrix.rank(np.full(len(at), c), at).tolist() == [symbols[:i].count(c) for i in at]


@given(st.lists(st.tuples(st.integers(0, 3), st.text("ab", max_size=40)), min_size=1, max_size=40))
@settings(max_examples=60, deadline=None)
def test_suffix_sort(items):
    items.sort(key=lambda x: x[0])
    data = "".join(t + "|" for _, t in items).encode()
    sizes = np.array([len(t) + 1 for _, t in items])
    start = np.cumsum(sizes) - sizes
    group = np.array([g for g, _ in items], dtype=np.uint64)
    s = suffixes.Suffixes(np.frombuffer(data, np.uint8), start, start + sizes - 1, 1)
    order = s.sort(group)
    assert sorted(order.tolist()) == list(range(len(items)))
    assert [items[i] for i in order] == sorted(items)
    a, b = order[:-1], order[1:]
    for i, j, n in zip(a, b, s.common(a, b)):
        x, y = items[i][1], items[j][1]
        assert x[:n] == y[:n] and (n == min(len(x), len(y)) or x[n] != y[n])
    assert s.verified(a, b, s.common(a, b))


@given(st.lists(st.text("ab ", max_size=80), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_runs_cover_every_window_once(texts):
    plan = windows.Plan(suffixes._byte_units, 12, 4, within=True)
    block = next(blocks(pa.array(texts), 1 << 20))
    runs = windows.anchor_runs(plan.units(block), plan)
    seen, keys = Counter(), {}
    for t, low, high, anchor, key in zip(*runs):
        for p in range(low, high + 1):
            seen[p] += 1
            window = block.data[p : p + 12].tobytes()
            assert keys.setdefault(window, (anchor - p, key)) == (anchor - p, key)
            assert low <= p <= anchor <= p + 8
    wanted = [s + i for s, e in zip(block.starts[:-1], block.starts[1:]) for i in range(e - s - 11)]
    assert seen == Counter(wanted)


def test_collisions_sort_again(monkeypatch):
    """Hashes that can't tell bytes apart are found out by comparing bytes."""
    seen = []

    def values(seed=1):
        seen.append(seed)
        return np.full(256, 5, np.uint64) if seed < 3 else np.arange(1, 257, dtype=np.uint64) * np.uint64(7919)

    monkeypatch.setattr(suffixes, "byte_values", values)
    text = ("x" * 210 + "y" * 30).encode()
    other = ("x" * 209 + "z" * 31).encode()
    data = np.frombuffer(text + b"\n" + other + b"\n", np.uint8)
    one = np.array([1, 2], np.int64)
    segments = windows.Segments(one, one, one * 0, np.array([41, 41]), one * 0 + 40, np.zeros(2, np.uint64), data)
    fp, low, high = suffixes.other_windows(segments)
    assert seen[-1] == 3
    assert sorted(zip(fp.tolist(), low.tolist(), high.tolist())) == [(1, 0, 9), (2, 0, 9)]
