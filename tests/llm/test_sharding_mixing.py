"""Sharding and mixing against their laws and against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tasteline.llm import mixing, sharding
from tasteline.llm.mixing import MixSpec


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 100, 1000, 1023])
def test_permutation(spark, n):
    got = sharding.permuted(spark.range(n), "id", n, 3, "p").select("p").collect()
    assert sorted(r.p for r in got) == list(range(n))
    if n >= 100:
        other = sharding.permuted(spark.range(n), "id", n, 4, "p").select("p").collect()
        assert [r.p for r in got] != [r.p for r in other]
        assert sum(abs(r.p - i) for i, r in enumerate(got)) > n * n / 5


def test_shards_even_and_gapless(spark, odd_docs):
    rows = sharding.shard_report(odd_docs, 7, 1).collect()
    assert len(rows) == odd_docs.count()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    text = {(r.doc_id, r.text) for r in odd_docs.collect()}
    wanted = Counter((i, len((t or "").encode()) + 8) for i, t in ((r.doc_id, r.text) for r in odd_docs.collect()))
    assert Counter((r.doc_id, r.size) for r in rows) == wanted and text


def test_shards_do_not_depend_on_layout(spark, odd_docs):
    runs = [
        sorted(map(tuple, sharding.shard_report(d, 5, 9).collect()), key=repr)
        for d in (odd_docs, odd_docs.repartition(7), odd_docs.orderBy(F.desc("doc_id")).coalesce(1))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_shard_rows_keeps_columns(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("shard", F.lit("mine"))
    got = sharding.shard_rows(clash, 4, 1, ["doc_id"])
    assert set(got.columns) == {*odd_docs.columns, "shard", "slot"}
    assert dict(got.dtypes)["shard"] == "int"
    assert sorted(map(repr, got.select(odd_docs.columns).collect())) == sorted(map(repr, odd_docs.collect()))
    assert sharding.shard_report(no_docs, 24, 1).count() == 0


def plain_mix(rows, spec):
    """(targets, taken per source) by repeated clamping, without Spark."""
    size = defaultdict(int)
    for source, n in rows:
        size[source] += n
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in size if s is None]
    weight = {s: spec.weights[i % len(spec.weights)] for i, s in enumerate(names)}
    total, clamped = sum(size.values()), set()
    while True:
        left = [s for s in names if s not in clamped]
        if not left:
            break
        level = (total - sum(spec.max_epochs * size[s] for s in clamped)) / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > spec.max_epochs * size[s]}
        if not over:
            break
        clamped |= over
    return {s: float(spec.max_epochs * size[s]) if s in clamped else level * weight[s] for s in names}, size


@pytest.mark.parametrize("seed", [17, 18])
def test_mix_against_plain_python(spark, odd_docs, seed):
    spec = MixSpec(seed=seed)
    rows = mixing.mix(odd_docs, spec).collect()
    assert len(rows) == odd_docs.count()
    words = re.compile("[^\x20\x09-\x0D]+")
    for r in rows:
        assert r.size == len(words.findall(r.text or "")) and r.taken == r.size * r.repeats and 0 <= r.repeats <= 3
    targets, size = plain_mix([(r.source, r.size) for r in rows], spec)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.target == targets[r.source] and r.source_size == size[r.source]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(targets.values()) == pytest.approx(sum(size.values()))
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, t in targets.items())
    # Whole repetitions for all, one more for some.
    for s in targets:
        assert len({r.repeats for r in rows if r.source == s and r.size}) <= 2


def test_mix_repeats_rows(spark, odd_docs, no_docs):
    mixed = mixing.mix(odd_docs, MixSpec())
    wanted = Counter()
    for r in mixed.collect():
        wanted[repr((r.doc_id, r.text, r.row))] += r.repeats
    got = mixing.repeated(mixed, ["doc_id", "text", "row"]).collect()
    assert Counter(repr(tuple(r)) for r in got) == +wanted
    assert mixing.mix_report(no_docs, MixSpec()).count() == 0
    blank = odd_docs.where("trim(text) = ''")
    assert {r.taken for r in mixing.mix_report(blank, MixSpec()).collect()} == {0}


def test_mix_does_not_depend_on_layout(spark, odd_docs):
    runs = [
        sorted(map(tuple, mixing.mix_report(d, MixSpec()).collect()), key=repr)
        for d in (odd_docs, odd_docs.repartition(9))
    ]
    assert runs[0] == runs[1]


def test_checksums(spark):
    docs = spark.createDataFrame([(1, "é"), (2, None)], "doc_id long, text string")
    import zlib

    got = {r.doc_id: (r.size, r.text_crc32) for r in sharding.shard_report(docs, 2, 1).collect()}
    assert got == {1: (10, zlib.crc32("é".encode())), 2: (8, 0)}
