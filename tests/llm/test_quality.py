"""Text statistics against plain Python; outliers against planted ones."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tasteline.llm.quality import STATS, OutlierSpec, judge, quality_report, text_stats


def plain_stats(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {i + j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_stats(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("n_words", F.lit("mine")).withColumn("_words", F.lit(1))
    rows = text_stats(clash).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert tuple(r[c] for c in STATS) == plain_stats(r.text)
    assert text_stats(no_docs).count() == 0


def test_stats_of_whole_table(spark, sf_dir):
    for r in text_stats(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect():
        assert tuple(r[c] for c in STATS) == plain_stats(r.text)


@pytest.fixture(scope="module")
def planted(spark):
    """Clean prose in three groups (one of a single document), and junk in two."""
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    rows = []
    for i in range(360):
        w = [rng.choice(vocab) for _ in range(int(rng.lognormvariate(5, 0.7)) + 20)]
        source = "s1" if i < 200 else None if i < 359 else "lone"
        junk = i % 60 == 7
        rows.append((i, " ".join(x + "$%&" for x in w) if junk else " ".join(w), "en", source, junk))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")


def test_outliers(spark, planted):
    got = {r.doc_id: r for r in quality_report(planted, OutlierSpec()).collect()}
    assert len(got) == 360
    for r in planted.collect():
        assert got[r.doc_id].kept == (not r.junk), r.doc_id
        assert not got[r.doc_id].base_failed
    assert got[359].distance is None


def test_verdicts_do_not_depend_on_layout(spark, planted):
    runs = [sorted(map(tuple, quality_report(d, OutlierSpec()).collect())) for d in (planted, planted.repartition(11))]
    assert runs[0] == runs[1]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = quality_report(odd_docs, OutlierSpec(least_rows=5)).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality_report(no_docs, OutlierSpec()).count() == 0
    stats = text_stats(odd_docs.withColumn("grp", F.lit(1)).withColumn("kept", F.lit("x")))
    assert set(judge(stats, OutlierSpec()).columns) == {*odd_docs.columns, *STATS, "grp", "kept", "base_failed", "distance"}


def test_planted_on_each_feature(spark):
    """One odd statistic is enough; clean documents stay, also in groups too small for an estimate of their own."""
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(5000)]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]

    def size():
        return int(rng.lognormvariate(5.3, 0.35)) + 20

    def symbols():
        w = prose(200)
        return " ".join(x + "$" if i % 10 == 0 else x for i, x in enumerate(w))

    def lines():
        w = prose(200)
        return "\n".join("ok" if i % 2 else " ".join(w[2 * i : 2 * i + 7]) for i in range(90))

    def repeats():
        w = prose(160)
        return " ".join(w + w[:20])

    odd = [
        lambda: " ".join(prose(6000)),
        lambda: " ".join(x * 3 for x in prose(200)),
        symbols,
        lines,
        repeats,
    ]
    rows = [(i, " ".join(prose(size())), "en", "s1", False) for i in range(400)]
    rows += [(400 + i, " ".join(prose(size())), "en", f"small{i}", False) for i in range(10)]
    rows += [(500 + i, make(), "en", "s1", True) for i, make in enumerate(odd)]
    rows += [(600 + i, make(), "en", f"tiny{i}", True) for i, make in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, odd boolean")
    got = {r.doc_id: r for r in quality_report(docs, OutlierSpec()).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [i for i, _, _, _, planted in rows if planted and got[i].kept] == []
    # Of clean documents the cutoff leaves out one in a thousand.
    assert sum(not got[i].kept for i, _, _, _, planted in rows if not planted) <= 2
