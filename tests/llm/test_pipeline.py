"""The pipeline's stages on odd documents and its whole run on a small table."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_neardup import plain as plain_groups
from test_scans import plain_hits
from test_sharding_mixing import plain_mix

from tasteline.llm.mixing import MixSpec


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The rows after each stage, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, kept[-1], sf_dir).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_shrinking(stages):
    for before, after in zip(stages[:4], stages[1:4]):
        assert after.columns == stages[0].columns
        assert not ids(after) - ids(before)
    assert stages[4].columns == stages[0].columns
    assert stages[5].columns == [*stages[0].columns, "shard", "slot"]


def test_clean_documents_stay(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    good = stages[0].join(labels, "doc_id")
    left = stages[1].join(labels, "doc_id").count()
    assert left >= 0.9 * good.count()
    bad = stages[0].join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0"), "doc_id", "left_semi")
    assert stages[1].join(bad.select("doc_id"), "doc_id").count() <= 0.3 * bad.count()


def test_one_document_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == Counter(i for i, _, _, kept in plain_groups(rows, 5, 80) if kept)


def test_contaminated_documents_go(spark, sf_dir, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = plain_hits([(r.doc_id, r.text) for r in stages[2].collect()], items)
    assert ids(stages[3]) == Counter(r[0] for r in found if not r[5])


def test_mix_and_shards(stages):
    size = {r.doc_id: r.n for r in stages[3].select("doc_id", F.regexp_count("text", F.lit("[^ \\x09-\\x0D]+")).alias("n")).collect()}
    source = {r.doc_id: r.source for r in stages[3].collect()}
    targets, _ = plain_mix([(source[i], n) for i, n in size.items()], MixSpec())
    taken = Counter()
    for i, n in ids(stages[4]).items():
        taken[source[i]] += n * size[i]
    largest = Counter()
    for i, n in size.items():
        largest[source[i]] = max(largest[source[i]], n)
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, t in targets.items())
    rows = stages[5].select("shard", "slot").collect()
    counts = Counter(r.shard for r in rows)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    assert len(set(rows)) == len(rows) == stages[4].count()


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_odd_documents(spark, sf_dir, odd_docs, no_docs, k):
    clash = odd_docs.withColumns({c: F.lit("mine") for c in ("kept", "grp", "n_words", "key", "number", "repeats", "document")})
    _, stage = corpus_pipeline.STAGES[k]
    got = stage(spark, clash, sf_dir)
    assert set(got.columns) - {"shard", "slot"} == set(clash.columns)
    assert all(set(r) == {"mine"} for r in got.select("kept", "grp", "n_words", "key", "number", "repeats", "document").distinct().collect())
    assert stage(spark, no_docs, sf_dir).count() == 0
