"""Benchmark search, licence scans, archive records and language-model scores."""

import base64
import hashlib
import json
import re
import textwrap
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tasteline.llm import contamination, licenses, lm, warc

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return TOKEN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(docs, items):
    found = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            found[tuple(w[i : i + n])].add(str(item))
    for i, text in docs:
        w, hit, ids = tokens(text), set(), set()
        for n in {len(k) for k in found}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in found:
                    hit |= set(range(j, j + n))
                    ids |= found[tuple(w[j : j + n])]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        yield i, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination(spark, odd_docs, no_docs):
    texts = [r.text for r in odd_docs.where("length(text) > 200").orderBy("doc_id").collect()]
    items = [(1, texts[0][:150].upper()), (2, "one"), (3, texts[1]), (4, texts[1]), (5, ""), (6, None), (10, "two, words!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter(map(tuple, contamination.contamination_report(odd_docs, benchmark).collect()))
    assert got == Counter(plain_hits(docs, items))
    assert sum(r[2] > 0 for r in got) > 3
    kept = contamination.decontaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(n for r, n in got.items() if not r[5])
    assert contamination.contamination_report(no_docs, benchmark).count() == 0
    none = contamination.contamination_report(odd_docs, benchmark.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_a_benchmark_of_many_parts(spark):
    """600,000 windows: parts overlap in documents, and items share passages."""
    rng = np.random.default_rng(9)
    vocab = np.array([f"w{i}" for i in range(3000)])
    texts = [" ".join(vocab[rng.integers(0, 3000, 1012)]) for _ in range(600)]
    texts[7] = texts[8][:4000] + " and " + texts[9]
    items = [(i, t) for i, t in enumerate(texts)] + [(1000, "w1 w2"), (1001, None), (None, "w5 w6 w7")]
    docs = []
    for i in range(80):
        parts = [" ".join(vocab[rng.integers(0, 3000, rng.integers(0, 60))])]
        for _ in range(rng.integers(0, 4)):
            words = texts[rng.integers(0, 600)].split()
            at = rng.integers(0, 950)
            parts += [" ".join(words[at : at + rng.integers(8, 60)]).upper(), "x" * (i % 2)]
        docs.append((i, " ".join(parts)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    assert sum(max(1, len(t.split()) - 12) for _, t in items if t) > 8 * contamination.MAX_PATTERNS
    found = {r.doc_id: r for r in contamination.contamination_report(frame, benchmark).collect()}
    wanted = {r[0]: r for r in plain_hits(docs, [("" if i is None else i, t) for i, t in items])}
    assert {i: tuple(r) for i, r in found.items()} == wanted
    assert sum(r.n_hit > 0 for r in found.values()) > 40
    kept = {r.doc_id for r in contamination.decontaminated(frame, benchmark).collect()}
    assert kept == {i for i, r in wanted.items() if not r[5]}


def test_buckets_with_many_patterns(spark):
    # All windows end alike, so they fall into one bucket.
    ends = [f"s{i} " + "a " * 11 + "z" for i in range(300)]
    benchmark = spark.createDataFrame(list(enumerate(ends)), "item_id long, text string")
    docs = [(i, f"x {ends[i]} y " + "a " * 20 + "z") for i in range(0, 300, 7)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter(map(tuple, contamination.contamination_report(frame, benchmark).collect()))
    assert got == Counter(plain_hits(docs, list(enumerate(ends))))


def test_archive_pages_of_open_tags():
    for piece in ("<p ", "<a ", "<title>", "<html lang=", "<a href='", "<!--", "<b x=\"", "<script>", "<noscript><br>"):
        start = time.perf_counter()
        warc.read_page(piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - start < 3
    read = warc.read_page("<html lang=EN-gb><title>a\n&amp; b</title><noscript>no<img src=i></noscript><p>x<br>y <b>z</b><a href=' /q?a&amp;b '>w</a>")
    assert read == (["a & b", "x", "y zw"], [("img@src", "i"), ("a@href", "/q?a&b")], "a & b", "en-gb")


def test_contamination_of_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = Counter(map(tuple, contamination.contamination_report(docs, items).collect()))
    assert got == Counter(plain_hits([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()]))


def test_licences(spark, no_docs):
    notice = (
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at:\n http://example.org\n"
    )
    rows = [
        (1, "Some text. Released under the MIT License.\nMore"),
        (2, notice),
        (3, "Licensed under the Apache License, Version 2.0."),
        (4, "Licensed under the Apache License, Version 2.0 (the license)!\nThen CC. Licensed under CC BY-NC 4.0"),
        (5, None),
        (6, ""),
        (7, "This is not released under the MIT License at all."),
        (8, "Released under the MIT License.\nReleased under the MIT License."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rules", F.lit("mine"))
    got = {r.doc_id: (r.known, r.rules, r.licences) for r in licenses.scan(docs).collect()}
    assert got == {
        1: (["mit-line-1"], ["mit-line"], ["MIT"]),
        2: (["apache-notice-1", "apache-notice-2", "apache-notice-3"], ["apache-short-notice"], ["Apache-2.0"]),
        3: (["apache-line-1"], ["apache-line"], ["Apache-2.0"]),
        4: (["apache-notice-1", "by-nc-line-1"], ["apache-line-2", "by-nc-line"], ["Apache-2.0", "CC-BY-NC-4.0"]),
        5: ([], [], []),
        6: ([], [], []),
        7: ([], [], []),
        8: (["mit-line-1", "mit-line-1"], ["mit-line", "mit-line"], ["MIT"]),
    }
    assert licenses.scan_report(no_docs).count() == 0


def test_licence_sentences_are_normalised(spark):
    rows = spark.createDataFrame([(s,) for s in licenses.SENTENCES.values()], "s string")
    assert rows.where(licenses.normalised(F.col("s")) != F.col("s")).count() == 0
    assert {n for _, _, names in licenses.RULES for n in names} == set(licenses.SENTENCES)


def wraps(notice):
    """A notice as published, a line a paragraph, as comments of three kinds, and wrapped at other widths."""
    flat = "\n\n".join(" ".join(p.split()) for p in notice.split("\n\n"))
    lines = notice.strip("\n").split("\n")
    yield notice
    yield "Some words before.\n\n" + flat + "\n\nSome words after"
    yield "/*\n" + "\n".join(f" * {x}".rstrip() for x in lines) + "\n */\nint main"
    yield "\n".join(f"# {x}".rstrip() for x in lines) + "\n#\nimport os"
    yield "\r\n".join(f"//   {x}" for x in lines)
    for width in (20, 200):
        yield "\n\n".join("\n".join(textwrap.wrap(" ".join(p.split()), width, break_long_words=False)) for p in notice.split("\n\n"))


def test_every_rule_fires_on_its_notice(spark):
    rows = [(rule, text) for rule, _, notice in licenses.NOTICES for text in wraps(notice)]
    found = licenses.scan(spark.createDataFrame(rows, "name string, text string").repartition(4)).collect()
    names = {rule: ids for rule, _, ids in licenses.RULES}
    same = {ids: rule for rule, _, ids in reversed(licenses.RULES)}
    assert len(found) == 7 * len(licenses.NOTICES)
    for row in found:
        assert row.rules == [same[names[row.name]]], (row.name, row.text, row.known)
    assert {r.name for r in found if r.licences} == set(names)


def plain_licences(text):
    """Known sentences of a text, line by line in plain Python."""
    known = {s: n for n, s in licenses.SENTENCES.items()}
    total, out = 0, []
    for part in re.split("[.!?:;]+[\"')\\]]*[ \t-\r]+|\n[^A-Za-z0-9\n]*\n", text or ""):
        lines = [" ".join(re.findall("[a-z0-9]+", x.lower())) for x in part.split("\n")]
        lines = [x for x in lines if x]
        total += bool(lines)
        at = next((i for i in range(len(lines)) if " ".join(lines[i:]) in known), len(lines))
        out += [known[x] for x in lines[:at] if x in known]
        out += [known[" ".join(lines[at:])]] if at < len(lines) else []
    return total, out


def test_known_sentences_against_plain_python(spark):
    rng = np.random.default_rng(4)
    notices = [n for _, _, n in licenses.NOTICES]
    rows = []
    for i in range(250):
        parts = []
        for _ in range(rng.integers(0, 5)):
            words = notices[rng.integers(0, len(notices))].split(" ")
            cut = rng.integers(0, len(words)) if rng.random() < 0.3 else len(words)
            parts.append(" ".join(words[:cut]) + ["", "\n", "\n\n", " # \n", "\n * \n", ". "][rng.integers(0, 6)])
            parts.append(["", "and so on\n", "No. ", "a\nb\nc", "\n", "é\n"][rng.integers(0, 6)])
        rows.append((i, "".join(parts)))
    rows += [(300, "x\n" * 3000 + "Licensed under\nthe MIT License"), (301, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_sentences, r.known) for r in licenses.scan(docs).collect()}
    assert got == {i: plain_licences(t) for i, t in rows}
    assert got[300] == (1, ["mit-line-2-1"])


PAGE = """<!DOCTYPE html><html lang="EN"><head><title>A &amp; B</title><style>p{x}</style><script>var t="</p>";</script></head>
<body><!-- no <b>text</b> --><h1>Head</h1><p>One <b>bold</b>
 line<br>next &lt;tag&gt; &eacute;</p><a href="/x?a=1&amp;b=2" title="a > b">link</a><img src='pic.png'><p>1 < 2</body></html>"""


def test_archive_records(spark):
    rows = [(1, "http://h.example/dir/", PAGE), (2, None, None), (3, "http://h.example/", ""), (3, "http://h.example/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("block", F.lit("mine"))
    got = warc.derivative_report(pages, "2024-01-01T00:00:00Z").collect()
    assert len(got) == 8
    by = defaultdict(list)
    for r in got:
        by[r.page_id, r.warc_type].append(r)
        data = r.block.encode()
        assert r.content_length == len(data)
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.warc_headers and f"WARC-Record-ID: {r.record_id}\r\n" in r.warc_headers
        assert f"Content-Length: {len(data)}\r\n" in r.warc_headers
    text, about = by[1, "conversion"][0], by[1, "metadata"][0]
    assert text.refers_to == about.refers_to and text.record_id != about.record_id
    assert text.block == "A & B\nHead\nOne bold line\nnext <tag> é\nlink\n1 < 2"
    envelope = json.loads(about.block)
    assert envelope["Title"] == "A & B" and envelope["Language"] == "en"
    assert envelope["Conversion-Record-ID"] == text.record_id
    assert envelope["HTTP-Headers"]["Content-Length"] == str(len(PAGE.encode()))
    assert [x["url"] for x in envelope["Links"]] == ["http://h.example/x?a=1&b=2", "http://h.example/dir/pic.png"]
    payload = "sha1:" + base64.b32encode(hashlib.sha1(PAGE.encode()).digest()).decode()
    assert about.source_payload_digest == text.source_payload_digest == payload
    assert by[2, "conversion"][0].block == "" and json.loads(by[2, "metadata"][0].block)["Links"] == []
    assert by[3, "metadata"][0] == by[3, "metadata"][1]
    assert warc.derivative_report(pages.limit(0), "x").count() == 0


def plain_scores(rows, alpha=0.4):
    """(doc_id, words, known, score) over real words, with every occurrence left out of its own counts."""
    one, two, texts = Counter(), Counter(), defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().split()
        texts[i].append(w)
        one[None] += bool(w)
        one.update(w)
        two.update(zip([None, *w], w))
    total = sum(n for w, n in one.items() if w is not None)
    for i, lists in texts.items():
        n = known = score = 0
        for w in lists:
            for v, x in zip([None, *w], w):
                again = two[v, x] > 1
                ratio = (two[v, x] - 1) / (one[v] - 1) if again else alpha * max(one[x] - 1, 1) / max(total - 1, 1)
                n, known, score = n + 1, known + again, score + int(np.rint(np.log(ratio) * lm.UNIT))
        yield i, n, known, score


SPECS = [lm.LmSpec(), lm.LmSpec(hot_share=50, parts=3), lm.LmSpec(hot_share=10**9, frequent=200), lm.LmSpec(frequent=1, parts=5)]


@pytest.mark.parametrize("spec", SPECS)
def test_scores(spark, odd_docs, no_docs, spec):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = {(r.doc_id, r.n_words, r.n_known, r.log_score) for r in lm.score(odd_docs, spec).collect()}
    assert got == set(plain_scores(rows))
    assert lm.score(no_docs, spec).count() == 0


@pytest.mark.parametrize("ids", [(-(2**63), 2**63 - 1), (-(2**63), -(2**63) + 1, 2**63 - 1), (5, -(2**63)), (2**63 - 1,), ()])
def test_scores_of_any_id(spark, ids):
    rows = [(i, "a b a b c") for i in ids] + [(None, "a b " * 500), (None, "x y"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for spec in (lm.LmSpec(hot_share=4), lm.LmSpec(frequent=2)):
        got = {(r.doc_id, r.n_words, r.n_known, r.log_score) for r in lm.score(docs, spec).collect()}
        assert got == set(plain_scores(rows))
    # A bigram that one document repeats is known there.
    assert next(r[2] for r in got if r[0] is None) >= 999


def test_scores_over_a_million_words(spark):
    """More different words than the table of frequent ones may hold: the rest is joined."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        n = rng.integers(1, 16_000)
        words = [f"w{k}" for k in rng.integers(0, 10**7, n)] + [f"f{k}" for k in rng.zipf(1.3, n // 3) if k < 10**6]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            rows.append((1000 + i, rows[-1][1][: rng.integers(10, 5000)]))
    assert len({w for _, t in rows for w in t.split()}) > 2**20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spec = lm.LmSpec(frequent=1 << 10)
    got = {(r.doc_id, r.n_words, r.n_known, r.log_score) for r in lm.score(docs, spec).collect()}
    assert got == set(plain_scores(rows))




def test_score_sums_compress():
    """In many parts a document has one word or two in each: its sums there must not take four whole numbers."""
    rng = np.random.default_rng(3)
    doc = np.sort(rng.choice(10**6, 50_000, replace=False)).astype(np.int64)
    one = np.ones(len(doc), np.int64)
    columns = [doc, one, rng.integers(0, 2, len(doc)), -rng.integers(10**6, 2 * 10**7, len(doc))]
    packed = lm._dealt(20, columns)
    size = sum(pa.Codec("snappy").compress(row[c]).size for row in packed.to_pylist() for c in ("doc", "n", "known", "score"))
    assert size <= 9 * len(doc)
    summed = pa.Table.from_batches(lm._sum_batches(iter([packed])))
    assert sorted(zip(*summed.to_pydict().values())) == sorted(zip(*(c.tolist() for c in columns)))
