"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import pytest

from tasteline.llm import periodic

SPEC = periodic.RunSpec()
_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs: for every period the stretches that can't be made longer, kept where no smaller period fits."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(words[x] == words[x + p] for x in range(start, start + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    k, n = rng.randint(1, 4), rng.randint(0, 60)
    words = [bytes([97 + rng.randrange(k)]) for _ in range(n)]
    unit = [bytes([97 + rng.randrange(k)]) for _ in range(rng.randint(1, 8))]
    at = rng.randint(0, n)
    words[at:at] = (unit * 9)[: rng.randint(0, 50)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(300)]
    # Several texts in one call must not see each other.
    assert periodic.find_runs(texts, SPEC) == [brute(t) for t in texts]


def test_texts_that_repeat_everywhere():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 30_000:
        a, b = b, b + a
    assert periodic.find_runs([b], SPEC) == [[]]  # no stretch of it has four periods
    assert periodic.find_runs([[b"x"] * 50_000], SPEC) == [[(0, 50_000, 1)]]
    assert periodic.find_runs([[b"x", b"y"] * 20_000 + [b"x"]], SPEC) == [[(0, 40_001, 2)]]
    # A passage repeated far apart is no run, whatever stands beside it.
    rng = random.Random(1)
    passage = [b"p%d" % i for i in range(20)]
    far = [w for _ in range(3000) for w in [*passage, b"x%d" % rng.randrange(10**9)]]
    assert periodic.find_runs([far], SPEC) == [[]]


def test_other_lengths():
    words = b"a b a b a b c c c".split()
    assert periodic.find_runs([words], periodic.RunSpec(words=3, periods=3)) == [[(0, 6, 2), (6, 3, 1)]]


def expected(doc_id, text):
    words = _SPACE.findall(text or "")
    n = len(words)
    if n and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_report_on_odd_rows(spark):
    rng = random.Random(3)
    vocab = ["é", "b", "c", "long-word", "d"]
    rows = [(i, " \t".join(rng.choice(vocab) for _ in range(rng.randint(0, 90)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\x0b"), (None, "a " * 30), (None, None), (7, "z z z z z z"), (7, "z z z z z z")]
    rows += [(-5, "x y " * 500), (2**63 - 1, "nbsp\xa0joins nbsp\xa0joins"), (203, "w\x0cw\rw w\nw w tail")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, start string, runs int")
    out = periodic.run_report(docs.repartition(3))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [tuple(r) for r in out.select(*columns).collect()]
    order = repr
    assert sorted(got, key=order) == sorted((expected(*r) for r in rows), key=order)


def test_run_list_and_no_rows(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b a b a b a b c"), (2, None), (None, "q q q q q q")], "doc_id long, text string")
    got = {tuple(r) for r in periodic.periodic_runs(docs).collect()}
    assert got == {(1, 0, 8, 2, "a b"), (None, 0, 6, 1, "q")}
    assert periodic.run_report(no_docs).collect() == []
    assert periodic.periodic_runs(no_docs).collect() == []
