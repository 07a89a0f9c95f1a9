"""Near-duplicate components against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tasteline.llm.components import components
from tasteline.llm.neardup import JoinSpec, near_duplicates, one_of_each


def shingle_set(text, k):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def links_of(sets, percent):
    """All pairs of different sets that reach the threshold, from one product of zeros and ones."""
    of = Counter(x for s in sets for x in s)
    column = {x: i for i, x in enumerate(x for x, n in of.items() if n > 1)}
    ones = np.zeros((len(sets), len(column)), dtype=np.float32)
    for i, s in enumerate(sets):
        ones[i, [column[x] for x in s if x in column]] = 1
    n = np.array([len(s) for s in sets])
    both = (ones @ ones.T).astype(np.int64)
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    return [(sets[i], sets[j]) for i, j in zip(*np.nonzero(np.triu(linked, 1)))]


def plain(rows, k, percent):
    """(doc_id, n_shingles, component, kept) of each row by comparing all pairs of different sets."""
    sets = [shingle_set(text, k) for _, text in rows]
    least = {}
    for (i, _), s in zip(rows, sets):
        if i is not None and s:
            least[s] = min(i, least.get(s, i))
    parent = {s: s for s in least}

    def find(s):
        while parent[s] is not s:
            parent[s] = parent[parent[s]]
            s = parent[s]
        return s

    for p, q in links_of(list(least), percent):
        p, q = find(p), find(q)
        if p is not q:
            parent[q] = p
            least[p] = min(least[p], least[q])
    for (i, _), s in zip(rows, sets):
        c = None if i is None else least[find(s)] if s else i
        yield i, len(s), c, i is None or i == c


def compared(spark, rows, spec):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return Counter(map(tuple, near_duplicates(docs, spec).collect())), Counter(plain(rows, spec.words, spec.percent))


@pytest.mark.parametrize("spec", [JoinSpec(words=3, percent=85), JoinSpec()])
def test_odd_documents(spark, odd_docs, no_docs, spec):
    got, wanted = compared(spark, [(r.doc_id, r.text) for r in odd_docs.collect()], spec)
    assert got == wanted
    assert near_duplicates(odd_docs, spec).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(no_docs, spec).count() == 0


@pytest.mark.parametrize("leaf", [2, 8])
def test_large_nodes_are_branched(spark, leaf):
    """Many documents share a passage, some of them are chains of near copies."""
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(80)]
    rows, i = [], 100
    for _ in range(12):
        w = passage + [rng.choice(vocab) for _ in range(25)]
        for _ in range(rng.randint(1, 5)):  # each a little further from the first
            rows.append((i, " ".join(w)))
            i -= 1
            w = list(w)
            for _ in range(2):
                w[rng.randrange(len(w))] = rng.choice(vocab)
    got, wanted = compared(spark, rows, JoinSpec(words=3, percent=70, leaf=leaf))
    assert got == wanted
    assert len({c for _, _, c, _ in wanted}) < len(rows)


@pytest.mark.parametrize("spec", [JoinSpec(words=3, percent=85), JoinSpec()])
def test_nodes_of_thousands(spark, spec):
    """5,000 texts about one passage, each with one to four words of its own: stars, chains, and no links at all."""
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(5000):
        w = list(passage)
        for at in rng.sample(range(60), rng.choice([1, 4, rng.randint(1, 4)])):
            w[at] = f"x{rng.randrange(50_000)}" if rng.random() < 0.8 else f"y{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    got, wanted = compared(spark, rows, spec)
    assert got == wanted


@pytest.mark.parametrize("percent", [80, 85])
def test_links_at_the_threshold_are_found(spark, percent):
    """Of pairs just above the threshold, in nodes they share with many others, at least 0.9 are linked; here, all."""
    rng = random.Random(percent)
    common = [f"c{i}" for i in range(25)]
    rows = []
    for i in range(600):
        own = [f"w{i}-{j}" for j in range(100)]
        other = list(own)
        # Changed words at the end lose a shingle each, so the pair stands at the threshold or a little above.
        lost = (1 - percent / 100) * (len(own) + len(common)) / (1 + percent / 100)
        for j in range(int(lost) - rng.randint(1, 3)):
            other[-1 - j] = f"z{i}-{j}"
        rows += [(2 * i, " ".join(common + own)), (2 * i + 1, " ".join(common + other))]
    got, wanted = compared(spark, rows, JoinSpec(words=3, percent=percent))
    pairs = {(i, c) for i, _, c, _ in wanted if i != c}
    assert len(pairs) > 500
    assert len(pairs & {(i, c) for i, _, c, _ in got}) == len(pairs) and got == wanted


def test_rows_that_share_an_id(spark):
    def text(name, *changed):
        return " ".join(f"{name}{'x' if i in changed else ''}{i}" for i in range(60))

    rows = [(1, text("w")), (1, text("v")), (2, text("w", 0)), (3, text("v", 0)), (1, text("w")), (9, text("u")), (9, text("t"))]
    rows += [(4, text("t", 59)), (9, None), (9, ""), (None, text("w"))]
    got, wanted = compared(spark, rows, JoinSpec())
    assert got == wanted
    assert {(i, c) for i, _, c, _ in got} >= {(2, 1), (3, 1), (4, 4), (9, 9), (9, 4)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = Counter(map(tuple, one_of_each(docs, JoinSpec()).collect()))
    # Components 1 of w and 1 of v are two: each keeps a row. Blank rows and those without an id stay.
    assert left[1, text("w")] + left[1, text("v")] == 1
    assert left[4, text("t", 59)] == left[9, text("u")] == left[9, None] == left[9, ""] == left[None, text("w")] == 1
    assert sum(left.values()) == 6


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)]
    pairs += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {x: x for p in pairs for x in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    rng.shuffle(pairs)
    got = {r.id: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
