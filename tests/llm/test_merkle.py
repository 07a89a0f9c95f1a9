"""The manifest against trees built level by level in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tasteline.llm import merkle
from tests.llm.conftest import odd_rows


def joined(digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return joined(field(x) for x in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([joined(row[i : i + 8]) for i in range(0, len(row), 8)])
    return levels


def brute(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row["lang"], []).append((row["doc_id"], leaf(row, row["text"]), row))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = levels_of([x[1] for x in langs[lang]])
    crown = levels_of([trees[lang][-1][0] for lang in order])
    root = crown[-1][0]
    out = []
    for t, lang in enumerate(order):
        for i, (doc_id, own, row) in enumerate(langs[lang]):
            here, path = own, []
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = row["text"]
                lowered = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                here = leaf(row, lowered)
            for levels, at in ((trees[lang], i), (crown, t)):
                for row_of in levels[:-1]:
                    first = at // 8 * 8
                    run = row_of[first : first + 8]
                    left, right = run[: at - first], run[at - first + 1 :]
                    path += left + right
                    here = joined([*left, here, *right])
                    at //= 8
            out.append((doc_id, own, trees[lang][-1][0], root, joined(path), here, here == root))
    return sorted(out, key=repr)


def check(spark, rows, schema, parts=3):
    docs = spark.createDataFrame(rows, schema).repartition(parts)
    got = sorted((tuple(r) for r in merkle.manifest_report(docs).collect()), key=repr)
    assert got == brute([dict(zip(docs.columns, r)) for r in rows])
    return got


def test_places_cover_a_tree_once():
    for levels in range(1, 6):
        seen = np.concatenate([merkle._level_places(levels, d) for d in range(levels)])
        assert sorted(seen) == list(range(merkle._nodes(levels)))


def test_lower_subtrees_are_stretches():
    # A block's levels are cut 2 + 3: what hangs below a node of the second level is contiguous.
    for child in range(8**2):
        at = [int(merkle.place(5, 2, child))]
        for depth in (3, 4):
            width = 8 ** (depth - 2)
            at += [int(merkle.place(5, depth, i)) for i in range(child * width, (child + 1) * width)]
        assert sorted(at) == list(range(min(at), min(at) + 73))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513, 4095, 4096])
def test_block_siblings_fold_to_the_root(n):
    leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
    height = merkle.height_of(n)
    nodes = merkle.build_block(leaves, height)
    assert nodes[:32].hex() == levels_of([x.hex() for x in leaves])[-1][0]
    for i in {0, n // 2, n - 1, n // 8 * 8 % n}:
        path = merkle.siblings(nodes, height, n, i)
        assert merkle.fold(leaves[i], i, n, path) == (nodes[:32], len(path))
        assert merkle.fold(hashlib.sha256(b"no").digest(), i, n, path)[0] != nodes[:32]


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, fp long"
    check(spark, odd_rows(), schema)


def test_many_languages_and_clashing_names(spark):
    rng = random.Random(5)
    langs = [None, "", *(f"l{i}" for i in range(20)), "é", "zz", "￿", "\U0001f600"]
    rows = [(i, rng.choice(["Aa", "bb", None, "", "É Z"]), rng.choice(langs), None, i, "x", "y", 1, 2) for i in range(300)]
    check(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, tree string, root string, n int, id int")


def test_more_leaves_than_a_block(spark):
    rows = [(i, f"T{i}", "en" if i % 7 else "de", "s", None) for i in range(11_000)]
    got = check(spark, rows, "doc_id long, text string, lang string, source string, n_chars long", 8)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_one_row_and_none(spark, no_docs):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    (only,) = check(spark, [(1, "only", None, None, None)], schema)
    assert only[1] == only[2] == only[3] and only[4] == hashlib.sha256(b"").hexdigest()
    assert merkle.manifest_report(no_docs).collect() == []
