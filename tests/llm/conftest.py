"""Small documents with every odd case, shared by the tests of the text operators."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string, fp long"


def odd_rows(seed=0):
    """Nulls in any column, blank and very long texts, repeated rows, ties, shared passages, near copies."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    shared = prose(60)
    base = prose(150)
    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    texts += [prose(20) + " " + shared + " " + prose(20) for _ in range(6)]
    texts += [base] * 3
    for _ in range(6):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += ["", " \t\n", None, None, "one", "two words", "Two Words", "a" * 900, "ab " * 400, prose(6000)]
    texts += ["Line one here\nLine one here\n \n# $ symbols & more | <x>\nLine one here", "x\x0by\x0cz\rw", " nbsp   wide é"]
    rows = []
    for i, text in enumerate(texts):
        lang = rng.choice(["en", "de", None])
        source = rng.choice(["s1", "s1", "s2", None, "ß"])
        rows.append((i, text, lang, source, None if text is None else len(text), "big", None, 7))
    rows.append(rows[5])  # the same row again
    rows.append((None, texts[3], "en", "s1", 1, None, "r", None))
    rows.append((None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
