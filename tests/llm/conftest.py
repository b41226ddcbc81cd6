"""Small documents with everything that an operator must stand."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, n_chars long, score double, kept string, part int"


def words(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


@pytest.fixture(scope="session")
def corpus():
    """Texts by ``doc_id``: copies, near copies, shared passages, odd and long texts."""
    rng = random.Random(7)
    texts = {i: words(rng, rng.randrange(1, 120)) for i in range(60)}
    passage = words(rng, 40)
    for i in range(60, 80):
        texts[i] = f"{words(rng, 10)}\n{passage}\n{words(rng, 10)}"
    base = words(rng, 200).split()
    for i in range(80, 100):
        own = list(base)
        own[rng.randrange(200)] = "changed"
        texts[i] = " ".join(own)
    for i in range(100, 110):
        texts[i] = texts[5]
    texts[110] = "Ünïcödé Текст 漢字 😀 " * 30
    texts[111] = "a" * 20000
    texts[112] = ("ab " * 40 + "\n") * 50
    texts[113] = words(rng, 9000)
    texts[114] = " \t\n "
    texts[115] = "one"
    texts[116] = "ONE two Three four"
    texts[117] = "one TWO three FOUR"
    return texts


@pytest.fixture(scope="session")
def odd(spark, corpus):
    """The corpus with NULLs, an empty text, repeated rows, and columns whose names clash."""
    rows = [(i, t, "en", len(t), 0.5, "x", 1) for i, t in corpus.items()]
    rows += [
        (200, None, None, None, None, None, None),
        (201, "", None, 0, None, None, None),
        (None, corpus[3], "en", 1, 0.1, "y", 2),
        (None, None, None, None, None, None, None),
        (3, corpus[3], "en", len(corpus[3]), 0.5, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def by_id():
    """Rows of a frame by ``doc_id``; rows that repeat one must be equal."""

    def collect(df):
        out = {}
        for row in df.collect():
            assert row.doc_id is None or out.setdefault(row.doc_id, row) == row
        return out

    return collect
