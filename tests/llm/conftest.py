from __future__ import annotations

import random

import pytest


def _texts():
    rng = random.Random(5)
    vocabulary = [a + b for a in "the an re ti on es".split() for b in ("", "nd", "ing", "ou", "é", "ß")]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",", "!\n"]) for _ in range(n))

    base = [prose(rng.randint(1, 160)) for _ in range(30)]
    near = [base[3] + " tail", base[4].replace("the", "THE")]
    passage = prose(90)
    odd = [None, "", " ", "\n\n", "a", "a b", "x" * 5000, "é" * 300, "\x01 \x1c \x0b", "same words " * 400, "日本 語 " * 50]
    rows = base + base[:5] + near + [base[7] + "\n" + passage, passage + "\n" + base[8]] + odd + [prose(6000)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): prose, copies, near copies, a shared passage, odd texts, a long one."""
    return _texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with a source, a null id, a row that is there twice, and columns that clash with results."""
    sources = ["b", "a", None, "c", "b", "b"]
    rows = [(i, t, "en", sources[i % 6], len(t or ""), True, i, "s", "x") for i, t in texts]
    rows += [rows[2], rows[2], (None, "no id here", "en", "a", 10, False, 0, "s", "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, "
                                       "n_words int, score string, word string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
