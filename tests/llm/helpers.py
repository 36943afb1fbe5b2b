"""Rows that every operator must cope with, and plain versions to compare with."""

from __future__ import annotations

import random

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Nulls, empty and blank texts, ties, repeated rows and ids, a very long text; an extra column clashes with inner names.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "Alpha beta gamma delta epsilon zeta"), (5, "alpha BETA gamma delta epsilon zeta"),
    (6, "alpha"), (6, "alpha"), (None, "no id here"), (None, None), (7, "é ñ 日本 \x00 x" * 3), (8, "word " * 30_000),
]

DOCS = "doc_id long, text string, row string, bytes long, node int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "kept", 5, None) for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


def changed(text: str, seed: int, every: int) -> str:
    """The text with about one word in ``every`` replaced."""
    r = random.Random(seed)
    return " ".join("new%d" % r.randrange(10**6) if r.randrange(every) == 0 else w for w in text.split())


def classes(ids, links) -> dict:
    """Least member of each id's class."""
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
