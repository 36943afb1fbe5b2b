import re

import pytest
from helpers import ODD_TEXTS, docs, empty, prose

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items, size=10):
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for a in range(max(1, len(v) - size + 1) if v else 0):
                window = v[a : a + size]
                for x in range(len(w) - len(window) + 1):
                    if w[x : x + len(window)] == window:
                        hit |= set(range(x, x + len(window)))
                        found.add("" if item is None else str(item))
        out.append((str(i), len(w), len(hit), sorted(found)))
    return sorted(out)


def rows_of(found):
    return sorted((str(r["doc_id"]), r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in found.collect())


ITEMS = [(10, prose(1, 30, 50)), (2, prose(2, 12)), (3, "Short ITEM, text"), (3, "other words of item three"), (None, "nameless item here"),
         (5, None), (6, ""), (7, "?!"), (8, prose(1, 30, 50)), (9, "again again again")]


@pytest.mark.parametrize("block_bytes", [1 << 24, 150])
def test_equals_brute_force(spark, block_bytes):
    rows = list(ODD_TEXTS) + [
        (20, "x " + prose(1, 30, 50).upper() + ", y"), (21, " ".join(prose(1, 30, 50).split()[5:17])),
        (22, " ".join(prose(1, 30, 50).split()[:9])), (23, "a short-item (text) in it"), (24, "again again again again"),
        (25, prose(2, 12) + " " + prose(2, 12)), (26, prose(9, 500, 50)), (27, "short item"), (27, "nameless; item here?"),
    ]
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc int")
    found = decontaminate.contamination(docs(spark, rows), items, block_bytes=block_bytes)
    assert rows_of(found) == plain(rows, ITEMS)


def test_proximity_allows_slop(spark):
    w = prose(3, 12).split()
    near = " ".join(w[:5] + ["inserted"] + w[5:])
    far = " ".join(w[:5] + ["a b c d e"] + w[5:])
    items = spark.createDataFrame([(1, " ".join(w))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs(spark, [(1, near), (2, far), (3, " ".join(w))]), items).collect()}
    assert [got[k]["near"] for k in (1, 2, 3)] == [["1"], [], ["1"]]
    assert [got[k]["items"] for k in (1, 2, 3)] == [[], [], ["1"]]


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty(spark), items).count() == 0
    found = decontaminate.contamination(docs(spark, ODD_TEXTS), items)
    assert rows_of(found) == plain(ODD_TEXTS, [])
