import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import ODD_TEXTS, docs, empty
from pyspark.sql import functions as F

from tidemark.llm import queries, runs
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(words):
    """All runs by trying every period."""
    n, out = len(words), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            run = words[i : j + p]
            smaller = any(all(run[k] == run[k + q] for k in range(len(run) - q)) for q in range(1, p))
            if len(run) >= max(6, 4 * p) and not smaller:
                out.append((i, len(run), p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, length, p in found for k in range(s + p, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def words_of(text):
    return "".join(" " if ord(c) == 32 or 9 <= ord(c) <= 13 else c for c in text or "").split(" ")


def test_groups_are_the_lyndon_array():
    r = random.Random(3)
    for _ in range(500):
        w = [r.randrange(3) for _ in range(r.randrange(1, 15))]
        n = len(w)
        want = [max(k for k in range(1, n - i + 1) if all(w[i : i + k] < w[i + x : i + k] for x in range(1, k))) for i in range(n)]
        group, size = runs.lyndon_groups(np.array(w))
        assert size.tolist() == want
        lyndon = [tuple(w[i : i + k]) for i, k in enumerate(want)]
        assert all((group[i] == group[j]) == (lyndon[i] == lyndon[j]) for i in range(n) for j in range(n))


def test_runs_equal_brute_force():
    r = random.Random(4)
    for _ in range(2000):
        n, k = r.randrange(1, 45), r.choice([1, 2, 2, 3])
        w = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.5:
            a = r.randrange(n)
            p = 1 + r.randrange((n - a) // 4 + 1)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert runs.word_runs(np.array(w)) == plain(w)
        # Passing over what cannot repeat changes nothing; other texts of the slice do not matter.
        texts = [" ".join(map(str, w)).encode(), b"", " ".join(map(str, w)).encode()]
        assert [tuple(x.values()) for x in runs._runs_of_texts(texts)[1].to_pylist()[2]] == plain(w)


@pytest.mark.parametrize("word", [[5] * 60_000, list(range(7)) * 9_000])
def test_long_loops_are_one_run(word):
    assert [x[:2] for x in runs.word_runs(np.array(word))] == [(0, len(word))]


def test_odd_rows(spark):
    rows = ODD_TEXTS + [(9, "x y x y x y x y tail tail"), (9, "x y x y x y x y tail tail"), (10, "a\x0ba\x0ca\ra\na\ta a\x1cb")]
    got = runs.find_runs(docs(spark, rows)).collect()
    assert got[0].asDict().keys() == {"doc_id", "row", "bytes", "node", "text", "n_words", "runs", "collapsed"}
    assert len(got) == len(rows)
    for r in got:
        w = [x for x in words_of(r["text"]) if x]
        want = plain(w) if len(w) < 1000 else [(0, 30_000, 1)]
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(w), want)
        assert r["collapsed"] == collapsed(w, want)
    assert runs.find_runs(empty(spark)).count() == 0


def test_a_run_column_of_the_input_is_replaced(spark):
    got = runs.find_runs(docs(spark, [(1, "a a a a a a")]).withColumn("Runs", F.lit("old"))).first()
    assert [tuple(x) for x in got["runs"]] == [(0, 6, 1)] and "Runs" not in got.asDict()


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.op13_runs(spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        w = [x for x in words_of(text) if x]
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        # Periods beyond the reach of the plain version are checked by its own rule on short texts.
        found = plain(w) if n < 3000 else runs.word_runs(np.array([hash(x) for x in w]))
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        some += bool(found)
        r = got[doc_id]
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
    assert some > 5
