import numpy as np
import pytest

from tidemark.llm import ann

ROWS = "vec_id long, embedding array<float>, dim int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], ROWS)


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        scored = []
        for i, w in rows:
            if i != q and len(w) == len(v):
                a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                scored.append((-(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), i))
        out[q] = sorted(scored)[:k]
    return out


@pytest.mark.parametrize("shard_nodes", [150, 8192])
def test_recall_and_exact_scores(spark, shard_nodes):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(900)]
    # A third of all rows are one vector; ties go to the smaller id.
    rows += [(1000 + i, rows[3][1]) for i in range(450)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24), (2004, [1.0, None] * 12), (2005, [float("inf")] * 24),
           (None, [1.0] * 24), (2006, [1.0, 2.0]), (2006, [1.0, 2.0])]
    index = ann.build_index(frame(spark, rows + odd), "vec_id", "embedding", copies=6, shard_nodes=shard_nodes)
    queries = [x for x in rows if x[0] % 20 == 0]
    got = ann.nearest(index, frame(spark, queries + odd + queries[:3]), "vec_id", "embedding", k=5, block_queries=17).collect()
    want, hits, total = exact(rows, queries, 5), 0, 0
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {q for q, _ in queries}
    for q, best in want.items():
        found = sorted(by[q])
        assert [k for k, _, _ in found] == [1, 2, 3, 4, 5]
        vectors = dict(rows)
        for _, i, s in found:
            a, b = (np.array(vectors[x], np.float32).astype(float) for x in (q, i))
            assert i != q and abs(s - (a @ b) / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12
        assert [(-round(s, 12), i) for _, i, s in found] == sorted((-round(s, 12), i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in best})
        total += 5
    assert hits >= 0.95 * total
    copied = sorted(by[1020])
    assert [i for _, i, _ in copied] == [3, 1000, 1001, 1002, 1003]


def test_fewer_candidates_than_asked_and_empty_tables(spark):
    few = frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])])
    index = ann.build_index(few, "vec_id", "embedding", copies=6)
    got = ann.nearest(index, few, "vec_id", "embedding", k=5).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 1)]
    none = ann.build_index(frame(spark, []), "vec_id", "embedding", copies=6)
    assert ann.nearest(none, few, "vec_id", "embedding").count() == 0
    assert ann.nearest(index, frame(spark, []), "vec_id", "embedding").count() == 0
