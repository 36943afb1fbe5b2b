import random

import numpy as np
import pytest
import xxhash
from helpers import LOWER, ODD_TEXTS, changed, classes, docs, empty, prose

from tidemark.llm import bitslice, simhash
from tidemark.llm.graph import components


def plain_fingerprint(text):
    words = (text or "").encode().translate(LOWER).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def close(a, b, radius=4):
    return (a ^ b).bit_count() <= radius


@pytest.mark.parametrize("radius", [0, 1, 4, 7, 16])
def test_forest_joins_what_all_pairs_join(radius):
    r = random.Random(radius)
    fps = [r.getrandbits(64)]
    for _ in range(600):
        x = fps[r.randrange(len(fps))] if r.random() < 0.6 else r.getrandbits(64)
        for b in r.sample(range(64), r.randrange(radius + 3)):
            x ^= 1 << b
        fps.append(x)
    bucket = np.sort([r.randrange(12) for _ in fps])
    i, j = bitslice.forest(bucket, np.array(fps, dtype=np.uint64), radius)
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if bucket[a] == bucket[b] and close(fps[a], fps[b], radius)]
    assert classes(range(len(fps)), zip(i.tolist(), j.tolist())) == classes(range(len(fps)), pairs)
    assert len(i) < len(fps)


def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = chain + star + [(5, 5), (7, 3), (None, 4), (2000, 2001), (2001, 2000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    links = [(a, b) for a, b in rows if a is not None]
    assert found == {i: c for i, c in classes({x for p in links for x in p}, links).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_rows", [2, 2048])
def test_groups_equal_brute_force(spark, block_rows):
    rows = list(ODD_TEXTS)
    for k in range(12):
        base = prose(k, 150)
        rows += [(100 + 10 * k + c, changed(base, 7 * k + c, 200)) for c in range(5)]
    frame = docs(spark, rows)
    found = simhash.simhash_groups(frame, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    at = classes(range(len(rows)), [(a, b) for a in range(len(rows)) for b in range(a) if close(prints[a], prints[b])])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[at[k]] = min(i, least.get(at[k], i))
    want = sorted(str((i, prints[k], least.get(at[k]))) for k, (i, _) in enumerate(rows))
    assert sorted(str((r[0], r[1] % 2**64, r[2])) for r in found) == want
    assert len(set(at.values())) < len(rows) - 15


def test_empty_table(spark):
    assert simhash.simhash_groups(empty(spark)).columns == ["doc_id", "simhash", "component_id"]
    assert simhash.simhash_groups(empty(spark)).count() == 0
    assert simhash.without_copies(empty(spark)).count() == 0


def shingles(text, n=5):
    words = (text or "").encode().translate(LOWER).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_one_of_each_group_of_near_copies_stays(spark):
    rows = list(ODD_TEXTS)
    for k in range(15):
        base = prose(k, 400)
        rows += [(1000 + 100 * k, base), (1001 + 100 * k, base.upper()), (1002 + 100 * k, changed(base, k, 100))]
        rows += [(1050 + 100 * k, changed(base, k, 6)), (1051 + 100 * k, prose(500 + k, 300))]
    kept = [r["doc_id"] for r in simhash.without_copies(docs(spark, rows)).collect()]
    sets = {i: shingles(t) for i, t in rows if i and i >= 1000}
    for i, s in sets.items():
        best = max((len(s & o) / len(s | o) for j, o in sets.items() if j < i), default=0)
        assert (i in kept) == (best < 0.8) or 0.72 < best < 0.88, (i, best)
    # NULL and blank texts are one group; so are the two that differ in case, and the repeated row.
    assert sorted(i for i in kept if i is not None and i < 1000) == [1, 4, 6, 7, 8]
    assert kept.count(None) == 1


def test_pairs_just_above_the_limit_are_found_and_less_alike_ones_stay(spark):
    """Exact Jaccard of five-word shingles decides what a pair is; at 0.8 to 0.85 at least 19 in 20 lose a member."""
    rng, near, far, rows = random.Random(3), set(), set(), []
    for k in range(1500):
        words = prose(5000 + k, rng.choice((40, 80, 150, 400)), 10**6).split()
        other = list(words)
        for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.01, 0.06)))):
            other[at] = f"new{rng.randrange(10**6)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, other))
        alike = len(a & b) / len(a | b)
        if 0.8 <= alike < 0.85 or alike < 0.68:
            (near if alike >= 0.8 else far).add(2 * k)
            rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    kept = {r["doc_id"] for r in simhash.without_copies(docs(spark, rows)).collect()}
    lost = sum(i + 1 in kept for i in near)
    assert len(near) > 100 and len(far) > 100 and lost <= len(near) / 20, (lost, len(near))
    assert all(i in kept for i in near | far) and sum(i + 1 not in kept for i in far) <= len(far) / 100
