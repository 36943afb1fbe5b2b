import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, radix, trie
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, node int"


def plain(convs):
    """Rows of the trie of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    rows = [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    ]
    return sorted(rows, key=str)


def gathered(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def rows_of(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"] and df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_up(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 5 * n), n):
        for t in range(r.choice([0, 1, 2, 3, 7, 12]) + 1):
            rows.append((c, t, r.choice(["user", "assistant"]), "same" if r.random() < 0.7 else f"é{r.randrange(4)}", 1))
    return rows


def test_layouts_grow_and_find():
    r = random.Random(5)
    for n in (3, 4, 5, 16, 17, 48, 49, 256):
        tree = radix.Tree()
        keys = [bytes([b, 7]) for b in r.sample(range(256), n)]
        for k, key in enumerate(keys):
            tree.insert(key, k)
        kind = radix.Sorted if n <= 16 else radix.Indexed if n <= 48 else radix.Direct
        assert type(tree.root.kids) is kind and len(list(tree.root.kids.values())) == n
        assert all(tree.root.kids.get(key[0]).rows == [k] for k, key in enumerate(keys))
        assert n == 256 or tree.root.kids.get(next(b for b in range(256) if bytes([b, 7]) not in keys)) is None


def test_paths_are_compressed_and_split():
    tree = radix.Tree()
    for k, key in enumerate([b"abcdef", b"abcxyz", b"abc", b"", b"abcdef"]):
        tree.insert(key, k)
    a = tree.root.kids.get(ord("a"))
    assert (tree.root.rows, a.path, a.rows, a.kids.get(ord("d")).rows) == ([3], b"abc", [2], [0, 4])


@pytest.mark.parametrize("shard_turns", [10**6, 300, 25])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = made_up(shard_turns, 150)
    # A third of all conversations are one and the same.
    rows += [(c, t, "user", "hot", 1) for c in range(10_000, 10_075) for t in range(3)]
    convs = trie.ordered_turns(spark.createDataFrame(rows, TURNS))
    assert rows_of(trie.prefix_trie(convs, shard_turns)) == plain(gathered(rows))


def test_a_long_conversation_and_its_prefix(spark):
    rows = [(c, t, "user", str(t), 1) for c, n in ((1, 3000), (2, 1500), (3, 1500)) for t in range(n)]
    convs = trie.ordered_turns(spark.createDataFrame(rows, TURNS))
    assert rows_of(trie.prefix_trie(convs, 2000)) == plain(gathered(rows))


def test_odd_rows(spark):
    rows = [(1, None, None, None, 1), (1, 0, "", "", 1), (1, 0, "b", "x", 1), (1, 0, "a", "y", 1), (1, 0, "a", "y", 1), (2, 5, None, "", 1),
            (None, 1, "user", "lost", 1), (3, 0, "ab", "c", 1), (4, 0, "a", "bc", 1), (5, 0, "user", "é" * 100_000, 1)]
    convs = trie.ordered_turns(spark.createDataFrame(rows, TURNS))
    assert rows_of(trie.prefix_trie(convs)) == plain(gathered(rows))
    no_turns = convs.withColumn("turns", F.when(F.col("conv_id") < 3, F.col("turns")))
    want = plain({c: t if c < 3 else [] for c, t in gathered(rows).items()})
    assert rows_of(trie.prefix_trie(no_turns)) == want
    assert trie.prefix_trie(trie.ordered_turns(spark.createDataFrame([], TURNS))).count() == 0


def remade(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain(remade(gathered(rows)))
    assert rows_of(queries.op12_trie(spark, SF)) == want
    assert max(Counter(r[3] for r in want)) > 2


def test_rebuilding_without_a_base_or_turns(spark):
    rows = [(c, t, "u", f"{c}-{t}", 1) for c in (1, 2, 5, 6, 8, 14) for t in range(c % 4 + 1)]
    convs = trie.ordered_turns(spark.createDataFrame(rows, TURNS))
    want = remade(gathered(rows))
    assert [] in want.values()
    assert rows_of(trie.prefix_trie(queries.rebuilt(convs))) == plain(want)
