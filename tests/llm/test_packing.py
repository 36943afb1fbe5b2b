import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_TEXTS, docs, empty, prose
from tokenizers import Tokenizer

from tidemark.llm import packing


def check_plan(histogram, size):
    runs, got, ranks = packing.plan(histogram, size), Counter(), defaultdict(list)
    for run in runs:
        at = 0
        for length, first, copies, offset in run.slots:
            assert offset == at
            at += length * copies
            got[length] += copies * run.count
            ranks[length].append((first, first + copies * run.count))
        assert at == run.used <= size
    assert got == Counter(histogram)
    for spans in [*ranks.values(), [(r.base, r.base + r.count) for r in runs]]:
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return sum(r.count for r in runs)


@pytest.mark.parametrize("low,high,n", [(1, 2048, 3000), (600, 1100, 2000), (300, 2000, 500), (1, 40, 5000), (1025, 2047, 300), (700, 701, 90)])
def test_plan_holds_every_length_once(low, high, n):
    r = random.Random(n)
    histogram = dict(Counter(r.randint(low, high) for _ in range(n)))
    bins = check_plan(histogram, 2048)
    # First fit decreasing on the lengths one by one.
    open_bins = []
    for length in sorted((x for x, c in histogram.items() for _ in range(c)), reverse=True):
        k = next((k for k, room in enumerate(open_bins) if room >= length), None)
        if k is None:
            open_bins.append(2048 - length)
        else:
            open_bins[k] -= length
    assert bins <= len(open_bins)


def test_plan_by_groups_beats_best_fit_where_gaps_cannot_be_filled():
    r = random.Random(0)
    histogram = dict(Counter(r.randint(600, 1100) for _ in range(20_000)))
    assert sum(x.count for x in packing.plan(histogram, 2048)) < sum(x.count for x in packing.plan_by(histogram, 2048, 1 / 2, 64))


def test_plan_of_nothing_and_of_single_lengths():
    assert packing.plan({}, 2048) == []
    assert check_plan({2048: 7}, 2048) == 7
    assert check_plan({1: 5000}, 2048) == 3


@pytest.mark.parametrize("ranked_rows", [3, 100_000])
def test_pack_is_exact(spark, ranked_rows):
    rows = list(ODD_TEXTS) + [(100 + k, prose(k, 40 * k)) for k in range(30)] + [(200, "a<|endoftext|>b")]
    found = packing.pack(docs(spark, rows), ranked_rows=ranked_rows, with_ids=True)
    got = found.collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for parts in by.values():
        parts.sort()
        ends = [0, *(a + n for a, n, _ in parts)]
        assert [a for a, _, _ in parts] == ends[:-1] and ends[-1] <= 2048
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(found).collect()}
    assert whole == {s: [x for _, _, ids in parts for x in ids] for s, parts in by.items()}


def test_empty_table(spark):
    assert packing.pack(empty(spark)).count() == 0
