"""Periodic runs of words, from Lyndon arrays by the first phase of Baier's suffix sorter.

A run is a maximal stretch of words with smallest period q. The first phase of the sorter (grouping) refines groups of
suffixes from the highest down until two suffixes share a group exactly if their longest Lyndon prefixes are the same
words; a group's context length is then the Lyndon array. Under one of the two orders of the words the Lyndon root of
a run heads every position a period apart, so equal groups that far apart, for each order, name a root; extending it
to both sides by the longest common extension with itself a period away gives the run.

In a run of length >= max(6, 4 * period) every four words of it occur at least twice in it. Stretches of a text in
which no four words come again can hold no run and are passed over; the sorter sees all others.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import from_texts

#: Least exponent and least length (in words) of a reported run; what is passed over rests on both.
EXPONENT, LENGTH = 4, 6

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_groups(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group and longest Lyndon word of each suffix of ``ranks`` (small ints); an end sorts before all.

    Two suffixes have one group exactly if their longest Lyndon prefixes are equal. A final suffix moves the nearest
    one to its left that is not final yet, so there are at most as many moves as suffixes.
    """
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    members = [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1)]
    group = np.empty(n, dtype=np.int64)
    group[order] = np.repeat(np.arange(len(members)), [len(m) for m in members])
    group = group.tolist()
    size = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    # Entry i + 1 leads towards the nearest suffix up to i that is not final; entry 0 is "none".
    left = list(range(n + 1))
    top = len(members) - 1
    while top >= 0:
        here = [i for i in members[top] if group[i] == top]
        members[top] = None
        for i in here:
            left[i + 1] = i
        heads: dict[int, int] = {}
        for i in here:
            x = i
            while left[x] != x:
                left[x] = x = left[left[x]]
            left[i + 1] = x
            if x:
                heads[x - 1] = heads.get(x - 1, 0) + 1
        moves = heads.items() if len(heads) < 2 else sorted(heads.items(), key=lambda move: -move[1])
        made: dict[tuple[int, int], int] = {}
        for j, times in moves:
            old = group[j]
            new = made.get((times, old))
            if new is None:
                new = made[times, old] = len(members)
                members.append([])
                size.append(size[old] + times * size[top])
                below.append(old)
                above.append(above[old])
                below[above[old]] = new
                above[old] = new
            members[new].append(j)
            group[j] = new
        top = below[top]
    group = np.array(group, dtype=np.int64)
    return group, np.array(size, dtype=np.int64)[group]


def _common(a: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common prefix of ``a[i:]`` and ``a[j:]``, i < j, in steps that double."""
    start, step = j, 32
    while j < len(a):
        block = a[j : j + step] != a[i : i + len(a[j : j + step])]
        if block.any():
            return j - start + int(block.argmax())
        i, j, step = i + len(block), j + len(block), step * 2
    return j - start


def word_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of exponent ``EXPONENT`` and ``LENGTH`` items or more, by start, then period."""
    n, found = len(ids), {}
    values, ranks = np.unique(ids, return_inverse=True)
    back = ids[::-1]
    for order in (ranks, len(values) - 1 - ranks):
        group, period = lyndon_groups(order)
        at = np.flatnonzero(np.arange(n) + (EXPONENT - 1) * period <= n)
        for k in range(1, EXPONENT - 1):
            at = at[group[at] == group[at + k * period[at]]]
        before = at - period[at]
        at = at[(before < 0) | (group[at] != group[np.maximum(before, 0)])]
        for i, p in zip(at.tolist(), period[at].tolist()):
            start = i - _common(back, n - i - p, n - i)
            length = i + p + _common(ids, i, i + p) - start
            if length >= max(LENGTH, EXPONENT * p):
                found[start, p] = length
    return [(start, found[start, p], p) for start, p in sorted(found)]


def _again(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word positions whose four words, within one text, occur there at another position too."""
    at = np.flatnonzero(np.arange(len(ids)) + 4 <= ends[doc])
    if not len(at):
        return at
    pair = np.zeros(len(ids), dtype=np.int64)
    pair[:-1] = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1]
    wide = int(pair.max()) + 1
    four = np.unique(pair[at] * wide + pair[at + 2], return_inverse=True)[1]
    key = four * len(ends) + doc[at]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return at[twice]


def _runs_of_texts(texts: list[bytes]) -> list[pa.Array]:
    words = [text.split() for text in texts]
    names: dict = defaultdict(count().__next__)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ids = np.fromiter((names[w] for ws in words for w in ws), dtype=np.int64, count=int(lengths.sum()))
    del names
    ends = np.cumsum(lengths)
    at = _again(ids, np.repeat(np.arange(len(words)), lengths), ends)
    found: list[list] = [[] for _ in words]
    # Positions next to each other, in one text, make a stretch; it ends three words behind the last of them.
    edge = np.flatnonzero(np.diff(at) != 1) + 1 if len(at) else np.empty(0, dtype=np.int64)
    for stretch in np.split(at, edge):
        if len(stretch) >= LENGTH - 3:
            begin, end = int(stretch[0]), int(stretch[-1]) + 4
            text = int(np.searchsorted(ends, begin, side="right"))
            shift = begin - int(ends[text] - lengths[text])
            found[text] += [(start + shift, length, period) for start, length, period in word_runs(ids[begin:end])]
    kept = []
    for ws, runs in zip(words, found):
        runs.sort(key=lambda run: (run[0], run[2]))
        if runs:
            keep = np.zeros(len(ws) + 1, dtype=np.int64)
            for start, length, period in runs:
                keep[start + period] += 1
                keep[start + length] -= 1
            ws = [w for w, gone in zip(ws, np.cumsum(keep).tolist()) if not gone]
        kept.append(b" ".join(ws))
    lists = [[dict(zip(("start", "length", "period"), run)) for run in runs] for runs in found]
    return [pa.array(lengths), pa.array(lists, pa.list_(RUN)), pa.array(kept, pa.binary())]


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, runs [start, length, period] by start, then period, and the collapsed text.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a run is a maximal stretch with smallest period q of at least
    max(6, 4 q) words. ``collapsed`` joins by a space the words that no run holds after its first q words. Other columns
    pass through; a column with the name of a new one is replaced. NULL, empty and blank texts have no words, no runs
    and an empty collapsed text. Repeated rows are handled one by one; an empty table gives no rows. Memory per task
    grows with the longest text alone. There is no shuffle.
    """
    ddl = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    out = from_texts(docs, text_col, ddl, lambda: _runs_of_texts)
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
