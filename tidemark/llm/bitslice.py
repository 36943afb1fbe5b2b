"""Hamming links inside buckets of 64-bit fingerprints, compared as vertical bit planes."""

from __future__ import annotations

import numpy as np

#: Bits after which blocks without a living pair are abandoned.
STEP = 8

#: Words of pairs that are compared at once.
ENTRIES = 16_384


def planes_of(fps: np.ndarray) -> np.ndarray:
    """(64, words) uint64: bit i of word w of plane p is bit p of fingerprint 64 * w + i. One spare word ends each."""
    n = len(fps)
    words = (n + 63) // 64 + 1
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[:n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _pack(mask: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, dtype=np.uint8)
    bits[: len(mask)] = mask
    return np.packbits(bits, bitorder="little").view("<u8")


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose binary counter is above ``radius``, compared from the top bit down."""
    above, equal = over.copy(), ~over
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def near(planes: np.ndarray, word: np.ndarray, shift: np.ndarray, alive: np.ndarray, radius: int) -> tuple:
    """Living pairs that differ in at most ``radius`` bits, as (row, shift of its partner).

    Entry k holds the 64 pairs of rows 64 * word[k] + i with the rows shift[k] further; ``alive`` has a bit for each.
    Each difference plane goes through a full adder with two others, and the sum and carry are added to saturating bit
    counters. After every few planes the entries in which all pairs exceed the radius are abandoned.
    """
    rest = (shift % 64).astype(np.uint64)
    far = word + shift // 64
    last = planes.shape[1] - 1
    size = radius.bit_length()
    counter = [np.zeros(len(word), dtype=np.uint64) for _ in range(size)]
    over = np.zeros(len(word), dtype=np.uint64)

    def difference(p: int) -> np.ndarray:
        row = planes[p]
        # Two shifts, as one by all 64 bits is undefined.
        high = row[np.minimum(far + 1, last)] << (np.uint64(63) - rest) << np.uint64(1)
        return (row[far] >> rest | high) ^ row[word]

    def add(x: np.ndarray, weight: int) -> None:
        nonlocal over
        for k in range(weight, size):
            x, counter[k] = counter[k] & x, counter[k] ^ x
        over |= x

    for start in range(0, 64, STEP):
        for p in range(start, start + STEP, 2):
            x, y = difference(p), difference(p + 1)
            if p % 4 == 0:
                held = x
                add(y, 0)
                continue
            half = held ^ x
            add(half ^ y, 0)
            add(held & x | half & y, 1)
        alive &= ~_exceeds(counter, over, radius)
        keep = np.flatnonzero(alive)
        if not len(keep):
            return keep, keep
        if len(keep) < len(word):
            word, shift, far, rest = word[keep], shift[keep], far[keep], rest[keep]
            alive, over = alive[keep], over[keep]
            counter[:] = [c[keep] for c in counter]
    lanes = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(lanes)
    return word[at] * 64 + lane, shift[at]


def forest(bucket: np.ndarray, fps: np.ndarray, radius: int, accept=None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of a forest that joins what links of at most ``radius`` bits join inside each bucket.

    Of these links only those count for which ``accept`` (rows i, rows j -> bool), if given, is true.

    ``bucket`` is sorted. Pairs that are already joined are not compared again, so a bucket of near copies costs one
    sweep, and no more links than rows leave it.
    """
    n = len(fps)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    planes = planes_of(fps)
    group = np.cumsum(np.concatenate([[0], (bucket[1:] != bucket[:-1]).astype(np.int64)]))
    largest = int(np.bincount(group).max())
    root = np.arange(n)
    left, right = [], []
    done = 0
    while done + 1 < largest:
        words, shifts, alive, held = [], [], [], 0
        while done + 1 < largest and (not words or held < ENTRIES):
            done += 1
            mask = (group[done:] == group[:-done]) & (root[done:] != root[:-done])
            packed = _pack(mask, planes.shape[1])
            at = np.flatnonzero(packed)
            if done == 1:  # neighbours first: what they join need not be compared again
                held = ENTRIES
            words.append(at)
            shifts.append(np.full(len(at), done))
            alive.append(packed[at])
            held += len(at) + 1
        rows, by = near(planes, np.concatenate(words), np.concatenate(shifts), np.concatenate(alive), radius)
        if accept and len(rows):
            good = accept(rows, rows + by)
            rows, by = rows[good], by[good]
        for i, j in zip(rows.tolist(), (rows + by).tolist(), strict=True):
            a, b = i, j
            while root[a] != a:
                root[a] = a = root[root[a]]
            while root[b] != b:
                root[b] = b = root[root[b]]
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(i)
                right.append(j)
        up = root[root]
        while (up != root).any():
            root, up = up, up[up]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
