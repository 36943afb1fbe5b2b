"""Adaptive radix tree over byte strings, and the turn-aligned nodes of a conversation trie in it.

A node grows from 4 to 16, 48 and 256 places and holds the bytes that its keys share below its parent. Keys are rows of
fixed-width big-endian turn ids, so a depth of the trie is a multiple of the width: it may lie inside a compressed path,
and branches in the middle of a turn id are no nodes of the trie.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field


class Sorted:
    """Up to 4 or 16 children, found by search among sorted bytes."""

    def __init__(self, room: int):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte):
        k = bisect_left(self.bytes, byte)
        return self.kids[k] if k < len(self.bytes) and self.bytes[k] == byte else None

    def put(self, byte, kid):
        k = bisect_left(self.bytes, byte)
        if k < len(self.bytes) and self.bytes[k] == byte:
            self.kids[k] = kid
            return self
        if len(self.kids) == self.room:
            bigger = Sorted(16) if self.room == 4 else Indexed()
            for b, other in zip(self.bytes, self.kids):
                bigger.put(b, other)
            return bigger.put(byte, kid)
        self.bytes.insert(k, byte)
        self.kids.insert(k, kid)
        return self

    def values(self):
        return self.kids


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    def __init__(self):
        self.slot, self.kids = bytearray(256), []

    def get(self, byte):
        k = self.slot[byte]
        return self.kids[k - 1] if k else None

    def put(self, byte, kid):
        k = self.slot[byte]
        if k:
            self.kids[k - 1] = kid
            return self
        if len(self.kids) == 48:
            bigger = Direct()
            for b in range(256):
                if self.slot[b]:
                    bigger.put(b, self.kids[self.slot[b] - 1])
            return bigger.put(byte, kid)
        self.kids.append(kid)
        self.slot[byte] = len(self.kids)
        return self

    def values(self):
        return self.kids


class Direct:
    """A place for every byte."""

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte):
        return self.kids[byte]

    def put(self, byte, kid):
        self.kids[byte] = kid
        return self

    def values(self):
        return [kid for kid in self.kids if kid is not None]


class Node:
    """``path``: the bytes below the parent, its branching byte first; ``rows``: numbers of the keys that end here."""

    __slots__ = ("path", "kids", "rows", "bottom", "total")

    def __init__(self, path: bytes, rows: list[int]):
        self.path, self.rows, self.kids = path, rows, None


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if b.startswith(a[:middle], at) else (low, middle - 1)
    return low


class Tree:
    def __init__(self):
        self.root = Node(b"", [])

    def insert(self, key: bytes, row: int) -> None:
        node, parent, at = self.root, None, 0
        while True:
            m = _shared(node.path, key, at)
            if m < len(node.path):
                upper = Node(node.path[:m], [])
                node.path = node.path[m:]
                upper.kids = Sorted(4).put(node.path[0], node)
                parent.kids = parent.kids.put(upper.path[0], upper)
                node = upper
            at += m
            if at == len(key):
                node.rows.append(row)
                return
            kid = node.kids.get(key[at]) if node.kids else None
            if kid is None:
                node.kids = (node.kids or Sorted(4)).put(key[at], Node(key[at:], [row]))
                return
            node, parent = kid, node


@dataclass(slots=True)
class Total:
    """What lies below a point of the tree: keys, least id, first and last row, and trie nodes without a parent yet."""

    n: int = 0
    least: int | None = None
    first: int = 1 << 62
    last: int = -1
    tops: list[int] = field(default_factory=list)
    leaves: int = 0
    saved: int = 0

    def add(self, other: Total) -> None:
        self.n += other.n
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.first, self.last = min(self.first, other.first), max(self.last, other.last)
        self.tops, small = (other.tops, self.tops) if len(other.tops) > len(self.tops) else (self.tops, other.tops)
        self.tops.extend(small)
        self.leaves += other.leaves
        self.saved += other.saved


@dataclass(slots=True)
class TrieNode:
    """``open`` nodes hold the first or last row of the tree: other trees may hold them too. Counts of an open node are
    those below its closed children alone; ``total`` belongs to it and all below it otherwise."""

    depth: int
    least: int
    n: int
    children: int
    leaves: int
    saved: int
    size: int
    open: bool
    on_first: bool
    rows: list[int]
    parent: int | None = None


def trie_nodes(tree: Tree, ids: list[int], sizes: list, width: int) -> list[TrieNode]:
    """All nodes of the trie; ``ids`` and ``sizes`` (bytes of each turn) belong to the rows of the tree."""
    order, stack = [], [tree.root]
    tree.root.bottom = 0
    while stack:
        node = stack.pop()
        order.append(node)
        for kid in node.kids.values() if node.kids else ():
            kid.bottom = node.bottom + len(kid.path)
            stack.append(kid)
    out: list[TrieNode] = []
    end = len(ids) - 1
    for node in reversed(order):
        total = Total()
        for kid in node.kids.values() if node.kids else ():
            total.add(kid.total)
            kid.total = None
        if node.rows:
            here = [ids[r] for r in node.rows]
            total.add(Total(len(here), min(here), min(node.rows), max(node.rows)))
        top = node.bottom - len(node.path)
        for at in range(node.bottom - node.bottom % width, top - (node is tree.root), -width):
            depth, index = at // width, len(out)
            size = int(sizes[total.first][depth - 1]) if depth else 0
            made = TrieNode(depth, total.least, total.n, len(total.tops), total.leaves, total.saved, size,
                            total.first == 0 or total.last == end, total.first == 0, node.rows if at == node.bottom else [])
            for t in total.tops:
                out[t].parent = index
            if made.open:
                total.tops, total.leaves, total.saved = [], 0, 0
            else:
                made.leaves = made.leaves if total.tops else 1
                made.saved += (made.n - 1) * size
                total.tops, total.leaves, total.saved = [index], made.leaves, made.saved
            out.append(made)
        node.total = total
    return out
