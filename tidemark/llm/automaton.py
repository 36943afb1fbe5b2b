"""A minimal acyclic transducer from byte strings to numbers, in flat arrays that can be memory-mapped.

States that accept the same endings are one state. An edge carries how many strings of the lexicon sort before all that
pass through it, so the sum along a path is the rank of its string: outputs need not be unique to a state, and suffixes
are shared whatever their numbers. Edges lie in one array, a state's at ``base[state] + byte``, and are looked up for
many strings at a time, one byte of each per step.
"""

from __future__ import annotations

import json

import numpy as np


def minimal_states(strings: list[bytes]) -> list[tuple[bool, tuple[tuple[int, int], ...]]]:
    """(final, ((byte, target), ...)) of each state for sorted, distinct ``strings``; targets come first, the root last."""
    states: list = []
    known: dict = {}

    def settled(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path, last = [[False, []]], b""
    for s in strings:
        shared = 0
        while shared < min(len(s), len(last)) and s[shared] == last[shared]:
            shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settled(node)))
        path += [[False, []] for _ in s[shared:]]
        path[-1][0], last = True, s
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settled(node)))
    states.append((path[0][0], tuple(path[0][1])))
    return states


def _placed(states) -> np.ndarray:
    """Base of each state so that no two edges share a cell: states of many edges first, the rest fill the gaps."""
    n_edges = sum(len(edges) for _, edges in states)
    free = np.ones(2 * n_edges + 8192, dtype=bool)
    free[:256] = False
    base = np.zeros(len(states), dtype=np.int32)
    single = []
    first = 256
    for s in sorted(range(len(states)), key=lambda s: -len(states[s][1])):
        taken = np.array([b for b, _ in states[s][1]])
        if len(taken) < 2:
            single += [s] * len(taken)
            continue
        while not free[first]:
            first += 1
        begin, found = first, None
        while found is None:
            if begin + 4096 + 256 > len(free):
                free = np.append(free, np.ones(len(free), dtype=bool))
            at = begin + np.flatnonzero(free[begin : begin + 4096])
            fits = at[free[at[:, None] + (taken - taken[0])].all(axis=1)] if len(at) else at
            found = int(fits[0]) if len(fits) else None
            begin += 4096
        base[s] = found - taken[0]
        free[base[s] + taken] = False
    if len(single):
        cells = np.flatnonzero(free)
        cells = cells if len(cells) >= len(single) else np.append(cells, len(free) + np.arange(len(single)))
        base[single] = cells[: len(single)] - np.array([states[s][1][0][0] for s in single])
    return base


def compiled(strings: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the transducer for sorted, distinct strings: base, final, and per cell check, target, output."""
    states = minimal_states(strings)
    below = np.zeros(len(states), dtype=np.int64)
    base = _placed(states)
    edges = []
    for s, (final, out) in enumerate(states):
        n = int(final)
        for byte, target in out:
            edges.append((base[s] + byte, s, target, n))
            n += below[target]
        below[s] = n
    size = int(base.max()) + 257 if len(base) else 257
    cells = {"check": np.full(size, -1, dtype=np.int32), "target": np.zeros(size, dtype=np.int32), "output": np.zeros(size, dtype=np.int32)}
    if edges:
        at, *values = np.array(edges, dtype=np.int64).T
        for cell, value in zip(cells.values(), values):
            cell[at] = value
    return {"base": base, "final": np.array([f for f, _ in states], dtype=bool), **cells}


def ranks(t: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, longest: int) -> np.ndarray:
    """Rank of each string ``data[start : start + length]`` in the lexicon, -1 for strings outside it."""
    found = np.full(len(starts), -1, dtype=np.int64)
    who = np.flatnonzero(lengths <= longest)
    at, end = starts[who], (starts + lengths)[who]
    state, rank = np.full(len(who), len(t["base"]) - 1, dtype=np.int32), np.zeros(len(who), dtype=np.int32)
    while len(who):
        ended = at == end
        if ended.any():
            whole = ended & t["final"][state]
            found[who[whole]] = rank[whole]
            on = ~ended
            who, at, end, state, rank = who[on], at[on], end[on], state[on], rank[on]
        cell = t["base"][state] + data[at]
        on = t["check"][cell] == state
        cell = cell[on]
        who, at, end, state, rank = who[on], at[on] + 1, end[on], t["target"][cell], rank[on] + t["output"][cell]
    return found


def to_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """One file image of named arrays: a header and, at multiples of 64 bytes, their contents."""
    parts, header, at = [], {}, 0
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        header[name] = (a.dtype.str, len(a), at)
        parts.append(raw + bytes(-len(raw) % 64))
        at += len(parts[-1])
    head = json.dumps(header).encode()
    head += b" " * (-(len(head) + 8) % 64)
    return len(head).to_bytes(8, "little") + head + b"".join(parts)


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file made by ``to_bytes``, memory-mapped: tasks of one machine share its pages."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        header = json.loads(f.read(size))
    whole = np.memmap(path, dtype=np.uint8, mode="r")
    body = np.asarray(whole)[8 + size :]
    return {k: body[at : at + n * np.dtype(d).itemsize].view(d) for k, (d, n, at) in header.items()}
