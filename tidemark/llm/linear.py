"""Hashed character n-grams and small linear models, shared by the classifiers."""

from __future__ import annotations

import numpy as np

#: Multipliers of the rolling polynomial hash and of its final mix.
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def ngram_ids(text: bytes, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Ids below 2 ** bits of all byte n-grams of the given orders (ascending), in text order, repeats included."""
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    out = []
    hashed = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, orders[-1] + 1):
        if len(codes) < n:
            break
        hashed = hashed[: len(codes) - n + 1] * _BASE + codes[n - 1 :]
        if n in orders:
            mixed = (hashed ^ hashed >> np.uint64(29) ^ np.uint64(n)) * _MIX
            out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


def distinct(ids: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Distinct ids in linear time; ``mark`` is an int32 array with a place for each id, of any content."""
    order = np.arange(len(ids), dtype=np.int32)
    mark[ids] = order
    return ids[mark[ids] == order]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def minimize(gradient, start: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``gradient(w)`` returns (loss, its gradient). Deterministic."""
    w = start
    loss, g = gradient(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.abs(g).sum()))
        for (s, y), a in zip(past, reversed(alphas), strict=True):
            q += (a - (y @ q) / (y @ s)) * s
        slope, step = float(g @ q), 1.0
        if slope <= 1e-12:
            break
        for _ in range(30):
            new_loss, new_g = gradient(w - step * q)
            if new_loss <= loss - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = -step * q, new_g - g
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y)] if memory > 1 else [(s, y)]
        gain = loss - new_loss
        w, loss, g = w + s, new_loss, new_g
        if gain < 1e-9 * max(1.0, abs(loss)):
            break
    return w


def newton(derivatives, start: np.ndarray, rounds: int) -> np.ndarray:
    """Newton's method with step halving; ``derivatives(w)`` returns (loss, gradient, Hessian) of a strictly convex loss."""
    w = start
    loss, g, h = derivatives(w)
    for _ in range(rounds):
        direction, step = np.linalg.solve(h, g), 1.0
        slope = float(g @ direction)
        if slope <= 1e-12:
            break
        for _ in range(30):
            new = derivatives(w - step * direction)
            if new[0] <= loss - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        w = w - step * direction
        loss, g, h = new
    return w
