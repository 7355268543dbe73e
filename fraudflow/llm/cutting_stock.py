"""Cutting-stock by column generation over a bounded length histogram.

Everything here is on a histogram of at most ``capacity`` length classes, so
its size doesn't depend on the number of documents.
"""

from __future__ import annotations

import numpy as np


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best pattern: counts of each size within capacity, by dynamic programming."""
    best = np.zeros(capacity + 1)
    take = [-1] * (capacity + 1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = fits[c]
        if n:
            v = best[c - sizes[:n]]
            v += values[:n]
            k = v.argmax()
            if v[k] > best[c]:
                best[c], take[c] = v[k], k
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            pattern[take[c]] += 1
            c -= int(sizes[take[c]])
    return float(best[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
          rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each) and how often each is used in a linear-program optimum.

    ``sizes`` ascending, each at most ``capacity``; ``demand`` positive.  The
    restricted master is a revised simplex; the knapsack prices new columns.
    It stops when the pricing bound proves the value within ``gap``.
    """
    fit = capacity // sizes
    columns = np.diag(fit).astype(np.int64)
    inverse = np.diag(1.0 / fit)
    x = demand / fit
    for _ in range(rounds):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        value, pattern = knapsack(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ pattern
        ok = step > 1e-9
        ratio = np.full(len(x), np.inf)
        ratio[ok] = x[ok] / step[ok]
        out = int(ratio.argmin())
        by = ratio[out]
        x = x - by * step
        x[out] = by
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        columns[out] = pattern
    return columns, np.maximum(x, 0)


def plan(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3) -> list[tuple[np.ndarray, int]]:
    """(pattern, number of sequences) that use up the demand exactly.

    The fractional uses are rounded down; what is left, at most a sequence for
    each pattern, is placed largest first.
    """
    if not len(sizes):
        return []
    columns, x = solve(sizes, demand, capacity, gap)
    out, left = [], demand.astype(np.int64).copy()
    for pattern, n in zip(columns, np.floor(x + 1e-6).astype(np.int64)):
        used = pattern > 0
        n = min(int(n), int((left[used] // pattern[used]).min())) if used.any() else 0
        if n > 0:
            out.append((pattern.copy(), n))
            left -= n * pattern
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            pattern[k] = min(left[k], room // sizes[k])
            room -= int(pattern[k] * sizes[k])
        used = pattern > 0
        n = int((left[used] // pattern[used]).min())
        out.append((pattern, n))
        left -= n * pattern
    return out
