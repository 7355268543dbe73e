"""Double-array tries over integer symbols, built and walked with numpy.

A node's child for symbol c is slot ``base[node] + c``, and is the node's own
if ``check`` of that slot names the node (Aoe, 1989).  Nodes of many children
are placed first; those of few are placed all at once, in rounds of random
bases in which a node wins if all its slots are free and no earlier node of
the round wants them.
"""

from __future__ import annotations

import numpy as np

WIDE = 32  # children from which a node is placed on its own
_TRIES = 128


class DoubleArray:
    """The trie of rows of a matrix (equal depth, distinct rows); a row's number is its accepting state's value."""

    def __init__(self, rows: np.ndarray, symbols: int) -> None:
        n, depth = rows.shape
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        parent, at, edges = np.zeros(n, np.int64), 1, []  # node 0 is the root
        fresh = np.arange(n) == 0  # rows at which a new node of the depth begins
        for d in range(depth):
            fresh[1:] |= rows[1:, d] != rows[:-1, d]
            new = np.flatnonzero(fresh)
            child = at + np.cumsum(fresh) - 1
            edges.append((parent[new], rows[new, d], child[new]))
            parent, at = child, at + len(new)
        slot = self._place(at, symbols, *map(np.concatenate, zip(*edges)))
        self.accept = np.full(len(self.check), -1, np.int32)
        self.accept[slot[parent]] = order

    @classmethod
    def of(cls, arrays: dict) -> DoubleArray:
        """A trie from its arrays (``vars`` of another)."""
        out = cls.__new__(cls)
        out.__dict__.update(arrays)
        return out

    def _place(self, nodes: int, symbols: int, parent: np.ndarray, symbol: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Base and check from the edges in order of their parents; the slot of each node."""
        rng = np.random.default_rng(1)
        degree = np.bincount(parent, minlength=nodes)
        first = np.concatenate([[0], np.cumsum(degree)])
        taken = np.zeros(nodes + nodes // 4 + symbols + 2, bool)
        taken[0] = True  # the dead state
        base = np.zeros(nodes, np.int64)
        inner = np.flatnonzero(degree)
        wide = inner[degree[inner] >= WIDE]
        for v in wide[np.argsort(-degree[wide], kind="stable")]:
            c = symbol[first[v]: first[v + 1]]
            low, high = int(c.min()), int(c.max())
            tries = rng.integers(1 - low, max(2 - low, len(taken) - high), _TRIES)
            free = np.ones(_TRIES, bool)
            for k in range(0, len(c), WIDE):  # most tries fail at once
                live = np.flatnonzero(free)
                if not len(live):
                    break
                free[live] = ~taken[tries[live, None] + c[k: k + WIDE]].any(axis=1)
            if free.any():
                base[v] = tries[int(np.argmax(free))]
            else:
                base[v] = len(taken) - low
                taken = np.concatenate([taken, np.zeros(high - low + 1, bool)])
            taken[base[v] + c] = True
        left = inner[degree[inner] < WIDE]
        left = left[np.argsort(-degree[left], kind="stable")]
        while len(left):
            k = degree[left]
            owner = np.repeat(np.arange(len(left)), k)
            e = np.repeat(first[left] - np.concatenate([[0], np.cumsum(k)[:-1]]), k) + np.arange(len(owner))
            c = symbol[e]
            high = np.maximum.reduceat(c, np.concatenate([[0], np.cumsum(k)[:-1]]))
            low = np.minimum.reduceat(c, np.concatenate([[0], np.cumsum(k)[:-1]]))
            tries = 1 - low + (rng.random(len(left)) * (len(taken) - 1 - (high - low))).astype(np.int64)
            slots = tries[owner] + c
            want = np.full(len(taken), len(left), np.int64)
            np.minimum.at(want, slots, owner)
            bad = np.bincount(owner, taken[slots] | (want[slots] != owner), len(left)) > 0
            good = ~bad
            base[left[good]] = tries[good]
            taken[slots[good[owner]]] = True
            left = left[bad]
            # hardly any found room: make some
            if good.sum() < 0.02 * len(bad):
                taken = np.concatenate([taken, np.zeros(len(taken) // 8 + 1, bool)])
        size = len(taken)
        slot = np.full(nodes, size)  # the root's is past all others
        slot[child] = base[parent] + symbol
        self.root = size
        self.base = np.zeros(size + 1, np.int32)
        self.base[slot] = base
        self.check = np.full(size + 1, -1, np.int32)
        self.check[slot[child]] = slot[parent]
        return slot

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states that follow; 0 is dead, as is a negative symbol."""
        to = self.base[states].astype(np.int64) + symbols
        ok = (states > 0) & (symbols >= 0) & (to > 0) & (to < len(self.check))
        to = np.where(ok, to, 0)
        return np.where(self.check[to] == states, to, 0)
