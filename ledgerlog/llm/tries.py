"""Double-array tries over word symbols, built and walked with numpy.

State 0 is the root. The child of state ``s`` by symbol ``c`` is ``base[s] + c`` if ``check`` there is ``s``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Up to this many children, all nodes of a size are placed together.
FEW = 16
TRIALS = 256


@dataclass
class Trie:
    """``vocabulary`` holds the sorted values of the symbols 1, 2, ...; symbol 0 has no child anywhere."""

    vocabulary: np.ndarray
    base: np.ndarray
    check: np.ndarray

    def symbols(self, values: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(values), np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, values), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == values, at + 1, 0).astype(np.int32)

    def walk(self, symbols: np.ndarray, depth: int) -> list[np.ndarray]:
        """States reached after 1, 2, ... ``depth`` symbols, from all positions at once."""
        at = np.flatnonzero(symbols)
        states = np.zeros(len(at), np.int32)
        found = []
        for level in range(depth):
            inside = at + level < len(symbols)
            at, states = at[inside], states[inside]
            step = symbols[at + level]
            after = self.base[states] + step
            there = (step > 0) & (self.check[after] == states)
            at, states = at[there], after[there]
            found.append(states)
        return found


def build(phrases: np.ndarray, lengths: np.ndarray, seed: int = 0) -> tuple[Trie, np.ndarray]:
    """The trie of the rows of ``phrases``, of which the first ``lengths`` values count, and the state of each row."""
    depth = phrases.shape[1]
    inside = np.arange(depth)[None, :] < lengths[:, None]
    vocabulary = np.unique(phrases[inside])
    symbols = np.where(inside, np.searchsorted(vocabulary, phrases) + 1, 0)
    node = np.zeros(len(phrases), np.int64)
    parents, steps, total = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 1
    for level in range(depth):
        rows = np.flatnonzero(lengths > level)
        edges, which = np.unique(node[rows] * (len(vocabulary) + 1) + symbols[rows, level], return_inverse=True)
        node[rows] = total + which
        total += len(edges)
        parents.append(edges // (len(vocabulary) + 1))
        steps.append(edges % (len(vocabulary) + 1))
    parent, step = np.concatenate(parents), np.concatenate(steps)
    start = _placed(parent, step, total, len(vocabulary), seed)
    state = np.append(0, start[parent] + step)
    size = int(state.max()) + len(vocabulary) + 1
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    base[state] = start
    check[state[1:]] = state[parent]
    return Trie(vocabulary, base, check), state[node]


def _placed(parent: np.ndarray, step: np.ndarray, total: int, symbols: int, seed: int) -> np.ndarray:
    """For each node a base under which all its children fall on slots of their own; edges come ordered by parent."""
    start = np.zeros(total, np.int64)
    if not len(parent):
        return start
    nodes, first, sizes = np.unique(parent, return_index=True, return_counts=True)
    rng = np.random.default_rng(seed)
    span = 4 * total + 2 * symbols
    free = np.ones(span + symbols + 1, bool)
    free[0] = False
    many = np.flatnonzero(sizes > FEW)
    for i in many[np.argsort(-sizes[many], kind="stable")].tolist():
        children = step[first[i]:first[i] + sizes[i]]
        base = np.zeros(1, np.int64)
        while not len(fit := base[free[base[:, None] + children].all(1)]):
            base = rng.integers(0, span, TRIALS)
        start[nodes[i]] = fit[0]
        free[fit[0] + children] = False
    for size in range(min(FEW, int(sizes.max())), 0, -1):
        left = np.flatnonzero(sizes == size)
        children = step[first[left][:, None] + np.arange(size)]
        while len(left):
            base = rng.integers(0, span, len(left))
            slots = base[:, None] + children
            fits = np.flatnonzero(free[slots].all(1))
            # Of nodes that want the same slot, the first gets it.
            slot, winner = np.unique(slots[fits], return_index=True)
            won = np.bincount(winner // size, minlength=len(fits)) == size
            fits = fits[won]
            start[nodes[left[fits]]] = base[fits]
            free[slots[fits]] = False
            rest = np.ones(len(left), bool)
            rest[fits] = False
            left, children = left[rest], children[rest]
    return start
