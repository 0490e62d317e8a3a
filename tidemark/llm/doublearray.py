"""A double-array trie over dense labels.

State s has the child of label c at slot BASE[s] + c if CHECK of that slot is s.
Labels are dense numbers from 0; slot 0 is the root.
"""

from __future__ import annotations

import numpy as np

TRIES = 64  # places looked at before a node's children go behind all others


class DoubleArray:
    """Packed from sequences given as one array of labels and offsets of the
    sequences in it."""

    def __init__(self, labels: np.ndarray, offs: np.ndarray):
        self.base, self.check = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.size, self.hole = 1, 1
        self.slot = np.zeros(len(labels), np.int64)  # the node of each label of each sequence
        length = np.diff(offs)
        state, live, k = np.zeros(len(length), np.int64), np.flatnonzero(length), 0
        while len(live):
            at = offs[live] + k
            state[live] = self._children(state[live], labels[at])
            self.slot[at] = state[live]
            k += 1
            live = live[length[live] > k]

    def _room(self, upto: int) -> None:
        if upto >= len(self.base):
            more = max(upto + 1, 2 * len(self.base)) - len(self.base)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free slots."""
        self._room(self.size + n)
        holes = self.hole + np.flatnonzero(self.check[self.hole:self.size + n] < 0)[:n]
        if len(holes):
            self.hole = int(holes[0])
        return holes

    def _children(self, parent: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Give the distinct (parent, label) pairs their slots; the slot of each pair."""
        o = np.lexsort((label, parent))
        p, c = parent[o], label[o]
        new = np.append(True, (p[1:] != p[:-1]) | (c[1:] != c[:-1]))
        pair = np.cumsum(new) - 1
        p, c = p[new], c[new]
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        count = np.diff(np.append(first, len(p)))
        for f, n in sorted(zip(first[count > 1], count[count > 1]), key=lambda x: -x[1]):
            self._place(int(p[f]), c[f:f + n])
        one = first[count == 1]
        if len(one):
            at = self._free(len(one))
            self.base[p[one]] = at - c[one]
            self.check[at] = p[one]
            self.size = max(self.size, int(at[-1]) + 1)
        out = np.empty(len(o), np.int64)
        out[o] = (self.base[p] + c)[pair]
        return out

    def _place(self, p: int, c: np.ndarray) -> None:
        span = int(c[-1] - c[0])
        for f in self._free(TRIES):
            self._room(int(f) + span)
            at = f + (c - c[0])
            if (self.check[at] < 0).all():
                break
        else:
            self._room(self.size + span)
            at = self.size + (c - c[0])
        self.base[p] = at[0] - c[0]
        self.check[at] = p
        self.size = max(self.size, int(at[-1]) + 1)

    def walk(self, labels: np.ndarray) -> int | None:
        """The node of one sequence, None where there is none."""
        s = 0
        for c in labels:
            t = int(self.base[s] + c)
            if not 0 < t < self.size or self.check[t] != s:
                return None
            s = t
        return s
