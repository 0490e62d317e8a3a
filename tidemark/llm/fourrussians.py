"""Block tables for the cheapest repair of a row of turns.

A repaired conversation's role initials are empty or match ``s?(ua)+``.  Read
from the left, a repair is in one of four states: at the start, after the
system turn, after a user turn, after an assistant turn.  A row is one of nine
symbols: it must be deleted, or it has a role (system, user, assistant, other)
and is truncated or not.  The costs of finishing the repair, one for each state,
are a *vector*; as an insertion leads from any state to the next, its entries
differ by a bounded amount, so that only a few vectors exist once the least
entry is taken off.

``Tables`` lists them and precomputes, for every vector and every block of
``BLOCK`` symbols, the vector before the block and what was taken off.  A row
of turns is processed block by block from its end by lookup; each block is then
expanded backward from its right border, which gives the vector after every
row, and with it the least letter that stays on a cheapest way.
"""

from __future__ import annotations

from functools import cache

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
GONE = 0                      # the symbol of a row that must be deleted
SYMBOLS = 9                   # GONE, then 1 + role + 4 * truncated
ROLES = "sua"                 # initials of roles 0 to 2; 3 is any other
BLOCK = 4
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}


def symbol(role: int, truncated: bool) -> int:
    return 1 + role + 4 * truncated


def edits(state: int, sym: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        role, more = (sym - 1) % 4, TRUNCATED * (sym > 4)
        to = {0: SYSTEM if state == START else None, 1: USER if state != USER else None, 2: ASSISTANT if state == USER else None, 3: None}[role]
        if to is not None:
            out.append(("K", KEEP + more, to))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


def with_inserts(g: tuple) -> tuple:
    """The costs when insertions may come first."""
    u = min(g[USER], INSERT + g[ASSISTANT])
    return min(g[START], INSERT + u), min(g[SYSTEM], INSERT + u), u, min(g[ASSISTANT], INSERT + u)


def before(h: tuple, sym: int) -> tuple:
    """The costs before a row from the costs after it."""
    return with_inserts(tuple(min(c + h[to] for _, c, to in edits(q, sym)) for q in range(4)))


FAR = 10 ** 6
END = with_inserts((0, FAR, FAR, 0))


class Tables:
    """``vectors`` (normalised, the first is END's); ``step[v, sym]`` and
    ``block[v, code]``: the vector before; ``step_off``, ``block_off``: what was
    taken off; ``letters[v][sym][state]`` and ``to[v, sym, state]``: the edits of
    a row, insertions before it included, when ``v`` holds after it."""

    def __init__(self):
        norm = lambda h: (tuple(x - min(h) for x in h), min(h))
        self.vectors, seen, step, off = [norm(END)[0]], {norm(END)[0]: 0}, [], []
        for v in self.vectors:  # grows
            row = [norm(before(v, s)) for s in range(SYMBOLS)]
            for w, _ in row:
                if w not in seen:
                    seen[w] = len(self.vectors)
                    self.vectors.append(w)
            step.append([seen[w] for w, _ in row])
            off.append([o for _, o in row])
        self.step, self.step_off = np.array(step, np.int16), np.array(off, np.int32)
        n = len(self.vectors)
        self.block, self.block_off = np.arange(n, dtype=np.int16)[:, None], np.zeros((n, 1), np.int32)
        for _ in range(BLOCK):  # a further symbol on the left, the most significant digit
            self.block, self.block_off = (self.step[self.block].transpose(0, 2, 1).reshape(n, -1),
                                          (self.block_off[:, :, None] + self.step_off[self.block]).transpose(0, 2, 1).reshape(n, -1))
        self.value = np.array(self.vectors, np.int64)
        self.letters, self.to = [], np.zeros((n, SYMBOLS, 4), np.int8)
        for v, h in enumerate(self.vectors):
            self.letters.append([[self._edits(h, s, q, v) for q in range(4)] for s in range(SYMBOLS)])

    def _edits(self, h: tuple, sym: int, state: int, v: int) -> str:
        """The least letters of a cheapest way over one row."""
        out, q, left = "", state, before(h, sym)
        while True:
            good = [x for x in edits(q, sym) if x[1] + h[x[2]] == left[q]]
            if INSERT + left[NEXT[q]] == left[q]:
                good.append(("I", INSERT, NEXT[q]))
            letter, _, to = min(good)
            out, q = out + letter, to
            if letter != "I":
                self.to[v, sym, state] = q
                return out

    def borders(self, syms: np.ndarray, v) -> tuple[list, np.ndarray, np.ndarray, int]:
        """(vectors at the right borders of the rows left of the first block and
        of each block, vector before all rows, what was taken off, number of
        rows left of the first block).  ``v`` is a vector's number or an array
        of such numbers."""
        head = len(syms) % BLOCK
        codes = syms[head:].reshape(-1, BLOCK).astype(np.int64) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        out, off = [v], 0
        for code in codes[::-1]:
            off = off + self.block_off[v, code]
            v = self.block[v, code]
            out.append(v)
        for s in syms[:head][::-1]:
            off = off + self.step_off[v, s]
            v = self.step[v, s]
        return out[::-1], v, off, head

    def after(self, syms: np.ndarray, border: list, head: int) -> list:
        """The vector after each row: blocks expanded backward from their right borders."""
        out, lo = [], 0
        for i, v in enumerate(border):
            own, hi = [], head + i * BLOCK
            for s in syms[lo:hi][::-1]:
                own.append(v)
                v = self.step[v, s]
            out += own[::-1]
            lo = hi
        return out

    def trace(self, syms: np.ndarray, v: int, state: int) -> tuple[list[str], int, int]:
        """(edits of each row, next state, cost without what is left at the
        right border) when ``v`` holds after the rows."""
        border, first, off, head = self.borders(syms, v)
        out, begin = [], state
        for s, w in zip(syms.tolist(), self.after(syms, border, head)):
            out.append(self.letters[w][s][state])
            state = int(self.to[w, s, state])
        return out, state, int(off + self.value[first, begin] - self.value[v, state])

    def function(self, syms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector after the rows: the vector before them, and the next
        state for each state."""
        every = np.arange(len(self.vectors))
        border, first, _, head = self.borders(syms, every)
        states = np.tile(np.arange(4), (len(every), 1))
        for s, w in zip(syms.tolist(), self.after(syms, border, head)):
            states = self.to[w[:, None], s, states]
        return first, states


@cache
def tables() -> Tables:
    return Tables()


def ending(state: int) -> str:
    """The insertions after the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]
