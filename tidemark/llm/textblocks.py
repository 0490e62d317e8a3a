"""Vectorised text helpers used inside Arrow batches.

A *block* is a run of rows of one Arrow string column seen as one UTF-8 byte
buffer with row offsets, so that hashing words costs a few NumPy passes over
the bytes instead of a Python call per word.  Null texts count as empty.
Words are maximal runs of bytes other than space and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_pow = np.ones(1, np.uint64), np.ones(1, np.uint64)
SHINGLE_MULT = np.array([pow(0xD1342543DE82EF95, j + 1, 1 << 64) for j in range(64)], np.uint64)


def blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets within bytes) for runs of rows of at
    most ``max_bytes`` bytes; one longer text is a block of its own."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if len(col) == 0:
        return
    if col.null_count:
        col = col.fill_null("")
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, off_buf, data = col.buffers()
    offs = np.frombuffer(off_buf, wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def unit(h: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow
    if len(_pow[0]) < n + 1:
        m = max(n + 1, BLOCK_BYTES + 1)
        up, down = np.full(m, _P, np.uint64), np.full(m, _P_INV, np.uint64)
        up[0] = down[0] = 1
        if m > BLOCK_BYTES + 1:  # one very long text: don't keep the tables
            return np.cumprod(up), np.cumprod(down)
        _pow = np.cumprod(up), np.cumprod(down)
    return _pow


def word_spans(buf: np.ndarray, offs: np.ndarray, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end byte of each word of the block; ``gap`` marks the
    bytes that separate words (or lines)."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~gap[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    s = np.flatnonzero(inside & ~before)
    e = np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offs, s, side="right") - 1, s, e


def word_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: differences of a prefix polynomial."""
    up, down = _powers(len(buf))
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=prefix[1:])
    return mix((prefix[e] - prefix[s]) * down[s])


def shingles(h: np.ndarray, row: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, index of the first word) of each run of ``k`` words of a row.
    A row of 1 to k-1 words has one shingle, of all its words."""
    n = len(h)
    out_h, out_r, out_i = [], [], []
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc += h[j:n - k + 1 + j] * SHINGLE_MULT[j]
        keep = np.flatnonzero(row[:n - k + 1] == row[k - 1:])
        out_h.append(mix(acc[keep])), out_r.append(row[keep]), out_i.append(keep)
    if n:
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        length = np.diff(np.append(first, n))
        for f, m in zip(first[length < k], length[length < k]):
            acc = (h[f:f + m] * SHINGLE_MULT[:m]).sum(dtype=np.uint64)
            out_h.append(mix(np.array([acc], np.uint64))), out_r.append(row[f:f + 1]), out_i.append(np.array([f]))
    if not out_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    H, R, I = np.concatenate(out_h), np.concatenate(out_r), np.concatenate(out_i)
    if len(out_h) > 1:
        o = np.argsort(I, kind="stable")
        H, R, I = H[o], R[o], I[o]
    return H, R, I


def counted(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) with their counts, ordered by row then hash."""
    if len(h) == 0:
        return h, row, np.zeros(0, np.int64)
    o = np.lexsort((h, row))
    h, row = h[o], row[o]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h)))
