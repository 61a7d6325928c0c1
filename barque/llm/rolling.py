"""Vectorised rolling hashes over one text's bytes (numpy helpers for tasks)."""

from __future__ import annotations

import numpy as np

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> _S)
    h = h * _M1
    h ^= h >> _S
    h *= _M2
    h ^= h >> _S
    return h


def _powers(kind: str, base: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of base modulo 2**64; grown by doubling and kept for the worker's next texts."""
    p = _POWERS.get(kind)
    if p is None or len(p) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        p = np.empty(size, np.uint64)
        p[0] = 1
        done = 1
        while done < size:
            step = min(done, size - done)
            p[done : done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if size <= 1 << 19:  # 4 MB of each kind stay with a worker
            _POWERS[kind] = p
    return p[:n]


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class Rolling:
    """64-bit hashes of any substrings of one byte string: equal bytes, equal hash, wherever they stand."""

    def __init__(self, data: bytes | np.ndarray):
        self.n = len(data)
        v = _TABLE[data if isinstance(data, np.ndarray) else np.frombuffer(data, np.uint8)]
        v *= _powers("up", _BASE, self.n)
        self.sums = np.empty(self.n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(v, out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every substring of k bytes, by start."""
        m = self.n - k + 1
        return mix64((self.sums[k:] - self.sums[:m]) * _powers("down", _BASE_INV, m))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for arrays of bounds."""
        down = _powers("down", _BASE_INV, self.n + 1)
        return mix64((self.sums[end] - self.sums[start]) * down[start] + np.uint64(_BASE) * (end - start).astype(np.uint64))


def window_minimum(h: np.ndarray, w: int) -> np.ndarray:
    """Least value of every w consecutive values, by doubling."""
    span, out = 1, h
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = w - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


_PLACE = np.uint64((1 << 24) - 1)
_STEP = 1 << 23


def anchors(roll: Rolling, length: int, k: int):
    """The anchor of a `length`-byte window is the least of its k-grams by (leading hash bits, place).

    Returns (p, lo, hi, gram): anchor places, first and last start of the windows that they stand for, and the
    k-gram's hash. Each window start lies in one [lo, hi] only; equal windows, in any texts, have anchors with equal
    grams at equal distances. Long texts go through in pieces that share length - 1 bytes.
    """
    found = []
    h_all = roll.grams(k) if roll.n >= length else None
    for first in range(0, max(roll.n - length + 1, 0), _STEP):
        starts = min(_STEP, roll.n - length + 1 - first)
        h = h_all[first : first + starts + length - k]
        low = window_minimum((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - k + 1)
        change = np.flatnonzero(low[1:] != low[:-1]) + 1
        lo = np.concatenate(([0], change))
        hi = np.concatenate((change - 1, [len(low) - 1]))
        p = (low[lo] & _PLACE).astype(np.int64)
        found.append((p + first, lo + first, hi + first, h[p]))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
