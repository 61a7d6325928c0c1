"""Words and word shingles of a text as 64-bit hashes, vectorised over its bytes (numpy helpers for tasks)."""

from __future__ import annotations

import numpy as np

from barque.llm.rolling import Rolling, mix64

#: ASCII lower case; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_C = np.uint64(0xD6E8FEB86659FD93)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not space or 0x09-0x0D."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: bytes) -> np.ndarray:
    """One hash for each word of the lower-cased text."""
    low = LOWER[np.frombuffer(data, np.uint8)]
    starts, ends = word_bounds(low)
    return Rolling(low).spans(starts, ends) if len(starts) else np.empty(0, np.uint64)


def join_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n words."""
    m = len(words) - n + 1
    h = np.full(m, n, np.uint64)
    for j in range(n):
        h = h * _C + words[j : j + m]
    return mix64(h)


def shingle_set(text: bytes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of all words together, if there are fewer; empty without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    return np.unique(join_hashes(words, min(n, len(words))))
