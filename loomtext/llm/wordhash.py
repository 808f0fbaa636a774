"""64-bit hashes of the white-space-separated words of whole texts, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, 1 << 21)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers


#: Bytes hashed at a time, give or take a word: what bounds a worker's memory for very long texts.
PART = 4 << 20


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, words of each text) for an Arrow string array: words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; null: none."""
    import pyarrow as pa

    texts = texts.cast(pa.large_binary()) if not isinstance(texts, pa.ChunkedArray) else texts.combine_chunks().cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    if n == 0 or at[-1] == at[0]:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    if len(data) <= PART:
        return _hashes(data, at)
    hashes, counts, start = [], np.zeros(n, np.int64), 0
    while start < len(data):
        stop = min(start + PART, len(data))
        while stop < len(data):  # a part ends before white space
            space = np.flatnonzero(_SPACE[data[stop : stop + 4096]])
            stop = min(stop + (int(space[0]) if len(space) else 4096), len(data))
            if len(space):
                break
        h, c = _hashes(data[start:stop], np.clip(at, start, stop) - start)
        hashes.append(h)
        counts += c
        start = stop
    return np.concatenate(hashes), counts


def _hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes of the rows of bytes that at bounds."""
    inside = ~_SPACE[data]
    filled = np.flatnonzero(at[1:] > at[:-1])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[at[filled]] = inside[at[filled]]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[at[filled + 1] - 1] = inside[at[filled + 1] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    power, inverse = _power(len(data))
    total = _LOWER[data].astype(np.uint64)
    total += np.uint64(1)
    total *= power[: len(data)]
    np.cumsum(total, out=total)
    h = total[ends]
    h[starts > 0] -= total[starts[starts > 0] - 1]
    h *= inverse[starts]
    h ^= (ends - starts + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h), np.diff(np.searchsorted(starts, at))
