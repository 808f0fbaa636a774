"""Encoding whole texts through a cache of their space-separated chunks.

A tokenizer whose tokens never cross white space gives a text the concatenation of what it gives to its chunks. Natural
text repeats chunks, so a worker encodes each chunk once and gathers the rest with numpy. Before the cache would pass
`most_bytes` it forgets the chunks not met again since they came or since it last forgot some, and chunks are looked up
in blocks of BLOCK, so a worker's memory is bounded whatever the corpus and however long a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import batched, repeat

import numpy as np

#: Chunks of one lookup: what the cache may pass its bound by, when a block alone has more.
BLOCK = 1 << 17
#: Bytes a cached chunk takes besides its own and its values: object headers, its place in the dictionary, its number.
ENTRY = 160
#: Texts above so many bytes or characters are cut into chunks lazily.
LONG = 1 << 20


def byte_chunks(raw: bytes) -> Iterable[bytes]:
    """What ASCII white space separates."""
    return raw.split() if len(raw) <= LONG else (m.group() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw))


class ChunkCache:
    """encode_many: list of distinct chunks -> (flat values, lengths)."""

    def __init__(self, encode_many, most_bytes: int = 128 << 20):
        self.encode_many, self.most_bytes = encode_many, most_bytes
        self._clear()

    def _clear(self):
        self.index: dict = {}
        self.bytes = 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int32)
        self.again = np.zeros(1 << 14, bool)

    def _forget(self) -> None:
        """Keep what was met again, up to half the bound."""
        n = len(self.index)
        keys = list(self.index)
        cost = np.fromiter(map(len, keys), np.int64, n) + ENTRY + 4 * self.lengths[:n]
        keep = self.again[:n] & (np.cumsum(np.where(self.again[:n], cost, 0)) <= self.most_bytes // 2)
        at = np.flatnonzero(keep)
        lengths = self.lengths[at].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(lengths.sum())
        flat = self.flat[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]
        self._clear()
        if len(at):
            self._put([keys[i] for i in at.tolist()], flat, lengths)
            self.bytes = int(cost[at].sum())

    def _put(self, chunks: list, values: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(self.index), len(chunks)
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + k >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.flat[self.used : self.used + len(values)] = values
        self.lengths[n : n + k] = lengths
        ends = np.cumsum(lengths, dtype=np.int64)
        self.starts[n : n + k] = self.used + ends - lengths
        self.used += len(values)
        self.index.update(zip(chunks, range(n, n + k), strict=True))

    def lookup(self, chunks: list) -> np.ndarray:
        """The places of all chunks in the cache, which gets what it lacks."""
        at = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(at < 0)
        self.again[at] = True  # at -1 the last, spare one
        if len(missing):
            new = list(dict.fromkeys(map(chunks.__getitem__, missing.tolist())))
            cost = ENTRY * len(new) + sum(map(len, new))
            if self.bytes and self.bytes + cost > self.most_bytes:
                self._forget()
                if self.bytes + cost > self.most_bytes:
                    self._clear()
                at = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
                missing = np.flatnonzero(at < 0)
                new = list(dict.fromkeys(map(chunks.__getitem__, missing.tolist())))
            values, lengths = self.encode_many(new)
            self.bytes += ENTRY * len(new) + sum(map(len, new)) + 4 * len(values)
            self._put(new, values, lengths)
            at[missing] = np.fromiter(map(self.index.__getitem__, map(chunks.__getitem__, missing.tolist())), np.int64, len(missing))
        return at

    def _each(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, number of values of each chunk)."""
        at = self.lookup(chunks)
        lengths = self.lengths[at].astype(np.int64)
        return gathered(self.flat, self.starts[at], lengths), lengths

    def _values(self, chunks: list, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths = self._each(chunks)
        return flat, summed(lengths, np.asarray(sizes, np.int64))

    def values(self, chunks: list) -> np.ndarray:
        """The values of all chunks, one after the other."""
        return np.concatenate([np.zeros(0, np.int32), *[self._each(chunks[i : i + BLOCK])[0] for i in range(0, len(chunks), BLOCK)]])

    def encode_array(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """As encode, of an Arrow array of texts, a null one empty, where chunks are what ASCII white space separates, as
        bytes. Arrow cuts the texts and numbers their chunks, so each distinct one is looked up once an array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if texts.nbytes > 8 * LONG:
            return self.encode(byte_chunks((t or "").encode()) for t in texts.to_pylist())
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        parts = [self._each(distinct[i : i + BLOCK]) for i in range(0, len(distinct), BLOCK)]
        flat = np.concatenate([np.zeros(0, np.int32), *[p[0] for p in parts]])
        lengths = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in parts]])
        at = numbered.indices.to_numpy()
        each = lengths[at]
        return gathered(flat, (np.cumsum(lengths) - lengths)[at], each), summed(each, pc.list_value_length(cut).to_numpy())

    def encode(self, split_texts: Iterable[Iterable]) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, number of values of each text) for texts given as chunks; lazy ones are never held whole."""
        flat, numbers, owners = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
        block: list = []
        sizes: list[int] = []
        n = 0
        for i, text in enumerate(split_texts):
            n = i + 1
            for part in (text,) if isinstance(text, list) and len(text) <= BLOCK else batched(text, BLOCK):
                if block and len(block) + len(part) > BLOCK:
                    for out, x in zip((flat, numbers), self._values(block, sizes), strict=True):
                        out.append(x)
                    block, sizes = [], []
                block += part
                sizes.append(len(part))
                owners.append(i)
        for out, x in zip((flat, numbers), self._values(block, sizes), strict=True):
            out.append(x)
        counts = np.zeros(n, np.int64)
        np.add.at(counts, np.asarray(owners, np.int64), np.concatenate(numbers))
        return np.concatenate(flat), counts


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at starts, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]


def summed(lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of runs of lengths, sizes of them each."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
    return np.diff(bounds)


def ragged(flat: np.ndarray, counts: np.ndarray, before: int | None, after: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with a value put before and after each."""
    extra = (before is not None) + (after is not None)
    new = counts + extra
    ends = np.cumsum(new)
    out = np.empty(int(ends[-1]) if len(ends) else 0, flat.dtype)
    keep = np.ones(len(out), bool)
    if before is not None:
        out[ends - new] = before
        keep[ends - new] = False
    if after is not None:
        out[ends - 1] = after
        keep[ends - 1] = False
    out[keep] = flat
    return out, new
