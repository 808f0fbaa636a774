"""SentencePiece BPE by vectorised merge rounds, and its decoding.

Symbols of many words lie in flat numpy arrays. A round looks every adjacent pair up, takes the best rank of each word
by a segmented minimum, merges all leftmost non-overlapping pairs of that rank at once and compacts the arrays; words
without a pair that merges leave. Pairs are looked up by the piece they form, as the library does, so symbols that are
no piece alone can still merge.

A word of rounds grows with its merges, so a text without blanks would take the square of its length. Words above WORD
characters are cut where no piece holds the two characters beside the cut, as no merge crosses such a place; what is still
longer is merged along a linked list with a heap of its pairs, in the same order of ranks and places.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .chunks import LONG, ChunkCache, ragged

SPACE = "▁"
NONE = np.int64(1 << 40)
#: Characters of the longest word that is merged by rounds.
WORD = 256


class PieceBpe:
    """The library's ids for a BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        byte = {int(names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        if len(byte) != 256 or any(SPACE in names[i].lstrip(SPACE) for i in plain):
            raise ValueError("this model needs byte fallback and pieces that start words")
        self.byte = np.array([byte[b] for b in range(256)], np.int32)
        self.surface = [b"" for _ in range(n)]
        for i in plain:
            self.surface[i] = names[i].replace(SPACE, " ").encode()
        for b, i in byte.items():
            self.surface[i] = bytes([b])
        # symbols: the pieces, then characters that occur in pieces but are none
        symbol = {names[i]: i for i in plain}
        for c in sorted({c for i in plain for c in names[i]} - symbol.keys()):
            symbol[c] = n + len(symbol)
        size = max(symbol.values()) + 1
        self.size = size
        self.code = np.full(0x110000, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.code[ord(s)] = i
        keys, made = [], []
        for i in plain:
            s = names[i]
            for k in range(1, len(s)):
                if s[:k] in symbol and s[k:] in symbol:
                    keys.append(symbol[s[:k]] * size + symbol[s[k:]])
                    made.append(i)
        order = np.argsort(keys)
        self.keys, self.made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        scores = {i: lib.get_score(i) for i in plain}
        place = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.full(size, NONE, np.int64)
        for i in plain:
            self.rank[i] = place[scores[i]]
        # Ranks whose pairs must merge one at a time: those that pieces share, and those of pieces inside a better piece at its start or end.
        counts = np.bincount([place[s] for s in scores.values()], minlength=len(place))
        self.single = counts > 1
        for i in plain:
            s = names[i]
            for k in range(1, len(s)):
                for part in (s[:k], s[k:]):
                    j = symbol.get(part)
                    if j is not None and j < n and scores[i] > scores[j]:
                        self.single[place[scores[j]]] = True
        self.chunks = ChunkCache(self.merge)
        self.run = re.compile(f"{SPACE}+[^{SPACE}]*")
        self.runs = self.run.findall

    @cached_property
    def _inside(self) -> np.ndarray:
        """Sorted pairs of characters that stand side by side in a piece."""
        names = [self.lib.id_to_piece(i) for i in np.unique(self.made).tolist()]
        return np.unique(np.array([ord(a) << 21 | ord(b) for s in names for a, b in zip(s, s[1:], strict=False)], np.int64))

    def _pieces_of(self, word: str) -> list[str]:
        """A long word cut where no merge can cross."""
        at = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        pair = at[:-1] << 21 | at[1:]
        place = np.minimum(np.searchsorted(self._inside, pair), len(self._inside) - 1)
        cuts = [0, *(np.flatnonzero(self._inside[place] != pair) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    @cached_property
    def _merges(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.made.tolist(), strict=True))

    def _by_heap(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, places of their first characters) of one word: always the best pair, of equals the leftmost."""
        n, size, merges, rank = len(word), self.size, self._merges, self.rank
        symbol = array("q", self.code[np.frombuffer(word.encode("utf-32-le"), np.uint32)].astype(np.int64).tobytes())
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        made = array("q", bytes(8 * n))  # what the pair that begins here forms, plus one; 0 for none
        ranks = rank.tolist()

        def form(i: int) -> int:
            """Note what the pair at i forms; its place in the heap, or -1."""
            j = after[i]
            m = merges.get(symbol[i] * size + symbol[j]) if j < n and symbol[i] >= 0 and symbol[j] >= 0 else None
            made[i] = 0 if m is None else m + 1
            return -1 if m is None else ranks[m] << 40 | i

        heap = [h for h in map(form, range(n - 1)) if h >= 0]
        heapify(heap)
        while heap:
            h = heappop(heap)
            i = h & (1 << 40) - 1
            m = made[i] - 1
            if m < 0 or ranks[m] != h >> 40:  # the pair has changed since
                continue
            j = after[i]
            symbol[i], symbol[j], made[j] = m, -2, 0
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x in (before[i], i):
                if x >= 0 and (h := form(x)) >= 0:
                    heappush(heap, h)
        all_ = np.frombuffer(symbol, np.int64)
        place = np.flatnonzero(all_ != -2)
        return all_[place].astype(np.int32), place

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that each start with the space mark (flat), and their numbers; words is never empty of marks."""
        if max(map(len, words)) <= WORD:
            return self._rounds(words)
        parts = [self._pieces_of(w) if len(w) > WORD else [w] for w in words]
        flat = [p for own in parts for p in own]
        short = [p for p in flat if len(p) <= WORD]
        ids, counts = self._rounds(short) if short else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        ends = np.cumsum(counts)
        out, sizes, k = [], [], 0
        for own in parts:
            size = 0
            for p in own:
                if len(p) <= WORD:
                    piece = ids[ends[k] - counts[k] : ends[k]]
                    k += 1
                else:
                    symbol, place = self._by_heap(p)
                    text = np.frombuffer(p.encode("utf-32-le"), np.uint32)
                    piece, _ = self._with_bytes(text, place, symbol, np.zeros(len(symbol), np.int64))
                out.append(piece)
                size += len(piece)
            sizes.append(size)
        return np.concatenate(out).astype(np.int32), np.array(sizes, np.int64)

    def _with_bytes(self, text: np.ndarray, place: np.ndarray, symbol: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their owners, those that are no piece replaced by their bytes."""
        lost = np.flatnonzero((symbol < 0) | (symbol >= len(self.surface)))
        if len(lost):
            raw = [chr(c).encode() for c in text[place[lost]].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[lost] = [len(r) for r in raw]
            ends = np.cumsum(times)
            spread = np.repeat(symbol, times)
            where = np.repeat((ends - times)[lost], times[lost]) + np.concatenate([np.arange(len(r)) for r in raw])
            spread[where] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
            symbol, owner = spread, np.repeat(owner, times)
        return symbol, owner

    def _rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (flat), and their numbers, by merge rounds."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        place = np.arange(len(text))  # of each symbol's first character
        symbol = self.code[text]
        word = np.repeat(np.arange(len(words)), counts)
        out_place, out_symbol = [], []
        while len(symbol):
            pair = symbol[:-1].astype(np.int64) * self.size + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            fits = (self.keys[at] == pair) & (word[:-1] == word[1:]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
            made = np.where(fits, self.made[at], -1)
            rank = np.append(np.where(fits, self.rank[made], NONE), NONE)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            open_ = best < NONE
            spread = np.repeat(best, size)
            chosen = (rank == spread) & (spread < NONE)
            # of consecutive pairs of the best rank every second one overlaps the one before; in words of single ranks only the first counts
            at = np.flatnonzero(chosen)
            if len(at):
                run = np.concatenate([[True], np.diff(at) != 1])
                start = at[np.flatnonzero(run)][np.cumsum(run) - 1]
                keep = (at - start) % 2 == 0
                new = np.concatenate([[True], word[at][1:] != word[at][:-1]])
                keep &= ~self.single[rank[at]] | new
                at = at[keep]
                symbol[at] = made[at]
            live = np.repeat(open_, size)
            out_place.append(place[~live])
            out_symbol.append(symbol[~live])
            live[at + 1] = False
            symbol, word, place = symbol[live], word[live], place[live]
        place, symbol = np.concatenate(out_place), np.concatenate(out_symbol)
        order = np.argsort(place, kind="stable")
        place, symbol = place[order], symbol[order]
        owner = np.repeat(np.arange(len(words)), counts)[place]
        symbol, owner = self._with_bytes(text, place, symbol, owner)
        return symbol.astype(np.int32), np.bincount(owner, minlength=len(words))

    def words(self, text: str | None) -> Iterable[str]:
        if not text:
            return []
        if len(text) < LONG and text[0] != " " and "  " not in text and SPACE not in text:
            return [SPACE + w for w in text.split(" ")]
        marked = SPACE + text.replace(" ", SPACE)
        return self.runs(marked) if len(marked) <= LONG else (m.group() for m in self.run.finditer(marked))

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each text), without begin and end ids."""
        return self.chunks.encode(self.words(t) for t in texts)

    @property
    def _surfaces(self):
        lengths = np.fromiter(map(len, self.surface), np.int64, len(self.surface))
        return np.frombuffer(b"".join(self.surface), np.uint8), np.cumsum(lengths) - lengths, lengths

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of rows of ids, as the library's decode gives them."""
        data, starts, lengths = self._tables()
        n = lengths[flat]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        raw = data[np.repeat(starts[flat] - (ends - n), n) + np.arange(total)].tobytes()
        row_ends = np.cumsum(counts)
        bounds = np.concatenate([[0], ends])
        out = []
        for i, j in zip((row_ends - counts).tolist(), row_ends.tolist(), strict=True):
            part = raw[bounds[i] : bounds[j]]
            try:
                text = part.decode()
                out.append(text[1:] if text[:1] == " " else text)
            except UnicodeDecodeError:
                out.append(self.lib.decode(flat[i:j].tolist()))
        return out

    def _tables(self):
        if not hasattr(self, "_cached"):
            self._cached = self._surfaces
        return self._cached


@lru_cache(2)
def piece_bpe(path: str) -> PieceBpe:
    """One for each worker process."""
    return PieceBpe(path)


def round_trip(docs: DataFrame, model: str, begin_end: bool = True) -> DataFrame:
    """doc_id, ids (with begin and end ids), decoded of doc_id, text; one narrow stage.

    Null text: empty, so only the begin and end ids, decoded to an empty text. Null doc_id and repeated rows: kept, each
    row gets its result. No rows: no rows. Other columns are ignored. Texts are whole whatever their length.
    """
    return _through(docs, model, begin_end, False)


def round_trip_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids) and decoded_sha256 of `round_trip`, digested where they are made."""
    return _through(docs, model, True, True)


def _through(docs: DataFrame, model: str, begin_end: bool, digest: bool) -> DataFrame:
    common.ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from loomtext.llm.piecebpe import piece_bpe

        bpe = piece_bpe(model)
        for whole in batches:
            for b in common.slices(whole, 1):
                flat, counts = bpe.encode(b.column(1).to_pylist())
                if begin_end:
                    flat, counts = ragged(flat, counts, bpe.bos, bpe.eos)
                texts = bpe.decode(flat, counts)
                ends = np.cumsum(counts)
                if not digest:
                    ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])
                    continue
                raw = np.ascontiguousarray(flat, "<u4")
                of_ids = [hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                of_text = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
