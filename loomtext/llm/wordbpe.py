"""The word-level BPE tokenizer of the tokenizers library, encoded through the chunk cache."""

from __future__ import annotations

import itertools
import json
from functools import lru_cache

import numpy as np

from .chunks import ChunkCache, byte_chunks, gathered

#: No id: where a chunk ends.
END = -1


def _byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class WordBpe:
    """Exactly the library's ids. Chunks of ASCII and the letters of Latin-1 are lower-cased and cut by the tokenizer's own
    pattern here and each distinct piece goes to the library's model once; every other chunk goes through the whole library
    tokenizer. White space is dropped by the pattern, and neither its normalizer nor its added tokens cross ASCII white
    space, so chunks are independent. No two characters of Latin-1 compose, and its letters have a lower case in it."""

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        specials = [t["content"] for t in json.load(open(path))["added_tokens"]]
        self.odd = re.compile("|".join(["[^\\x00-\\x7fÀ-ÖØ-öø-ÿ]", *map(re.escape, specials)])).search
        self.find = re.compile("\n|'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\\x20\\x09-\\x0Da-z0-9ß-öø-ÿ]+").findall
        self.letters = _byte_letters()
        self.pieces = ChunkCache(self._model, 64 << 20)
        self.chunks = ChunkCache(self._chunks)

    def _model(self, pieces: list[str]):
        """The ids of pieces; END for the line end, which ends a chunk."""
        table, tokenize = self.letters, self.model.tokenize
        rows = [[END] if p == "\n" else [t.id for t in tokenize(p if p.isascii() and p.isalnum() else "".join([table[b] for b in p.encode()]))] for p in pieces]
        lengths = np.fromiter(map(len, rows), np.int32, len(rows))
        return np.fromiter(itertools.chain.from_iterable(rows), np.int32, int(lengths.sum())), lengths

    def _plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Of the chunks that line ends close in a text, cut in one go."""
        flat = self.pieces.values(self.find(text.lower()))
        ends = np.flatnonzero(flat == END)
        return np.delete(flat, ends), np.diff(ends, prepend=-1) - 1

    def _chunks(self, chunks: list[bytes]):
        odd, text = self.odd, b"\n".join(chunks).decode()
        if not odd(text):
            return self._plain(text + "\n")
        each = text.split("\n")
        held = np.fromiter((odd(c) is None for c in each), bool, len(each))
        plain, other = np.flatnonzero(held), np.flatnonzero(~held)
        flat, counts = self._plain("".join([each[i] + "\n" for i in plain.tolist()]))
        rows = [e.ids for e in self.whole.encode_batch_fast([each[i] for i in other.tolist()], add_special_tokens=False)]
        flat = np.concatenate([flat, np.fromiter(itertools.chain.from_iterable(rows), np.int32)])
        # both kinds lie in flat one after the other; each chunk's values are picked from there in the order of chunks
        lengths = np.zeros(len(chunks), np.int64)
        lengths[plain] = counts
        lengths[other] = np.fromiter(map(len, rows), np.int64, len(rows))
        order = np.concatenate([plain, other])
        starts = np.zeros(len(chunks), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return gathered(flat, starts, lengths), lengths

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids of each text) of a list or an Arrow array; a null text is empty."""
        if isinstance(texts, list):
            return self.chunks.encode(byte_chunks((t or "").encode()) for t in texts)
        return self.chunks.encode_array(texts)


@lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    """One for each worker process."""
    return WordBpe(path)
