"""Counting unigram pieces without building them: Aho-Corasick matches and a Viterbi pass that carries score and count."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .chunks import ChunkCache
from .piecebpe import SPACE

UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and stored scores of a SentencePiece file, without control, unknown and byte pieces."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    keep = (i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)))
    return [(lib.id_to_piece(i), lib.get_score(i)) for i in keep]


class UnigramCounter:
    """Number of tokens of the best segmentation under a unigram vocabulary, with byte fallback.

    Tie rules of unigram encoders: for an end position candidates come by start, leftmost first, and only a strictly
    better score replaces one; a character that is no piece alone costs the worst score less UNKNOWN_PENALTY and counts
    as its UTF-8 bytes. Pieces never run into a later space mark, so words are independent.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
            raise ValueError("pieces must start words")
        self.machine = ahocorasick.Automaton()
        for p, score in pieces:
            self.machine.add_word(p, (len(p), score))
        self.machine.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.chunks = ChunkCache(self._count_many)

    def count_word(self, word: str) -> int:
        n = len(word)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        single, unknown = self.single, self.unknown
        done = 0  # ends before this are final
        top, count = None, 0
        for end, (length, score) in self.machine.iter(word):  # by end, and the longest first
            while done < end:
                if word[done] not in single:
                    s = best[done] + unknown
                    if top is None or s > top:
                        top, count = s, pieces[done] + len(word[done].encode())
                done += 1
                best[done], pieces[done] = top, count
                top, count = None, 0
            start = end + 1 - length
            s = best[start] + score
            if top is None or s > top:
                top, count = s, pieces[start] + 1
        while done < n:
            if word[done] not in single:
                s = best[done] + unknown
                if top is None or s > top:
                    top, count = s, pieces[done] + len(word[done].encode())
            done += 1
            best[done], pieces[done] = top, count
            top, count = None, 0
        return pieces[n]

    def _count_many(self, words: list[str]):
        return np.fromiter(map(self.count_word, words), np.int32, len(words)), np.ones(len(words), np.int32)

    def count(self, split_texts) -> np.ndarray:
        flat, counts = self.chunks.encode(split_texts)
        total = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]


@lru_cache(2)
def unigram_counter(path: str):
    from .piecebpe import piece_bpe

    return UnigramCounter(vocabulary(path)), piece_bpe(path).words


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_chars (code points), n_bytes, n_tokens of doc_id, text under the unigram vocabulary in `model`; one narrow stage.

    Null text: empty, with no tokens. Null doc_id and repeated rows: kept. No rows: no rows. Other columns are ignored.
    """
    common.ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from loomtext.llm.unigram import unigram_counter

        counter, words = unigram_counter(model)
        for whole in batches:
            for b in common.slices(whole, 1):
                texts = [t or "" for t in b.column(1).to_pylist()]
                n = counter.count(words(t) for t in texts)
                chars = np.fromiter(map(len, texts), np.int64, len(texts))
                size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(chars), pa.array(size), pa.array(n)], ["doc_id", "n_chars", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_chars long, n_bytes long, n_tokens long")
