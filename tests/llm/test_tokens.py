"""Tokenizer-based operators against the libraries, and packing."""

import base64
import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from loomtext.llm import common, packing, piecebpe, token_store, unigram
from loomtext.llm.piecebpe import piece_bpe
from loomtext.llm.queries import tokenizer_file
from loomtext.llm.wordbpe import word_bpe

SCHEMA = "part string, doc_id long, text string, ids string, length long"
LETTERS = list("aAbBtTheE's'reS  \n\t\r.,!?0127éÉßïİΣσς日本語 ▁▁ ́\x1c\x85<|>") + ["<|endoftext|>", "<|startoftext|>", "the", "ing", "   ", "    ", "😀", "don't", "'LL", "aaaa", "hhhh", "▁▁", "<s>"]


def texts(n=1500, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 60))) for _ in range(n)] + ["", None, "  ", "   a", "\n", "a" * 3000, "b c " * 5000]


def frame(spark, rows):
    return spark.createDataFrame([("x", i, t, "y", 3) for i, t in rows], SCHEMA)


def rows_of(flat, counts):
    ends = np.cumsum(counts)
    return [flat[i:j].tolist() for i, j in zip(ends - counts, ends, strict=True)]


def word_ids(text):
    return word_bpe(tokenizer_file("word_bpe_49k.json")).whole.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_word_bpe_is_the_library():
    bpe = word_bpe(tokenizer_file("word_bpe_49k.json"))
    all_ = texts()
    assert rows_of(*bpe.encode(all_)) == [word_ids(t) for t in all_]


def test_word_bpe_of_arrow_arrays_is_the_library(monkeypatch):
    import pyarrow as pa

    from loomtext.llm import chunks

    bpe = word_bpe(tokenizer_file("word_bpe_49k.json"))
    all_ = texts(1500, 31) + [f"a{chr(i)}B {chr(i)}\u0301 x{chr(i)}" for i in range(0x300)] + [f"{chr(i)}{chr(j)}" for i in range(0xA0, 0x100) for j in range(0xC0, 0x100)]
    whole, want = pa.array(all_), [word_ids(t) for t in all_]
    assert rows_of(*bpe.encode(whole)) == want
    assert rows_of(*bpe.encode(whole.slice(700, 900))) == want[700:1600]
    assert rows_of(*bpe.encode(pa.array([None, ""]))) == [[], []] and rows_of(*bpe.encode(pa.array([], pa.string()))) == []
    monkeypatch.setattr(chunks, "BLOCK", 40)
    small = chunks.ChunkCache(bpe._chunks, 3000)
    assert rows_of(*small.encode_array(whole)) == want
    monkeypatch.setattr(chunks, "LONG", 1)
    assert rows_of(*small.encode_array(whole)) == want


def test_letters_of_latin_1_need_no_library_tokenizer(monkeypatch):
    bpe, all_ = type(word_bpe(tokenizer_file("word_bpe_49k.json")))(tokenizer_file("word_bpe_49k.json")), ["Émile's garçon, ÀÖØÞß ÿ", "über'LL 12 ñ|ñ"]
    want = [word_ids(t) for t in all_]
    monkeypatch.setattr(bpe, "whole", None)
    assert rows_of(*bpe.encode(all_)) == want


def test_piece_bpe_is_the_library():
    bpe = piece_bpe(tokenizer_file("piece_bpe_32k.model"))
    all_ = texts()
    flat, counts = bpe.encode(all_)
    assert rows_of(flat, counts) == [bpe.lib.encode(t or "") for t in all_]
    assert bpe.decode(flat, counts) == [bpe.lib.decode(r) for r in rows_of(flat, counts)]
    odd = np.array([300, 3 + 0xFF, 3 + 0xE3, 301, 1, 2, 0], np.int32)
    assert bpe.decode(odd, np.array([7])) == [bpe.lib.decode(odd.tolist())]


def test_cache_that_overflows():
    bpe = piece_bpe(tokenizer_file("piece_bpe_32k.model"))
    small = piecebpe.ChunkCache(bpe.merge, 50)
    for _ in range(3):
        split = [bpe.words(t) for t in texts(300, 5)]
        assert rows_of(*small.encode(split)) == [bpe.lib.encode(t or "") for t in texts(300, 5)]


def test_caches_that_forget_and_long_texts(monkeypatch):
    from loomtext.llm import chunks

    monkeypatch.setattr(chunks, "BLOCK", 40)
    monkeypatch.setattr(chunks, "LONG", 64)
    monkeypatch.setattr(piecebpe, "LONG", 64)
    all_ = texts(500, 7)
    bpe, word = piece_bpe(tokenizer_file("piece_bpe_32k.model")), word_bpe(tokenizer_file("word_bpe_49k.json"))
    for most in (3000, 20_000, 60_000):
        small = piecebpe.ChunkCache(bpe.merge, most)
        for _ in range(2):
            assert rows_of(*small.encode(bpe.words(t) for t in all_)) == [bpe.lib.encode(t or "") for t in all_]
            assert small.bytes <= most + 40 * 4000
        small = piecebpe.ChunkCache(word._chunks, most)
        assert rows_of(*small.encode(chunks.byte_chunks((t or "").encode()) for t in all_)) == [word_ids(t) for t in all_]


def test_unigram_counts_are_those_of_sentencepiece():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(path, "rb").read())
    model.trainer_spec.model_type = 1  # the same pieces and scores, read as a unigram model
    for piece in model.pieces:  # the library adds 32-bit floats: whole numbers below 2^24 are exact there
        piece.score = max(piece.score, -40_000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    counter = unigram.UnigramCounter([(p.piece, p.score) for p in model.pieces if p.type == 1])
    words = piece_bpe(path).words
    all_ = [t for t in texts(3000, 21) if len(t or "") <= 200] + [p.piece[1:] for p in model.pieces if p.type == 1 and p.piece[0] == "▁"]
    assert counter.count([words(t) for t in all_]).tolist() == [len(library.encode(t or "")) for t in all_]


def test_unigram_counts_are_the_library():
    from tokenizers import Tokenizer, models

    path = tokenizer_file("piece_bpe_32k.model")
    pieces = unigram.vocabulary(path)
    # byte pieces must not match text: they get a score no segmentation would choose
    library = Tokenizer(models.Unigram([("<unk>", -3e9), *((f"<0x{b:02X}>", -1e9) for b in range(256)), *pieces], unk_id=0, byte_fallback=True))
    counter, words = unigram.unigram_counter(path)
    all_ = [t for t in texts() if "<0x" not in (t or "")]
    want = [len(library.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in all_]
    assert counter.count([words(t) for t in all_]).tolist() == want


def test_unigram_ties():
    counter = unigram.UnigramCounter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abb", -3.0), ("bb", -2.0)])
    assert [counter.count_word(w) for w in ("▁ab", "▁abb", "▁a日b")] == [2, 2, 6]


@pytest.mark.parametrize("n", [0, 1, 40])
def test_token_store(spark, n):
    own = texts(n)[: max(n, 0)] if n else []
    rows = [(i * 7 % 101, t) for i, t in enumerate(own)] + ([(None, "null id"), (500, None), (500, None), (501, "x " * 9000)] if n else [])
    path = common.work_path(spark, "t")
    token_store.write_tokens(frame(spark, rows), path, tokenizer_file("word_bpe_49k.json"))
    got = token_store.digests(spark, path).collect()
    want, before = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*word_ids(t), 2]
        want.append((i, before, len(ids), crc(ids)))
        before += len(ids)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    if n > 1:
        found = token_store.lookup(spark, path, [500])
        assert found.count() == 2 and "EqualTo(doc_id,500)" in found._jdf.queryExecution().executedPlan().toString()


def placed(runs, counts):
    bins = {}
    for length, n in counts.items():
        own = sorted(r for r in runs if r[0] == length)
        for rank in range(n):
            r = [x for x in own if x[1] <= rank][-1]
            among = rank - r[1]
            bins.setdefault(r[2] + among // r[3], []).append((r[4] + among % r[3] * length, length))
    return bins


def best_fit_decreasing(lengths, capacity):
    out = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, x in enumerate(out) if x + n <= capacity]
        if fits:
            out[max(fits, key=out.__getitem__)] += n
        else:
            out.append(n)
    return len(out)


def test_plan_packing():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 30, 64, 2048])
        lengths = [rng.choice([rng.randint(1, capacity), capacity, max(1, capacity // 3), capacity // 2]) for _ in range(rng.randint(0, 300))]
        bins = placed(packing.plan_packing(Counter(lengths), capacity), Counter(lengths))
        for items in bins.values():
            end = 0
            for at, n in sorted(items):
                assert at == end
                end += n
            assert end <= capacity and sum(3 * n > capacity for _, n in items) <= 2
        assert sum(map(len, bins.values())) == len(lengths)
        least = best_fit_decreasing(lengths, capacity)
        assert len(bins) <= least + max(1, least // 50)
    with pytest.raises(ValueError):
        packing.plan_packing({11: 1}, 10)


def test_pack(spark):
    rows = [(i // 2, t) for i, t in enumerate(texts(200))] + [(None, "a b c")] * 40 + [(7000, "word " * 3000)]
    got = packing.pack(frame(spark, rows), tokenizer_file("word_bpe_49k.json"), 64).collect()
    want = Counter()
    for i, t in rows:
        ids = [*word_ids(t), 0]
        for k in range(0, len(ids), 64):
            want[i, k // 64, k, len(ids[k : k + 64]), crc(ids[k : k + 64])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        end = 0
        for at, n in sorted(items):
            assert at == end
            end += n
        assert end <= 64
    lengths = [r.length for r in got]
    assert len(bins) <= best_fit_decreasing(lengths, 64) * 1.02 + 1
    assert packing.pack(frame(spark, []), tokenizer_file("word_bpe_49k.json")).count() == 0


def test_round_trip(spark):
    rows = list(enumerate(texts(60))) + [(None, "x")]
    lib = piece_bpe(tokenizer_file("piece_bpe_32k.model")).lib
    path = tokenizer_file("piece_bpe_32k.model")
    full = {(r.doc_id, tuple(r.ids), r.decoded) for r in piecebpe.round_trip(frame(spark, rows), path).collect()}
    want = {(i, (1, *lib.encode(t or ""), 2), lib.decode([1, *lib.encode(t or ""), 2])) for i, t in rows}
    assert full == want
    short = {tuple(r) for r in piecebpe.round_trip_digests(frame(spark, rows), path).collect()}
    assert short == {(i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, ids, t in want}
    assert piecebpe.round_trip_digests(frame(spark, []), path).count() == 0


def test_count_tokens(spark):
    rows = [(1, None), (None, "the thing"), (2, ""), (2, "日本 é")]
    got = {(r.doc_id, r.n_chars, r.n_bytes, r.n_tokens > 0) for r in unigram.count_tokens(frame(spark, rows), tokenizer_file("piece_bpe_32k.model")).collect()}
    assert got == {(1, 0, 0, False), (None, 9, 9, True), (2, 0, 0, False), (2, 4, 9, True)}


@pytest.mark.parametrize("kind", ["base64", "letter", "cjk", "joined", "mixed", "signs"])
def test_long_words_equal_the_library(kind):
    """Texts without blanks, in time that grows about as their length: the ids of the library."""
    rng = random.Random(7)
    words = ["the", "over", "strasse", "été", "слово", "ing", "un"]
    text = {
        "base64": base64.b64encode(rng.randbytes(750_000)).decode(),
        "letter": "a" * 1_000_000,
        "cjk": "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(200_000)),
        "joined": "".join(rng.choices(words, k=100_000)),
        "mixed": "".join(rng.choices("abcXYZ09é中\U0001f600", k=200_000)),
        "signs": "=" * 100_000 + " x" + "-" * 100_000,
    }[kind]
    bpe = piecebpe.PieceBpe(tokenizer_file("piece_bpe_32k.model"))
    began = time.time()
    flat, counts = bpe.encode([text, "a b", text[:300]])
    took = time.time() - began
    ends = np.cumsum(counts)
    assert flat[: ends[0]].tolist() == bpe.lib.encode(text) and flat[ends[0] : ends[1]].tolist() == bpe.lib.encode("a b") and flat[ends[1] :].tolist() == bpe.lib.encode(text[:300])
    assert took < 60


@pytest.mark.parametrize("limit", [1, 2, 5, 1000])
def test_heap_and_rounds_agree(limit, monkeypatch):
    monkeypatch.setattr(piecebpe, "WORD", limit)
    bpe = piecebpe.PieceBpe(tokenizer_file("piece_bpe_32k.model"))
    rng = random.Random(limit)
    texts = ["".join(rng.choices("aabbcdeéß中 \n\U0001f600the", k=rng.randrange(0, 60))) for _ in range(400)] + ["", " ", "aaaa" * 20]
    flat, counts = bpe.encode(texts)
    assert [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] == [bpe.lib.encode(t) for t in texts]


def test_mixed_chunks_are_gathered_once():
    """ASCII chunks, others and those with a special token, in any order, with ids as one array and lengths as another."""
    from loomtext.llm.wordbpe import WordBpe

    bpe = WordBpe(tokenizer_file("word_bpe_49k.json"))
    chunks = ["Hello", "\u00e9", "a<|endoftext|>b", "it's", "<|x|>", "\u65e5\u672c", "\u200b", "12ab"]
    flat, lengths = bpe._chunks([c.encode() for c in chunks])
    own = [bpe.whole.encode(c, add_special_tokens=False).ids for c in chunks]
    assert flat.tolist() == [i for ids in own for i in ids] and lengths.tolist() == [len(ids) for ids in own]
