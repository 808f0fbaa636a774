"""I-Match fingerprints: terms of a document inside a band of inverse document frequency, hashed over randomised lexicon subsets."""

from __future__ import annotations

import functools
import hashlib
import math
import operator
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import mix, word_hashes

#: Shares of the lexicon that the subsets hold, as powers of 1/2, and subsets of each share: some subsets see many terms of a long text, some one or two.
SHARES, EACH = (3, 5, 7, 9), 16
SLOTS = len(SHARES) * EACH
_SEEDS = np.random.default_rng(20240613).integers(0, 1 << 63, (2, SLOTS), dtype=np.uint64) | np.uint64(1)


def _document_frequencies(batches: Iterator) -> Iterator:
    """(term, documents with it) of the task's rows, summed in the task as far as memory allows."""
    import pyarrow as pa

    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        terms, n = np.concatenate([t for t, _ in held]), np.concatenate([n for _, n in held])
        order = np.argsort(terms)
        terms, n = terms[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        return terms[first], np.add.reduceat(n, first)

    def out(terms, n):
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "df"])

    for whole in batches:
        for b in common.slices(whole, 1, 1 << 20):
            words, counts = word_hashes(b.column(1))
            at, own = 0, []
            for n in counts.tolist():
                own.append(np.unique(words[at : at + n]))
                at += n
            if at:
                terms, n = np.unique(np.concatenate(own), return_counts=True)
                held.append((terms, n.astype(np.int64)))
                size += len(terms)
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield out(*held.pop())
                    size = 0
    if held:
        yield out(*merged())


def lexicon(docs: DataFrame, least: float = 0.0005, most: float = 0.2) -> np.ndarray:
    """Sorted 64-bit hashes of the terms that between `least` and `most` of all documents have, and two at least.

    Document frequencies are counted over every text. The result is bounded whatever the corpus: a document has some
    hundreds of distinct terms, so no more than that number over `least` terms can reach this frequency. Only they go
    to the driver.
    """
    total = docs.count()
    counts = docs.select("doc_id", "text").mapInArrow(_document_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    low, high = max(2, math.ceil(least * total)), max(2, int(most * total))
    terms = [r[0] for r in counts.where(F.col("df").between(low, high)).select("term").collect()]
    return np.sort(np.array(terms, np.int64).view(np.uint64))


class Fingerprinter:
    """Rows of SLOTS 32-bit hashes, one for each lexicon subset; 0 where the text has no term of the subset."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        owner, slot = [], []
        for j in range(SLOTS):
            inside = np.flatnonzero((mix(terms * _SEEDS[0, j]) >> np.uint64(64 - SHARES[j // EACH])) == 0)
            owner.append(inside)
            slot.append(np.full(len(inside), j, np.int64))
        owner, slot = np.concatenate(owner), np.concatenate(slot)
        order = np.lexsort((slot, owner))
        self.slot = slot[order]
        self.value = mix(terms[owner[order]] ^ _SEEDS[1, self.slot]) if len(terms) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(owner[order], np.arange(len(terms) + 1))

    def __call__(self, texts: list[str]) -> np.ndarray:
        import pyarrow as pa

        words, counts = word_hashes(pa.array(texts, pa.large_string()))
        out = np.zeros(len(texts) * SLOTS, np.uint64)
        if len(self.terms) and len(words):
            at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
            hit = self.terms[at] == words
            # the sorted distinct in-band terms of each text
            key = np.unique(np.repeat(np.arange(len(texts)), counts)[hit] * len(self.terms) + at[hit])
            text, term = key // len(self.terms), key % len(self.terms)
            n = self.first[term + 1] - self.first[term]
            ends = np.cumsum(n)
            pick = np.repeat(self.first[term] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
            np.add.at(out, np.repeat(text, n) * SLOTS + self.slot[pick], self.value[pick])
        out = (mix(out) >> np.uint64(32)).astype(np.uint32).reshape(len(texts), SLOTS) | (out.reshape(len(texts), SLOTS) > 0)
        for i in np.flatnonzero(~out.any(axis=1)):  # no term in the band: the whole text stands for its terms
            seed = np.frombuffer(hashlib.blake2b(texts[i].encode(), digest_size=8).digest(), np.uint64)
            out[i] = (mix(seed ^ _SEEDS[1]) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the subsets with a term of either text whose hashes are equal; 0 to 1."""
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    return ((a == b) & (a != 0)).sum(axis=-1) / np.maximum(used, 1)


def _pack(batches: Iterator) -> Iterator:
    """Texts compressed one by one: half of what the shuffle's own codec leaves."""
    import pyarrow as pa
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        packed = pa.array([pack(t.encode()) for t in b.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), packed, *b.columns[2:]], ["doc_id", "packed", "at", "tie", "ghost", "k", "number"])


_LEAST = -(1 << 63)


def _cuts(rows: DataFrame, n: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Sorted lower bounds (at, tie, number) of about n ranges of alike size, and the hot pairs (at, tie) whose rows only a number tells apart.

    Quantiles of `at`; a value that several of them share is cut again at quantiles of `tie`, and a pair that several
    of those share at quantiles of the rows' numbers. So no id, however many rows have it, is one range.
    """
    points = lambda column, m: F.percentile_approx(column, [k / m for k in range(1, m)], 100 * m)
    found = (rows.agg(points("at", n)).first()[0] if n > 1 else None) or []
    bounds = {(v, _LEAST, _LEAST) for v in found}
    hot = {v: found.count(v) + 1 for v in sorted(set(found)) if found.count(v) > 1}
    if not hot:
        return sorted(bounds), []
    inside = lambda values: F.expr(" OR ".join(values))
    test = {v: f"at = {v}L" if v > _LEAST else "at <= -9223372036854775807L - 1" for v in hot}
    got = rows.where(inside(test.values())).agg(*[points(F.when(F.expr(test[v]), F.col("tie")), m).alias(f"p{i}") for i, (v, m) in enumerate(hot.items())]).first()
    pairs = {}
    for v, ties in zip(hot, got, strict=True):
        ties = ties or []
        bounds |= {(v, t, _LEAST) for t in ties}
        pairs |= {(v, t): ties.count(t) + 1 for t in sorted(set(ties)) if ties.count(t) > 1}
    if not pairs:
        return sorted(bounds), []
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    both = {(v, t): F.expr(test[v]) & (F.col("tie") == F.lit(t)) for v, t in pairs}
    got = numbered.agg(*[points(F.when(both[p], F.col("number")), m).alias(f"p{i}") for i, (p, m) in enumerate(pairs.items())]).first()
    for (v, t), numbers in zip(pairs, got, strict=True):
        bounds |= {(v, t, x) for x in numbers or []}
    return sorted(bounds), list(pairs)


def _below(bounds: list[tuple[int, int, int]], value: Column) -> Column:
    """Number of sorted bounds not above the value, by binary search."""
    if not bounds:
        return F.lit(0)
    array = _literal(bounds)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    n = len(bounds)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(array, at + step - 1) <= value), at + step).otherwise(at))


def _literal(places: list[tuple[int, int, int] | None]) -> Column:
    kind = "struct<at: bigint, tie: bigint, number: bigint>"
    return F.array(*[F.lit(None).cast(kind) if p is None else F.struct(*[F.lit(x).cast("long").alias(c) for x, c in zip(p, ("at", "tie", "number"), strict=True)]) for p in places]).cast(f"array<{kind}>")


def fingerprints(docs: DataFrame, least: float = 0.0005, most: float = 0.2, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of doc_id, text.

    A text's edited form has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document in descending doc_id order; after the last comes the first. Texts move once, to ranges of doc_id given by
    approximate quantiles, each with the last document of the range before, so all neighbours meet in one task.
    Null text: empty. Null doc_id: below all others, and returned. Rows that share a doc_id: ordered by a hash of their
    text; an id that fills several ranges is cut by that hash, and rows equal in both by their number in the scan. A single document is its own next. No rows: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    common.ship(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    terms = spark.sparkContext.broadcast(lexicon(docs, least, most))
    docs = docs.withColumn("at", F.coalesce("doc_id", F.lit(_LEAST).cast("long"))).withColumn("tie", F.xxhash64("text"))
    bounds, hot = _cuts(docs.select("at", "tie"), partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = F.lit(0).cast("long")
    if hot:
        held = [(F.col("at") == F.lit(v).cast("long")) & (F.col("tie") == F.lit(t).cast("long")) for v, t in hot]
        number = F.when(functools.reduce(operator.or_, held), F.monotonically_increasing_id()).otherwise(number)
    docs = docs.withColumn("number", number).withColumn("place", F.struct("at", "tie", "number"))
    bucket = _below(bounds, F.col("place"))
    last = {k: tuple(p) for k, p in docs.select("place", bucket.alias("k")).groupBy("k").agg(F.max("place")).collect()}  # one row for each range
    full = sorted(last)
    following = dict(zip(full, full[1:] + full[:1], strict=True))
    width = len(bounds) + 1
    ends = _literal([last.get(k) for k in range(width)])
    after = F.array(*[F.lit(following.get(k, 0)) for k in range(width)])
    rows = docs.withColumn("k", bucket)
    ghost = F.get(ends, F.col("k")) == F.col("place")
    rows = rows.select("doc_id", "text", "at", "tie", "number", F.posexplode_outer(F.when(ghost, F.array("k", F.get(after, F.col("k")))).otherwise(F.array("k"))).alias("ghost", "k"))
    rows = rows.select("doc_id", "text", "at", "tie", "ghost", F.col("k").cast("int").alias("k"), "number").mapInArrow(_pack, "doc_id long, packed binary, at long, tie long, ghost int, k int, number long")
    rows = rows.repartitionById(width, F.col("k")).sortWithinPartitions(F.desc("ghost"), "at", "tie", "number").select("doc_id", "packed", "ghost")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        make = None
        text, fp = "", None  # of the row before, which is the next in descending order
        for whole in batches:
            for b in common.slices(whole, 1, 1 << 19):
                make = make or Fingerprinter(terms.value)
                texts, ghosts = [unpack(p).decode() for p in b.column(1).to_pylist()], np.asarray(b.column(2).to_pylist(), np.int64)
                if fp is None:
                    fp = make([""])
                nexts = [text, *texts[:-1]]
                prints = make(texts)
                before = np.concatenate([fp, prints[:-1]])
                text, fp = texts[-1], prints[-1:]
                keep = np.flatnonzero(ghosts == 0)
                if not len(keep):
                    continue
                edited = [t[: len(t) - len(t) // 2] + x[: len(t) // 2] for t, x in ((texts[i], nexts[i]) for i in keep.tolist())]
                own, changed = prints[keep], make(edited)
                hexed = lambda m: pa.array([r.tobytes().hex() for r in m.astype(">u4")], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(keep)),
                        pa.array([len(texts[i]) for i in keep.tolist()], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                        hexed(own),
                        hexed(changed),
                        pa.array(likeness(own, changed)),
                        pa.array(likeness(own, before[keep])),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
