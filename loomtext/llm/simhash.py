"""Near-duplicates by SimHash: 64-bit fingerprints of word shingles; those that differ in few bits meet through variants of their halves with one bit deleted."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH, SEED, BITS, DIFFER = 3, 42, 64, 2
#: Bits of a segment. DIFFER differing bits over two segments leave one of them with one at most.
SEGMENT = BITS // 2
#: Fingerprints of one key that are compared with each other; those of larger groups are indexed with DIFFER bits deleted instead.
GROUP = 4096
#: Bytes of a text cut into words at a time, give or take a word: what bounds a worker's memory for very long texts.
PART = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists; each begins with the last WIDTH - 1 words of the one before."""
    tail: list[bytes] = []
    start = 0
    while start < len(text):
        space = _SPACE.search(text, min(start + PART, len(text)))
        stop = space.start() if space else len(text)
        words = tail + text[start:stop].lower().split()
        yield words
        tail, start = words[-(WIDTH - 1) :], stop


def fingerprint(text: bytes) -> int:
    """The SimHash of a text in UTF-8; words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, shingles WIDTH words joined by a blank, each counted as often as it stands there. Fewer words: the whole sequence; none: zero."""
    from xxhash import xxh64_intdigest

    total, n = np.zeros(BITS, np.int64), 0
    few: list[bytes] = []
    for words in _parts(text):
        if len(words) < WIDTH:
            few = words
            continue
        few = []
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: 1 - WIDTH].tolist(), ends[WIDTH - 1 :].tolist(), strict=True)
        h = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), ">u8", len(words) - WIDTH + 1)
        for i in range(0, len(h), 1 << 16):
            total += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(h)
    if not n and few:
        total += np.unpackbits(np.array([xxh64_intdigest(b" ".join(few), SEED)], ">u8").view(np.uint8))
        n = 1
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big") if n else 0


def _fingerprints(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for whole in batches:
        for b in common.slices(whole, 1, 4 << 20):
            texts = b.column(1).cast(pa.large_binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], ["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, bits (the fingerprint as a signed long) of doc_id, text; one row for each row."""
    common.ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints, "doc_id long, bits long")


def _differing(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def _variants(prints: DataFrame) -> DataFrame:
    """(key, w, bits): each half of a fingerprint with one of its bits w deleted, as a hash of the rest and w."""
    rest = "bits & IF(w < 32, 4294967295L, -4294967296L) & ~shiftleft(1L, w)"
    each = prints.select("bits", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("w"))
    return each.select(F.expr(f"xxhash64(w, {rest})").alias("key"), "w", "bits")


def near_prints(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b) of distinct fingerprints `bits` that differ in DIFFER bits at most, a < b.

    Such a pair differs in one bit at most in one of its halves, so both have the same variant of it: the one without that
    bit. A pair with equal halves shares all variants of it and is taken from the first alone. Every variant that two have
    is found by counting; groups of up to `group` are joined on the key with the test inside the join. Members of larger
    groups are indexed with every pair of bits deleted: at most four share such a key, so their number has no bearing on
    the work for each. For those, pairs with the least of them stand for all, which reach one another.
    """
    with common.scratch(prints.sparkSession) as keep:
        keys = _variants(prints)
        live = common.materialize(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simkeys")
        members = common.materialize(keys.where(common.flagged(F.col("key"), live, "key")).join(live, "key"), "simmembers")
        few = members.where(F.col("n") <= group).select("key", "w", "bits")
        x, y = few.alias("x"), few.alias("y")
        bit = F.expr("shiftright(x.bits ^ y.bits, x.w) & 1") == 1
        on = (F.col("x.key") == F.col("y.key")) & (F.col("x.bits") < F.col("y.bits")) & (_differing(F.col("x.bits"), F.col("y.bits")) <= DIFFER) & (bit | (F.col("x.w") % SEGMENT == 0))
        links = x.join(y, on).select(F.col("x.bits").alias("a"), F.col("y.bits").alias("b"))
        many = members.where(F.col("n") > group).select("bits").distinct()
        if not many.isEmpty():
            both = F.explode(F.expr(f"flatten(transform(sequence(0, {BITS - 2}), i -> transform(sequence(i + 1, {BITS - 1}), j -> ~(shiftleft(1L, i) | shiftleft(1L, j)))))")).alias("mask")
            gone = many.select("bits", both).select(F.col("bits").bitwiseAND(F.col("mask")).alias("rest"), "mask", "bits")
            groups = gone.groupBy("mask", "rest").agg(F.collect_set("bits").alias("g")).where(F.size("g") > 1)
            links = links.union(groups.select(F.array_min("g").alias("a"), F.explode("g").alias("b")).where("a < b"))
        links = common.materialize(links.distinct(), "simlinks")
        keep.append(links)
    return links


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id of doc_id, text: documents whose fingerprints differ in
    DIFFER bits at most are linked; component_id is the smallest doc_id reachable, itself included.

    Documents are reduced to distinct fingerprints before any key is made, so copies cost one row each; links and components
    are of fingerprints. Nothing but counts and a bitmap of bounded size goes to the driver.
    Null text or no words: fingerprint zero, linked like any other. Null doc_id: links nothing and has a null component_id,
    but has its fingerprint. Rows that share a doc_id are each judged by their text. Repeated rows are returned each. No rows:
    no rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    with common.scratch(spark) as keep:
        prints = common.materialize(fingerprints(docs), "fingerprints")
        distinct = common.materialize(prints.where("doc_id is not null").groupBy("bits").agg(F.min("doc_id").alias("least")), "distinctprints")
        links = near_prints(distinct.select("bits"), group)
        found = common.connected_components(links).select(F.col("node").alias("bits"), "component")
        placed = distinct.join(found, "bits").select("bits", "component", "least")
        lead = placed.groupBy("component").agg(F.min("least").alias("lead"))
        linked = placed.join(lead, "component").select("bits", "lead")
        of = common.materialize(distinct.join(linked, "bits", "left").select("bits", F.coalesce("lead", "least").alias("component_id")), "simclasses")
        keep += [prints, of]
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return prints.join(of, "bits", "left").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), component)
