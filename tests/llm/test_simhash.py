"""SimHash fingerprints and their links against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import common, queries, simhash
from test_dedup import frame, roots

DATA = "/root/testdata/sf0.001"


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain(rows):
    prints = [plain_print(t) for _, t in rows]
    own = [k for k, (d, _) in enumerate(rows) if d is not None]
    of = roots(range(len(rows)), [(i, j) for n, j in enumerate(own) for i in own[:n] if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for k in own:
        least[of[k]] = min(rows[k][0], least.get(of[k], rows[k][0]))
    return sorted((repr(d), f"{p:016x}", None if d is None else least[of[k]]) for k, ((d, _), p) in enumerate(zip(rows, prints, strict=True)))


def got(df):
    return sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in df.collect())


def copies(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows, base = [], None
    for i in range(n):
        if base is None or rng.random() < 0.2:
            base = rng.choices(words, k=rng.choice([1, 2, 3, 40, 400]))
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i * 3 % n if i % 17 else 5, " ".join(t)))
    return rows


def test_whole_table(spark):
    rows = [(r[0], r[1]) for r in common.table(spark, DATA, "documents").select("doc_id", "text").collect()]
    assert got(queries.op13_simhash_near_dedup(spark, DATA)) == plain(rows)


@pytest.mark.parametrize("group", [1, 2, simhash.GROUP])
def test_near_copies(spark, group):
    rows = copies(150) + [(500, None), (501, ""), (502, " \n\t"), (503, "Ab\x0bAB  ab"), (504, "ab ab ab"), (505, "É é"), (None, "ab ab ab"), (500, None), (506, "a b c"), (507, "x" * 3000)]
    assert got(simhash.near_duplicates(frame(spark, rows), group)) == plain(rows)


def test_empty(spark):
    df = simhash.near_duplicates(frame(spark, []))
    assert df.collect() == [] and df.columns == ["doc_id", "fingerprint", "component_id"]


@pytest.mark.parametrize("group", [1, 40, simhash.GROUP])
def test_links(spark, group):
    """All pairs of fingerprints within two bits, or chains that lead from one to the other, for random ones and for a ball around one."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    ball = [base[0] ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for i, j in rng.integers(0, 64, (120, 2))]
    some = [x ^ np.uint64(m) for x in base for m in (1, 1 << 31, 1 << 32 | 1, 7, 1 << 63 | 1 << 62 | 1 << 31)]
    prints = sorted({int(x) - (1 << 64 if x >> np.uint64(63) else 0) for x in [*base, *ball, *some]})
    links = {(r[0], r[1]) for r in simhash.near_prints(spark.createDataFrame([(p,) for p in prints], "bits long"), group).collect()}
    near = {(a, b) for k, b in enumerate(prints) for a in prints[:k] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert links <= near and roots(prints, links) == roots(prints, near)
    if group == simhash.GROUP:
        assert links == near


def test_long_texts():
    """Parts of a long text give the fingerprint of the whole, wherever they are cut."""
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "b", "Gamma" * 9, "é", "\n"]) for _ in range(3000))
    want = plain_print(text)
    for part in (1, 7, 64, 1000):
        before, simhash.PART = simhash.PART, part
        try:
            assert simhash.fingerprint(text.encode()) == want
        finally:
            simhash.PART = before


def test_native_hash_is_the_same(spark):
    """Spark's own xxhash64 of a string is XXH64 with seed 42: a second view of what the fingerprints sum."""
    got = spark.createDataFrame([("a b c",), ("é x y" * 20,)], "s string").select("s", F.xxhash64("s")).collect()
    assert all(h % (1 << 64) == xxhash.xxh64_intdigest(s.encode(), 42) for s, h in got)
