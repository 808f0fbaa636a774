"""Near-duplicates, line dedup and fingerprints against brute force."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.llm import common, imatch, linededup, minhash
from loomtext.llm.wordhash import word_hashes

SCHEMA = "doc_id long, text string, lang string, key string, a long, rep long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "k", 1, 2) for i, t in rows], SCHEMA)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_word_hashes():
    texts = ["Ab ab\x0bAB", "", None, "  x y x", "ab", " ", "É é"]
    h, n = word_hashes(pa.array(texts))
    assert n.tolist() == [3, 0, 0, 2, 1, 0, 2]
    assert len({*h[:3].tolist(), int(h[5])}) == 1 and h[3] != h[4] and h[6] != h[7]


def near_copies(rng, n):
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    rows, base = [], None
    for i in range(n):
        kind = rng.random()
        if base is None or kind < 0.4:
            base = rng.choices(words, k=rng.choice([3, 5, 30, 120, 200]))
            text = " ".join(base)
        elif kind < 0.6:
            text = "  ".join(base).upper() if rng.random() < 0.5 else " ".join(base)
        elif kind < 0.8:
            own = list(base)
            for _ in range(rng.randint(1, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            text = "\n".join(own)
        else:
            text = passage + " " + " ".join(rng.choices(words, k=40))
        rows.append((i * 3, text))
    return rows


def test_near_duplicates(spark):
    rng = random.Random(3)
    rows = near_copies(rng, 260) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "One  TWO")]
    base = [f"b{i}" for i in range(150)]
    for i in range(120):  # one large group of near copies
        own = list(base)
        own[i] = f"x{i}"
        rows.append((20000 + i, " ".join(own)))
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = roots(ids, links)
    got = minhash.near_duplicates(frame(spark, rows), 85).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "word " * 40000)]
    got = sorted(minhash.near_duplicates(frame(spark, rows)).collect(), key=str)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, None)]
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(frame(spark, rows), 50)


def test_shared_doc_ids_are_judged_apart(spark):
    import corpus_pipeline

    words = [f"v{i}" for i in range(60)]
    near = " ".join([*words[:59], "x"])
    other = "something else that is not like it at all"
    rows = [(3, " ".join(words)), (7, near), (7, other), (7, None), (8, None), (None, near), (9, other), (9, " ".join(words))]
    got = minhash.near_duplicates(frame(spark, rows), 85).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, 56, 3, True), (7, 56, 3, False), (7, 5, 7, True), (7, 0, 7, True), (8, 0, 8, True), (None, 56, None, None), (9, 5, 7, False), (9, 56, 3, False)], key=str)
    clash = frame(spark, rows).selectExpr("*", "1 as tag", "2 as component_id", "3 as kept", "4 as n_shingles", "5 as node", "6 as _at")
    left = corpus_pipeline.near_dedup(spark, clash, "")
    assert left.columns == clash.columns
    assert sorted(((r.doc_id, r.text, r.kept) for r in left.collect()), key=str) == sorted([(3, " ".join(words), 3), (7, other, 3), (7, None, 3), (8, None, 3), (None, near, 3)], key=str)


def test_near_duplicates_with_shared_ids_against_brute_force(spark):
    rng = random.Random(31)
    rows = [(i % 40, t) for i, t in near_copies(rng, 160)]
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for b in range(len(rows)) for a in range(b) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    of = roots(range(len(rows)), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[of[k]] = min(i, least.get(of[k], i))
    want = sorted((i, len(sets[k]), least[of[k]] if sets[k] else i, (least[of[k]] if sets[k] else i) == i) for k, (i, _) in enumerate(rows))
    assert sorted(map(tuple, minhash.near_duplicates(frame(spark, rows), 85).collect())) == want


@pytest.mark.parametrize("block", [1, 3, minhash.BLOCK])
def test_blocks_against_brute_force(spark, block, monkeypatch):
    """Groups of texts around the threshold, beside a large component: compared in blocks of any size, no link is lost."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(block)
    rows, words = [], [f"w{i}" for i in range(3000)]
    for base in range(2):
        text = rng.choices(words, k=120)
        for k in range(45):
            t = list(text)
            for at in rng.sample(range(120), rng.choice([0, 1, 1, 2, 2, 3])):
                t[at] = rng.choice(words)
            rows.append((base * 100 + k, " ".join(t)))
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    of = roots(range(len(rows)), links)
    least = {r: min(rows[i][0] for i in range(len(rows)) if of[i] == r) for r in set(of.values())}
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {rows[i][0]: least[of[i]] for i in range(len(rows))}


def test_group_just_under_the_threshold(spark):
    """1,200 texts of which most two are about 0.78 alike, some more: nearly all pairs are candidates, none is shipped as texts."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(1200):
        t = list(base)
        for at in range(5):
            t[80 * at + rng.randrange(60)] = f"x{i}_{at}"
        rows.append((i, " ".join(t)))
        if i % 100 == 0:
            t[399] = f"y{i}"
            rows.append((5000 + i, " ".join(t)))
    began = time.time()
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert time.time() - began < 240
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    of = roots(range(len(rows)), links)
    least = {r: min(rows[i][0] for i in range(len(rows)) if of[i] == r) for r in set(of.values())}
    assert 12 <= len(links) and got == {rows[i][0]: least[of[i]] for i in range(len(rows))}


def test_word_hashes_in_parts(monkeypatch):
    from loomtext.llm import wordhash

    texts = pa.array(["a bc  def " * 50, None, "x" * 9000 + " y", "", "Tail\nwords é"] * 3)
    want = word_hashes(texts)
    monkeypatch.setattr(wordhash, "PART", 64)
    got = word_hashes(texts)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_pipeline_links_from_80(spark):
    import corpus_pipeline

    rng = random.Random(8)
    rows = []
    for i in range(40):  # 32 shingles of 40 shared: 0.80
        words = [f"v{rng.randrange(10**6)}" for _ in range(44)]
        rows += [(2 * i, " ".join(words[:40])), (2 * i + 1, " ".join(words[:36] + words[40:]))]
    assert {100 * len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)} == {80}
    left = corpus_pipeline.near_dedup(spark, frame(spark, rows), "").select("doc_id").collect()
    assert sorted(r.doc_id for r in left) == list(range(0, 80, 2))
    for percent in (80, 85):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.band_count(percent) < 4e-6


def test_small_sets_are_not_lost_to_the_estimate(spark):
    rng = random.Random(6)
    rows = []
    for i in range(3000):  # 6 against 7 shingles: 0.857
        words = [f"v{rng.randrange(10**6)}" for _ in range(11)]
        rows += [(2 * i, " ".join(words[:10])), (2 * i + 1, " ".join(words))]
    low = [minhash.minima(s) & 3 for s in minhash.shingle_sets(pa.array([t for _, t in rows]))]
    assert any(((low[2 * i] == low[2 * i + 1]).mean() - 0.25) / 0.75 < 0.78 for i in range(3000))
    assert minhash.near_duplicates(frame(spark, rows), 85).where("kept").count() == 3000


def test_estimate_is_unbiased():
    rng = np.random.default_rng(5)
    errors = []
    for share in (0.3, 0.7, 0.9):
        for _ in range(20):
            common = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
            n = int(600 * (1 - share) / (2 * share))
            a, b = (np.concatenate([common, rng.integers(0, 1 << 63, n, dtype=np.uint64)]) for _ in range(2))
            x, y = minhash.minima(a) & 3, minhash.minima(b) & 3
            true = 600 / (600 + 2 * n)
            equal = 0.25 + 0.75 * true
            deviation = (equal * (1 - equal) / minhash.HASHES) ** 0.5 / 0.75
            errors.append((((x == y).mean() - 0.25) / 0.75 - true) / deviation)
    assert abs(np.mean(errors)) < 0.6 and np.max(np.abs(errors)) < 5


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    rng = random.Random(k)
    rows = []
    for n in (0, 1, 2, 3, 5, 9, 30):
        for _ in range(40):
            a = rng.choices("abc", k=n)
            b = list(a)
            for _ in range(rng.randint(0, k + 2)):
                at, kind = rng.randint(0, len(b)), rng.random()
                b[at : at + (kind < 0.6)] = [] if kind < 0.3 else [rng.choice("abcd")]
            rows.append(([ord(c) for c in a], [ord(c) for c in b], edit(a, b)))
            other = rng.choices("abc", k=max(0, n + rng.randint(-k, k)))
            rows.append(([ord(c) for c in a], [ord(c) for c in other], edit(a, other)))
    df = spark.createDataFrame(rows, "a array<int>, b array<int>, d int").selectExpr("d", f"{linededup.banded_distance('a', 'b', str(k), 3)} as got", f"{linededup.banded_distance('b', 'a', str(k), k)} as back", f"{linededup.banded_distance('a', 'b', str(k), k, exact=False)} as enough")
    for r in df.collect():
        assert (r.got, r.back) == (r.d, r.d) if r.d <= k else min(r.got, r.back) > k
        assert r.d <= r.enough <= k if r.d <= k else r.enough > k


@pytest.mark.parametrize("k", [1, 2, 3])
def test_edit_links(spark, k):
    rng = random.Random(k)
    lines = set()
    for _ in range(12):
        base = "".join(rng.choices("abcd ", k=rng.choice([6, 9, 24, 40])))
        for _ in range(22):
            own = list(base)
            for _ in range(rng.randint(0, k + 1)):
                at, kind = rng.randrange(len(own)), rng.random()
                own[at : at + 1] = [] if kind < 0.3 else [rng.choice("abcd")] if kind < 0.6 else [own[at], rng.choice("abcd")]
            lines.add("".join(own))
    lines |= {"prefix shared by all of them %s" % c for c in "abcdefghijklmnopqrstuvwxyz"}
    lines |= {"x%sy" % c for c in "abcdefghijklmnopqrstuvwxyz"} | {"x%sqy" % c for c in "abcdefgh"}
    lines = sorted(x for x in lines if len(x) > k)
    rows = [(i, x) for i, x in enumerate(lines)] + [(0, lines[0])] * 30
    got = {(r.a, r.b) for r in linededup.edit_links(spark.createDataFrame(rows, "id long, line string"), k, group=8).collect()}
    want = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if abs(len(lines[i]) - len(lines[j])) <= k and edit(lines[i], lines[j]) <= k}
    assert got <= want
    assert roots(range(len(lines)), got) == roots(range(len(lines)), want)


def test_word_links(spark):
    rng = random.Random(12)
    lines = set()
    for n in (8, 10, 12, 19, 20, 22, 29, 30, 33, 60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                at, kind = rng.randrange(len(own)), rng.random()
                own[at : at + 1] = [] if kind < 0.3 else [f"x{rng.randrange(10**6)}"] if kind < 0.6 else [own[at], f"y{rng.randrange(10**6)}"]
            lines.add(" ".join(own))
    lines = sorted(lines)
    words = [x.split(" ") for x in lines]
    got = {(r.a, r.b) for r in linededup.word_links(spark.createDataFrame(list(enumerate(lines)), "id long, line string")).collect()}
    want = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if edit(words[i], words[j]) <= min(3, len(words[i]) // 10, len(words[j]) // 10)}
    assert len(want) > 50 and got == want


@pytest.mark.parametrize("n", [300, 10_000])
def test_boilerplate_does_not_multiply(spark, n):
    """Lines of four own words before 116 that all share: none is near another but for some that we make so."""
    rng = random.Random(n)
    tail = " ".join(f"t{i}" for i in range(116))
    lines = [" ".join(f"{c}{i}" for c in "abcd") + " " + tail for i in range(n)]
    near = {}
    for i in range(0, n, 50):
        w = lines[i].split(" ")
        for at in rng.sample(range(4), rng.randrange(1, 4)):
            w[at] = f"x{i}_{at}"
        near[i] = len(lines)
        lines.append(" ".join(w))
    began = time.time()
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string").repartition(4)
    got = {(r["a"], r["b"]) for r in linededup.word_links(df).collect()}
    assert got == set(near.items())
    assert time.time() - began < 120


@pytest.mark.parametrize("group", [1, 3, 20])
def test_lines_of_few_words(spark, group):
    """Lines from a small vocabulary, so that the rarest words too are shared by many: components as by brute force."""
    rng = random.Random(group)
    words = [f"v{i}" for i in range(7)]
    lines = sorted({" ".join(rng.choices(words, k=rng.choice([10, 11, 20, 21]))) for _ in range(70)} | {" ".join(["v1"] * 9 + rng.choices(words, k=2)) for _ in range(50)} | {" ".join(rng.choices(words, k=5) + ["z"] * 16) for _ in range(60)})
    near = set()
    for j in range(len(lines)):
        for i in range(j):
            a, b = lines[i].split(" "), lines[j].split(" ")
            if edit(a, b) <= min(3, min(len(a), len(b)) // 10):
                near.add((i, j))
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {(r["a"], r["b"]) for r in linededup.word_links(df, group=group).collect()}
    assert got <= near | {(b, a) for a, b in near} and roots(range(len(lines)), got) == roots(range(len(lines)), near)


def test_changed_words_make_a_line_near(spark):
    line = "some words of a line that stands in both of these texts with one name, London, in it"
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(frame(spark, [(1, line), (2, line.replace("London", "Reykjavik")), (3, line.replace("these texts", "other places"))])).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_short_lines_match_exactly(spark):
    from loomtext.llm import queries

    class Docs:
        class read:
            parquet = staticmethod(lambda path: frame(spark, [(1, "short\nshorn\n\n"), (2, "a\nshort\n\na")]))

    got = queries.op4_line_dedup(Docs, "").select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(1, 0), (2, 2)]


def test_dedup_lines_against_brute_force(spark):
    rng = random.Random(77)
    vocabulary = [f"{c}{i}" for i in range(30) for c in ("alpha", "be", "gamma", "d")]
    pool = []
    for n in (1, 2, 4, 6, 9, 10, 11, 19, 20, 21, 22, 31, 45):
        for _ in range(3):
            pool.append(rng.choices(vocabulary, k=n))

    def line():
        own = list(rng.choice(pool))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        out = " ".join(own)
        if rng.random() < 0.3:
            at = rng.randrange(len(out))
            out = out[:at] + rng.choice(["", " ", "x", out[at] + "y"]) + out[at + 1 :]
        return rng.choice([out, out, out, "", "  ", "yes"])

    rows = [(i // 2, "\n".join(line() for _ in range(rng.randint(1, 9)))) for i in range(70)]
    rows += [rows[5], (None, line()), (900, None), (901, "")]
    distinct = sorted({x for _, t in rows for x in (t or "").split("\n") if x.strip()})

    def near(a, b):
        x, y = a.split(" "), b.split(" ")
        k, w = min(1, min(len(a), len(b)) // 24), min(3, min(len(x), len(y)) // 10)
        return abs(len(a) - len(b)) <= k and edit(a, b) <= k or abs(len(x) - len(y)) <= w and edit(x, y) <= w

    of = roots(range(len(distinct)), [(i, j) for j in range(len(distinct)) for i in range(j) if near(distinct[i], distinct[j])])
    number = {x: of[i] for i, x in enumerate(distinct)}
    tags = {t: h for t, h in spark.createDataFrame([(t,) for _, t in rows], "t string").selectExpr("t", "xxhash64(t)").collect()}
    first = {}
    for i, t in rows:
        for pos, x in enumerate((t or "").split("\n")):
            if x in number:
                place = (i is not None, i or 0, tags[t], pos)
                first[number[x]] = min(place, first.get(number[x], place))
    want = []
    for i, t in rows:
        if t is None:
            want.append((i, None, 0, 0, 0))
            continue
        lines = t.split("\n")
        left = [x for pos, x in enumerate(lines) if x not in number or first[number[x]] == (i is not None, i or 0, tags[t], pos)]
        want.append((i, "\n".join(left), len(lines), len(lines) - len(left), sum(bool(x.strip()) for x in left)))
    clash = frame(spark, rows).selectExpr("*", "1 as `place`", "2 as lost", "3 as tag", "4 as `new`", "5 as `a.b`")
    out = linededup.dedup_lines(clash)
    assert out.columns == [*clash.columns, "n_lines", "n_removed", "n_left"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_left) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[3] for r in want) > 60
    with pytest.raises(ValueError):
        linededup.dedup_lines(out)


def test_dedup_lines(spark):
    long = "a line that is long enough to count, number "
    texts = [
        (3, f"{long}1\nshort\n{long}2 and more of it here"),
        (1, f"{long}7\nshort\nshort"),
        (2, None),
        (4, ""),
        (5, f"{long}3 and more of it here\nother words that are quite long here"),
        (None, "other words that are quite long here"),
        (6, f"{long}1"),
        (6, f"{long}1"),
        (7, "\n" * 50 + "           " * 5),
    ]
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed, r.n_left, r.lang, r.rep) for r in linededup.dedup_lines(frame(spark, texts)).collect()}
    assert got == {
        (1, f"{long}7\nshort", 3, 1, 2, "en", 2),
        (2, None, 0, 0, 0, "en", 2),
        (3, f"{long}2 and more of it here", 3, 2, 1, "en", 2),
        (4, "", 1, 0, 0, "en", 2),
        (5, "", 2, 2, 0, "en", 2),
        (None, "other words that are quite long here", 1, 0, 1, "en", 2),
        (6, "", 1, 1, 0, "en", 2),
        (7, "\n" * 50 + "           " * 5, 51, 0, 0, "en", 2),
    }
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_fingerprints(spark, partitions):
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(60)]
    rows = [(i * 5 % 97, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(60)] + [(200, None), (None, "null id"), (201, "w1é w1é"), (202, "w1é w1é"), (203, "")]
    got = {r.doc_id: r for r in imatch.fingerprints(frame(spark, rows), 0.01, 0.9, partitions).collect()}
    order = sorted(rows, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    by_text = {}
    for (i, t), (_, x) in zip(order, order[1:] + order[:1], strict=True):
        t, x = t or "", x or ""
        e = t[: len(t) - len(t) // 2] + x[: len(t) // 2]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (e != t or r.near_edited == 1)
    assert got[202].near_next == 1.0
    assert imatch.fingerprints(frame(spark, []), partitions=2).count() == 0


WORD = (1 << 64) - 1


def plain_mix(x):
    for shift, times in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        x = (x ^ (x >> shift)) * times & WORD
    return x


def plain_word(word):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in word.encode())
    return plain_mix(sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(raw)) & WORD ^ len(raw) * 0xD6E8FEB86659FD93 & WORD)


def plain_print(text, lexicon):
    seeds = imatch._SEEDS.tolist()
    out = []
    for j in range(imatch.SLOTS):
        own = {t for t in map(plain_word, re.findall(r"[^\x20\x09-\x0D]+", text)) if t in lexicon and plain_mix(t * seeds[0][j] & WORD) >> (64 - imatch.SHARES[j // imatch.EACH]) == 0}
        total = sum(plain_mix(t ^ seeds[1][j]) for t in own) & WORD
        out.append(plain_mix(total) >> 32 | 1 if total else 0)
    if not any(out):
        seed = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")
        out = [plain_mix(seed ^ s) >> 32 | 1 for s in seeds[1]]
    return out


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in used) / max(1, len(used))


@pytest.mark.parametrize("partitions", [1, 6])
def test_fingerprints_against_brute_force(spark, partitions):
    rng = random.Random(14)
    vocabulary = [f"w{i}É" for i in range(90)] + ["The", "of"]
    text = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))
    rows = [(i, text()) for i in range(0, 90, 3)] + [(None, text()) for _ in range(40)] + [(7, "the same the same w1é")] * 40 + [(8, text()) for _ in range(30)] + [(9, None)]
    rng.shuffle(rows)
    df = frame(spark, rows)
    tags = dict(df.selectExpr("coalesce(text, '') as t", "xxhash64(coalesce(text, ''))").collect())
    order = sorted(((-(1 << 63) if i is None else i, tags[t or ""], i, t or "") for i, t in rows), key=lambda r: r[:2])
    counts = {}
    for _, t in rows:
        for w in {plain_word(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")}:
            counts[w] = counts.get(w, 0) + 1
    lexicon = {w for w, n in counts.items() if max(2, -(-len(rows) * 3 // 100)) <= n <= int(0.2 * len(rows))}
    want = []
    for k, (_, _, i, t) in enumerate(order):
        x = order[k - 1][3]  # the one before in ascending order is the next in descending order
        e = t[: len(t) - len(t) // 2] + x[: len(t) // 2]
        a, b, c = (plain_print(y, lexicon) for y in (t, e, x))
        shown = ["".join(f"{v:08x}" for v in y) for y in (a, b)]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), *shown, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in imatch.fingerprints(df, 0.03, 0.2, partitions).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    if partitions > 1:
        bounds, hot = imatch._cuts(df.selectExpr("coalesce(doc_id, -9223372036854775807 - 1) as at", "xxhash64(coalesce(text, '')) as tie"), 6)
        assert len(bounds) > 3 and any(b[1] > -(1 << 63) for b in bounds)


def test_a_block_of_near_copies_gives_fewer_links_than_members():
    """Of 60 texts that are all near one another a block gives links that join them, not all pairs, and none where an earlier band is shared."""
    import numpy as np
    import pyarrow as pa

    texts = [" ".join(f"w{i}" if i != 7 * t % 200 else f"x{t}" for i in range(200)) for t in range(60)]
    n = len(texts)
    made = next(minhash._sketches(iter([pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(texts), pa.array(range(n))], ["doc_id", "text", "tag"])]), 40))
    rep = pa.StructArray.from_arrays([pa.array(range(n)), pa.array(range(n))], ["set_a", "set_b"])
    zeros, heads = pa.array(np.zeros(n, np.int32)), pa.array([[t, 5] for t in range(n)], pa.list_(pa.int32()))
    table = pa.table({"key": pa.array(np.zeros(n, np.int64)), "i": zeros, "j": zeros, "sub": zeros, "rep": rep, "component": rep, "n_shingles": made.column("n_shingles"), "low": made.column("low"), "heads": heads, "band": pa.array(np.ones(n, np.int32)), "text": pa.array(texts)})
    assert minhash._wanted_members(85, 0.07)(table.drop_columns("text")).num_rows == n
    links = minhash._confirmed_in_block(85, 0.07)(table)
    root = list(range(n))
    for a, b in zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True):
        x, y = root[a["set_a"]], root[b["set_a"]]
        root = [y if r == x else r for r in root]
    assert links.num_rows == n - 1 and len(set(root)) == 1
    later = table.set_column(table.column_names.index("band"), "band", pa.array(np.full(n, 2, np.int32)))
    assert minhash._confirmed_in_block(85, 0.07)(later).num_rows == 0


def test_scratch_lets_the_driver_forget(spark):
    whole = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Young" not in b.getName() and "Concurrent" not in b.getName())
    before = whole()
    with common.scratch(spark):
        pass
    assert whole() > before


def test_lines_that_stand_once_and_are_near_none_are_not_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"alone {i * 7919} {i * 104729} {i}\nthe common line of them all\n") for i in range(50)], "doc_id long, text string")
    made = {}
    make = common.materialize

    def noted(df, tag):
        made[tag] = make(df, tag)
        return made[tag]

    monkeypatch.setattr(common, "materialize", noted)
    with common.scratch(spark):
        known, _ = linededup._classes(docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("tag"), "text"), 1, 24, 3, 10)
        assert made["classlines"].count() < 5 and known.count() == 1


def test_a_table_starts_with_a_collection_once_the_heap_fills(spark, monkeypatch):
    tidied = []
    monkeypatch.setattr(common, "tidy", lambda spark: tidied.append(1))
    for part, times in ((1, 0), (0, 1)):
        monkeypatch.setattr(common, "HEAP_PART", part, raising=False)
        with common.scratch(spark):
            common.materialize(spark.range(3), "few")
            assert len(tidied) == times
        tidied.clear()


def test_lines_of_a_large_group_take_few_steps(spark, monkeypatch):
    """Tables written for links of 100 lines that share 116 words, none near another: each is a job or more, whatever the rows. They were 22."""
    made = []
    own = common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, tag: made.append(tag) or own(df, tag))
    lines = spark.createDataFrame([(i, " ".join([f"a{i}", f"b{i}", f"c{i}", f"d{i}", *[f"w{j}" for j in range(116)]])) for i in range(100)], "id long, line string")
    assert linededup.word_links(lines).isEmpty()
    assert len(made) <= 17, made


def test_lines_of_blanks_have_no_word(spark):
    rows = [(1, "\t\x0b \n\x0c\r\n\u00a0\n\u2003x\n\x1c")]
    assert spark.createDataFrame(rows, "id long, text string").select(linededup._worded(F.col("text")).alias("n"), linededup._has_word(F.lit(" \t\n\x0b\x0c\r")).alias("no")).first()[:] == (3, False)


def test_pairs_with_foreign_words_are_not_walked(spark, monkeypatch):
    """Lines that share a segment but have more than k words of their own are told apart without the distance, which isn't compiled."""
    monkeypatch.setattr(linededup, "banded_distance", lambda *args, **kw: "CAST(raise_error(concat('walked ', size(sa))) AS int)")
    lines = spark.createDataFrame([(i, " ".join([*[f"w{j}" for j in range(10)], *[f"x{i}y{j}" for j in range(30)]])) for i in range(20)], "id long, line string")
    assert linededup.word_links(lines).isEmpty()


def test_keys_of_rare_words_make_small_code(spark, monkeypatch):
    """Keys come from a table, not from an expression each (84 at most): the code of the first step was 123,408 characters, then 62,613."""
    code = []
    own = common.materialize

    def noted(df, tag):
        if tag == "raremembers":
            stages = df._jdf.queryExecution().debug().codegenToSeq()
            code.append(sum(len(stages.apply(i)._2()) for i in range(stages.size())))
        return own(df, tag)

    monkeypatch.setattr(common, "materialize", noted)
    lines = spark.createDataFrame([(i, " ".join([f"a{i}", f"b{i}", f"c{i}", f"d{i}", *[f"w{j}" for j in range(116)]])) for i in range(100)], "id long, line string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert linededup.word_links(lines).isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert code and max(code) < 90_000


def test_keys_of_rare_words_against_plain(spark):
    rare = [100 + i for i in range(9)]
    got = linededup._rare_keys(spark.createDataFrame([(1, 1, 45, rare), (2, 2, 31, rare), (3, 3, 15, rare[:2])], "id long, part long, n int, rare array<bigint>"), 3, linededup.Threshold(3, 10).classes()).collect()
    wanted = [(i, k, at) for i, k in ((1, 3), (2, 2), (2, 3), (3, 1)) for at in itertools.combinations(range(k + 3), 3)]
    frame = spark.createDataFrame([(i, k, [rare[j] for j in at if i < 3 or j < 2]) for i, k, at in wanted], "id long, k int, s array<bigint>")
    assert sorted((r.id, r.k, r.key) for r in got) == sorted(tuple(r) for r in frame.select("id", "k", F.xxhash64("k", F.lit(3), "s")).collect())


def test_only_lines_that_stand_twice_or_are_near_others_get_a_first_place(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"alone {i * 7919} {i * 104729} {i}\nthe common line of them all\n") for i in range(50)], "doc_id long, text string")
    sizes = {}
    own = common.materialize

    def noted(df, tag):
        out = own(df, tag)
        if "first" in df.columns or "place" in df.columns:
            sizes[tag] = out.count()
        return out

    monkeypatch.setattr(common, "materialize", noted)
    assert linededup.dedup_lines(docs).agg(F.sum("n_removed")).first()[0] == 49
    assert sizes.pop("lines") == 100 and max(sizes.values()) < 5


def test_lines_that_share_many_rare_words_are_paired_once(spark):
    """Two lines with nine rare words in common share 84 keys of six; one of them gives the pair. Two with seven share seven, two with five none."""
    rare = {1: range(9), 2: range(9), 3: [*range(7), 20, 21], 4: [*range(5), 30, 31, 32, 33]}
    state = spark.createDataFrame([(i, i, 45, [100 + j for j in of]) for i, of in rare.items()], "id long, part long, n int, rare array<bigint>")
    got = linededup._rare_pairs(linededup._rare_keys(state, 6, linededup.Threshold(3, 10).classes()), 6).collect()
    assert sorted((r.a, r.b) for r in got) == [(1, 2), (1, 3), (2, 3)]
