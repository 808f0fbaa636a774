"""Every stage of the pipeline against a plain version of it, on whole tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomtext.llm import common, rules
from test_dedup import edit, roots, shingles
from test_native import features
from test_tokens import best_fit_decreasing, crc, word_ids

DATA = "/root/testdata/sf0.001"


def near_lines(lines):
    """Links by edit distance over characters and words, for pairs of alike size that share enough words."""
    words = [x.split(" ") for x in lines]
    bags = [Counter(w) for w in words]
    for j in range(len(lines)):
        for i in range(j):
            if abs(len(words[i]) - len(words[j])) > 3:
                continue
            w = min(3, min(len(words[i]), len(words[j])) // 10)
            k = min(1, min(len(lines[i]), len(lines[j])) // 24)
            differ = max(sum((bags[i] - bags[j]).values()), sum((bags[j] - bags[i]).values()))
            if differ <= w and edit(words[i], words[j]) <= w or differ <= 2 and abs(len(lines[i]) - len(lines[j])) <= k and edit(lines[i], lines[j]) <= k:
                yield i, j


def plain_lines(rows, tags):
    """{row: text without lines that stand elsewhere before}, rows as (doc_id, text)."""
    distinct = sorted({x for _, t in rows for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")})
    of = roots(range(len(distinct)), near_lines(distinct))
    number, first = {x: of[i] for i, x in enumerate(distinct)}, {}
    places = [(i, pos, x) for i, (d, t) in enumerate(rows) for pos, x in enumerate((t or "").split("\n")) if x in number]
    rank = lambda i, pos: (rows[i][0] is not None, rows[i][0] or 0, tags[rows[i][1]], pos)
    for i, pos, x in places:
        first[number[x]] = min(rank(i, pos), first.get(number[x], rank(i, pos)))
    out = {}
    for i, (_, t) in enumerate(rows):
        if t is None:
            out[i] = None
            continue
        left = [x for pos, x in enumerate(t.split("\n")) if x not in number or first[number[x]] == rank(i, pos)]
        if len(left) == len(t.split("\n")) or any(x in number for x in left):
            out[i] = "\n".join(left)
    return out


def plain_near(rows, percent):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for j in range(len(rows)) for i in range(j) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    of, least = roots(range(len(rows)), links), {}
    for k, (d, _) in enumerate(rows):
        if d is not None and sets[k]:
            least[of[k]] = min(d, least.get(of[k], d))
    return [r for k, r in enumerate(rows) if r[0] is None or not sets[k] or least[of[k]] == r[0]]


def test_stages_against_plain_versions(spark):
    docs = common.table(spark, DATA, "documents")
    extra = [(None, "a document without an id that has words enough to be kept by the rules of the first stage, and then some more of them here"), (3, None), (5, "")]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string").select(*[F.col(c) if c in ("doc_id", "text") else F.lit(None).cast(t).alias(c) for c, t in docs.dtypes]))
    found = rules.fit(docs, common.table(spark, DATA, "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def run(name, docs):
        out = common.materialize(dict(corpus_pipeline.STAGES)[name](spark, docs, DATA), name)
        return out, sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    docs, got = run("quality_rules", docs)
    judged = [(r, *features(r[1] or "")) for r in rows]
    rows = sorted((r for r, own, failed in judged if not failed and not any(rule.holds(own) for rule in found)), key=str)
    assert got == rows

    tags = dict(docs.select("text", F.xxhash64("text")).collect())
    docs, got = run("line_dedup", docs)
    left = plain_lines(rows, tags)
    rows = sorted(((rows[i][0], t) for i, t in left.items()), key=str)
    assert got == rows and docs.where("n_chars <> length(text)").isEmpty()

    docs, got = run("near_dedup", docs)
    rows = sorted(plain_near(rows, 80), key=str)
    assert got == rows

    lengths, want, place = [], [], {}
    for d, t in rows:
        ids = [*word_ids(t), 0]
        for p in range(0, len(ids), 2048):
            part = ids[p : p + 2048]
            lengths.append(len(part))
            want.append((d, p // 2048, p, len(part), crc(part)))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces), key=str) == sorted(want, key=str)
    for r in pieces:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in place.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 2048
    assert len(place) <= best_fit_decreasing(lengths, 2048) * 1.02 + 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_no_rows_and_any_names(spark, name):
    """No rows give no rows; extra columns, whatever their names, stay in all stages but the last."""
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, kept int, stats int, tag int, rep int, `a.b` int, component_id int, lost int")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, DATA)
    assert out.count() == 0 and (out.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0])
