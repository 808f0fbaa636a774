"""Chat windows, sharding, quality rules and the pipeline."""

import hashlib
import random
import re
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomtext.llm import chat, common, linededup, queries, rules
from loomtext.llm.sharding import Conflict, ShardStore

DATA = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def model_windows(turns, budget, history, cost=None):
    """Windows by a plain loop: lists of (turn, new)."""
    cost = cost or [len(re.findall(r"[^\x20\x09-\x0D]{1,4}", t)) + 4 for _, t in turns]
    first = 1 if turns and turns[0][0] == "system" else 0
    room = budget - (cost[0] if first else 0)
    out, at = [], first
    while at < len(turns) or not out:
        old = at
        if out:
            while old > first and sum(cost[old - 1 : at]) <= history:
                old -= 1
        end = min(at + 1, len(turns))
        while end < len(turns) and sum(cost[old : end + 1]) <= room:
            end += 1
        out.append([(i, not out) for i in range(first)] + [(i, i >= at) for i in range(old, end)])
        at = end
    return out


def test_windows(spark):
    rng = random.Random(1)
    parts = ["<|im_end|>", "<|im_start|>", "<\\|", "<|n|>", "\n", "ab cdefgh", " é日 ", "", "\\", "<", "|", "assistant"]
    convs = {c: [(rng.choice(["system", "user", "assistant", "a\nb<|im_end|>", ""]) if rng.random() < 0.5 else "assistant", "".join(rng.choices(parts, k=rng.randint(0, 12)))) for _ in range(rng.randint(1, 14))] for c in range(60)}
    rows = [(c, i, None if r == "" else r, None if t == "" else t, "extra") for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, m string")
    got = {}
    for r in chat.windows(df, budget=60, history=20).select("*", chat.read_back(F.col("formatted")).alias("turns")).collect():
        got.setdefault(r.conv_id, {})[r.window] = r
    assert got.keys() == convs.keys()
    for c, ts in convs.items():
        want = model_windows(ts, 60, 20)
        assert sorted(got[c]) == list(range(len(want))), (c, ts)
        for k, w in enumerate(want):
            r = got[c][k]
            assert [tuple(t) for t in r.turns] == [ts[i] for i, _ in w]
            assert r.n_repeated == sum(not new for _, new in w)
            unescaped = [re.sub(r"<\\(\\*)\|", r"<\1|", r.formatted[s.start : s.start + s["size"]]) for s in r.loss]
            assert unescaped == [ts[i][1] for i, new in w if new and ts[i][0] == "assistant"]
    for d in chat.digests(chat.windows(df, budget=60, history=20)).collect():
        ts = convs[d.conv_id]
        loss = "".join(t for r, t in ts if r == "assistant")
        assert (d.n_turns, d.turns_sha256) == (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert d.formatted_chars == sum(len(r.formatted) for r in got[d.conv_id].values())
    assert chat.windows(df.where("false")).count() == 0


def test_rows_without_a_conversation_stand_alone(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", "y " * 400), (None, 1, "assistant", "z"), (None, 1, "assistant", "z"), (5, None, "user", None), (5, 1, None, "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = chat.windows(df)
    assert made.where("conv_id is null").count() == 4 == made.where("conv_id is null").select("part").distinct().count()
    got = [(r.conv_id, r.n_turns, r.turns_sha256) for r in chat.digests(common.materialize(made, "w")).collect()]
    sha = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    want = [(None, 1, sha((r, t))) for c, _, r, t in rows if c is None] + [(5, 2, sha(("user", ""), ("", "q")))]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_turn_tokens_of_a_tokenizer(spark):
    from loomtext.llm.wordbpe import word_bpe

    bpe = word_bpe(queries.tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(9)
    convs = {c: [(rng.choice(["system", "user", "assistant"]), " ".join(rng.choices(["the", "extraordinary", "日本語", "x1y2"], k=rng.randint(0, 15)))) for _ in range(rng.randint(1, 12))] for c in range(20)}
    cost = {c: bpe.encode([t for _, t in ts])[1].tolist() for c, ts in convs.items()}
    rows = [(c, i, r, t, cost[c][i]) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n_tokens long")
    got = {(r.conv_id, r.window): [t.text for t in r.turns] for r in chat.windows(df, 60, 20, tokens="n_tokens").select("*", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    want = {(c, k): [ts[i][1] for i, _ in w] for c, ts in convs.items() for k, w in enumerate(model_windows(ts, 60, 20, [n + 4 for n in cost[c]]))}
    assert got == want


def test_shard_store(spark):
    path = common.work_path(spark, "store")
    store = ShardStore(spark, path)
    with pytest.raises(ValueError):
        store.read()
    data = spark.range(4000).select("id", F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"), F.lit(None).cast("string").alias("path"))
    for k in range(6):
        store.append(data.where(F.col("id") % 6 == k).coalesce(2))
    assert store.read().count() == 4000 and len(store.manifest()["shards"]) == 12
    before = store.manifest()["version"]
    store.compact(target=10 << 20, fanout=4, finish=True)
    shards = store.manifest()["shards"]
    assert len(shards) == 1 and store.read().exceptAll(data).isEmpty() and store.read().count() == 4000
    assert store.read(before).count() == 4000 and store.vacuum() == 12 and store.read().count() == 4000
    assert store.vacuum() == 0 and store.versions()[-1] == store.manifest()["version"]
    with pytest.raises(ValueError):
        store.append(data.select("id"))
    base = store.manifest()
    store._commit(base, base["shards"], base["schema"])
    with pytest.raises(Conflict):
        store._commit(base, [], base["schema"])
    other = ShardStore(spark, common.work_path(spark, "store"))
    other.append(data.limit(0))
    assert other.read().count() == 0


def statistics(text):
    w = words(text)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_shard_store_says_what_failed(spark, monkeypatch):
    """A rename that fails without another version in its place is no conflict; conflicts are tried a bounded number of times."""
    store = ShardStore(spark, common.work_path(spark, "store"))
    for k in range(4):
        store.append(spark.range(k, k + 1).withColumn("t", F.lit("x")))

    class Full:
        def rename(self, *_):
            raise OSError("the disk is full")

    class Broken:
        def __getattr__(self, name):
            return Broken() if name != "getFileContext" else lambda *_: Full()

    real, before = store.jvm, store.manifest()
    monkeypatch.setattr(store, "jvm", type("Jvm", (), {"org": Broken(), "__getattr__": lambda _, n: getattr(real, n)})())
    with pytest.raises((OSError, AttributeError, TypeError)):
        store.append(spark.range(1).withColumn("t", F.lit("x")))
    with pytest.raises((OSError, AttributeError, TypeError)):
        store.compact(target=1 << 20, fanout=2)
    monkeypatch.undo()
    assert store.manifest() == before
    tries = []

    def conflict(*_):
        tries.append(1)
        raise Conflict("always")

    monkeypatch.setattr(store, "_commit", conflict)
    with pytest.raises(Conflict):
        store.compact(target=1 << 20, fanout=2)
    assert len(tries) == 20
    monkeypatch.undo()
    store.compact(target=1 << 20, fanout=2)
    assert sorted(r["id"] for r in store.read().collect()) == [0, 1, 2, 3]


def test_statistics(spark):
    rng = random.Random(3)
    parts = ["a", "b", "é", "#*", "|", " ", "\n", "\x0b", "\x1c", " ", "x y z 1 2 3 4 5 6 ", "\n\n", "A.", "日", "\r"]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", "\n", ""]) for _ in range(rng.randint(0, 80))) for _ in range(400)] + [None, "", " ", "w", "same " * 3000, "1 2 3 4 5 6 7 8", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, key string")
    out = rules.with_statistics(df)
    assert out.columns == [*df.columns, "stats"]
    for r in out.collect():
        s = r.stats
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == statistics(texts[r.doc_id] or ""), texts[r.doc_id]


def test_rules_are_learned():
    rng = random.Random(0)
    rows = []
    for _ in range(1500):
        s = {f: rng.random() for f in rules.FEATURES}
        rows.append((s, s["upper_share"] > 0.8 or (s["symbol_share"] > 0.6 and s["stop_share"] < 0.4)))
    found = rules.learn(rows)
    reject = [any(r.holds(s) for r in found) for s, _ in rows]
    right = sum(a == b for a, (_, b) in zip(reject, rows, strict=True))
    assert right > 0.97 * len(rows) and rules.learn([]) == [] and rules.learn(rows[:1]) == []


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    learn, test = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = rules.judge(docs, learn).join(test, "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) > 0.95 * len(got)


def features(text):
    n, chars, symbols, dup, repeat = statistics(text)
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    own = [n, chars / max(n, 1), symbols / max(n, 1)]
    own += [sum(unicodedata.category(c) == "Lu" for c in text) / max(chars, 1), sum(c in "!?" for c in text) / max(n, 1), sum(c in "0123456789" for c in text) / max(chars, 1)]
    own += [text.count(".") / max(n, 1), dup / max(len(lines), 1), repeat / max(n, 1), len(set(w)) / max(n, 1)]
    return dict(zip(rules.FEATURES, own, strict=True)), n < 20 or 100 * repeat > 30 * n


def test_verdicts_are_those_of_a_plain_list(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    found = rules.fit(docs, labels)
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    quality = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    order = sorted(quality, key=lambda i: (i * 2654435761 % 4294967296, i))
    assert found and found == rules.learn([(features(text[i])[0], quality[i] == 0) for i in order if i in text])
    for r in queries.op9_quality_rules(spark, "/root/testdata/sf0.01").collect():
        own, failed = features(text[r.doc_id])
        assert (r.base_failed, r.kept) == (failed, not failed and not any(rule.holds(own) for rule in found))


def test_rules_with_shared_ids_and_clashing_names(spark):
    rows = [(i % 7, " ".join(f"w{i * j}" for j in range(30)), i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").selectExpr("*", "1 as stats", "2 as _w", "3 as `a.b`", "4 as base_failed", "5 as _id")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError):
        rules.judge(docs, labels)
    with pytest.raises(ValueError):
        rules.with_statistics(docs)
    kept = rules.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() > 0 and rules.keep(docs.where("false"), labels).count() == 0


def test_judge_edges(spark):
    docs = spark.createDataFrame([(None, "a b " * 30, 1), (1, None, 2), (1, "word%d " % 1 + " ".join(f"w{i}" for i in range(40)), 3)], "doc_id long, text string, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.quality: (r.base_failed, r.kept) for r in rules.judge(docs, none).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, True)}
    assert rules.judge(docs.where("false"), none).count() == 0


def test_queries_equal_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, DATA)
        cols = ", ".join(sorted(df.columns))
        want = con.execute(f"SELECT {cols} FROM ({sql})").fetchall()
        assert sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect()))) == sorted(map(repr, want)), name


def test_pipeline(spark):
    docs = common.table(spark, DATA, "documents")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert out.select("doc_id").distinct().count() == counts[3]
    full = corpus_pipeline.run(spark, DATA)
    key = ["doc_id", "piece", "ids_crc32", "length"]
    assert full.select(*key).exceptAll(out.select(*key)).isEmpty() and full.count() == out.count()


def test_components_end_once_edges_are_stars(spark, monkeypatch):
    """Edges that are stars take no round, a path of four nodes one or two; the bitmap comes without a job of its own and loses no id."""
    made = []
    own = common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, tag: made.append(tag) or own(df, tag))
    assert dict(common.connected_components(spark.createDataFrame([(1, 2), (3, 1), (5, 9)], "a long, b long")).collect()) == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5}
    assert made == ["cc"]
    assert set(dict(common.connected_components(spark.createDataFrame([(4, 3), (2, 3), (1, 2)], "a long, b long")).collect()).values()) == {1}
    assert len(made) <= 4
    ids = own(spark.range(5000).selectExpr("xxhash64(id) AS h"), "ids")
    kept = spark.range(10000).where(common.flagged(F.xxhash64("id"), ids, "h"))
    assert kept.where("id < 5000").count() == 5000 and kept.count() < 6000


def test_texts_that_lose_no_line_are_not_shuffled(spark):
    """The text column stands below an exchange only where the text may lose a line."""
    rows = [(1, "one line here\nanother one"), (2, "one line here\nmore"), (3, None), (4, "alone")]
    out = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"], r["n_left"]) for r in out.collect()} == {1: (rows[0][1], 2, 0, 2), 2: ("more", 2, 1, 1), 3: (None, 0, 0, 0), 4: ("alone", 1, 0, 1)}
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
