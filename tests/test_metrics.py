"""Counts of runs, the step budget, rows balanced by bytes."""

import resource

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loomtext.functions.udf import extract_udf, skipped
from loomtext.functions.wikitext import OutOfSteps, extract
from loomtext.operators import balance
from loomtext.operators.metrics import article_log, observed, skipped_articles
from loomtext.operators.parse import parse_single, parse_wikitext
from loomtext.plans import pipeline
from loomtext.plans.files import run_files, skipped_in

MANY = "{{a}} " * 500


def frame(spark):
    rows = [("1", "t", "'''a'''"), ("2", None, None), (None, "u", MANY), ("3", "v", ""), ("3", "v", f"x {skipped(30)}")]
    return spark.createDataFrame(rows, "page_id string, title string, text string").repartition(3)


def test_observed(spark):
    seen = Observation()
    parsed = observed(parse_single(frame(spark), steps=100), seen)
    assert parsed.count() == 5
    assert seen.get == {"rows": 5, "text_parsed.parsed": 3, "text_parsed.null": 1, "text_parsed.skipped": 1, "text_parsed.chars": 1 + 2 * len(skipped(30)) + 2}
    log = {tuple(r) for r in article_log(parsed).collect()}
    assert ("unknown", "u", "text_parsed", "skipped", len(skipped(30))) in log and ("2", "untitled", "text_parsed", "null", None) in log and ("1", "t", "text_parsed", "parsed", 1) in log
    assert [tuple(r) for r in skipped_articles(parsed).collect()] == [("unknown", "u", "text_parsed")]
    bare = article_log(spark.createDataFrame([("a",), ("b",)], "x_parsed string"))
    ids = [r["page_id"] for r in bare.collect()]
    assert len(set(ids)) == 2 and all(i.startswith("row_") for i in ids) and {r["title"] for r in bare.collect()} == {"untitled"}
    with pytest.raises(ValueError):
        article_log(spark.createDataFrame([("a",)], "x string"))
    empty = Observation()
    observed(parse_single(frame(spark).where("false")), empty).collect()
    assert set(empty.get.values()) == {0}


def test_runs_count(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        pq.write_table(pa.table({"page_id": [str(i), "x"], "title": ["t", None], "text": ["'''a'''" if i else None, MANY]}), source / f"{i}.parquet")
    want = {"parsed": 2, "null": 1, "skipped": 3, "rows": 6}
    got = pipeline.run(spark, str(source), str(tmp_path / "stream"), mode="single", steps=100)
    assert {k: got[k] for k in want} == want
    assert {k: pipeline.run(spark, str(source), str(tmp_path / "stream"), mode="single", steps=100)[k] for k in want} == dict.fromkeys(want, 0)
    got = run_files(spark, str(source), str(tmp_path / "files"), steps=100, max_files=2)
    assert {k: got[k] for k in want} == want
    assert sorted(tuple(r)[1:] for r in skipped_in(spark, str(tmp_path / "files")).collect()) == [("x", "untitled", "text_parsed")] * 3


@pytest.mark.parametrize("text", [MANY, "[[a|" * 400, "* a\n" * 400, "{{" * 400 + "}}" * 400, "<ref>x</ref>" * 200, " pre\n" * 300 + "\n== h ==\n" * 20])
def test_budget_ends_at_the_same_step(text):
    def enough(steps):
        try:
            return extract(text, steps=steps) == extract(text)
        except OutOfSteps:
            return False

    low, high = 0, 5000
    assert enough(high) and not enough(low)
    while high - low > 1:
        low, high = (low, m) if enough(m := (low + high) // 2) else (m, high)
    assert all(not enough(s) for s in range(max(0, high - 20), high)) and all(enough(s) for s in range(high, high + 20))


def test_budget_column(spark):
    df = spark.createDataFrame([("a", "'''x'''"), ("b", MANY), ("c", None), ("d", "plain\n" * 1000)], "k string, t string")
    got = [{r[0]: r[1] for r in df.select("k", extract_udf(timeout=7, steps=s)("t")).collect()} for s in (100, 100, 2000)]
    assert got[0] == got[1] == {"a": "x", "b": skipped(7), "c": None, "d": ("plain\n" * 1000).strip()} and got[2]["b"] == ""
    assert parse_wikitext(df, {"t": "p"}, timeout=0, steps=100).where("k = 'b'").first()["p"] == skipped(0)
    with pytest.raises(ValueError):
        extract_udf(steps=-1)


def test_balanced(spark):
    target = 1 << 18
    sizes = [10] * 4000 + [3000] * 200 + [1 << 20, 3 << 20, None, 0, 1 << 17]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id int, n int").coalesce(1).select("id", F.expr("IF(n IS NULL, NULL, repeat('x', n))").alias("text"))
    out = balance.balanced(df, ["text"], target)
    assert out.columns == df.columns and sorted(r[0] for r in out.select("id").collect()) == list(range(len(sizes)))
    rows = out.select(F.spark_partition_id().alias("p"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("b")).collect()
    by = {}
    for p, b in rows:
        by.setdefault(p, []).append(b)
    assert all(sum(b) <= 3 * target for b in by.values() if max(b) < target)
    assert all(len(b) <= 2 for b in by.values() if max(b) >= target)
    assert balance.balanced(df.where("false"), ["text"]).count() == 0


def test_memory_beside_a_long_article(spark):
    """A 30 MB article beside 3,000 short ones: a worker holds one batch at a time, cut by bytes."""

    def peak(parts):
        for part in parts:
            yield pd.DataFrame({"peak": [resource.getrusage(resource.RUSAGE_SELF).ru_maxrss], "n": [len(part)]})

    df = spark.range(3001, numPartitions=1).select(F.when(F.col("id") == 1500, F.repeat(F.lit("слово и [[b|c]] "), 1_300_000)).otherwise(F.repeat(F.lit("x y "), 2500)).alias("text"))
    base = spark.range(1).selectExpr("'x' AS text").mapInPandas(peak, "peak long, n long").first()["peak"]
    got = balance.balanced(df, ["text"], 8 << 20).mapInPandas(peak, "peak long, n long").collect()
    assert sum(r["n"] for r in got) == 3001 and max(r["peak"] for r in got) - base < 400_000
