"""Registered queries over what runs report and how rows are dealt, ordered and found, with equivalent SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.udf import skipped
from ..operators.balance import balanced
from ..operators.export import export_rows
from ..operators.lookup import indexed, lookup_article, rows_read
from ..operators.metrics import article_log, observed, skipped_articles
from ..operators.parse import parse_single, parse_wikitext
from .shared import read, shared_folder

#: Steps a text may take, and bytes of a task, small enough for the given tables to pass them.
STEPS, BYTES = 50, 1 << 17


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as articles: some without a text or an id, some with more templates than STEPS allow."""
    text = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE repeat('{{a}}', CAST(c_custkey % 40 AS int)) || '''''''' || c_name || '''''''' END"
    return read(spark, sf_dir, "customer").select(F.expr("CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS string) END").alias("page_id"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END").alias("title"), F.expr(text).alias("text"))


def step_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_wikitext(_articles(spark, sf_dir), {"text": "parsed"}, steps=STEPS).select("page_id", "title", "parsed")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one job over all articles counted while it ran."""
    seen = Observation()
    observed(parse_single(_articles(spark, sf_dir), steps=STEPS), seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], *(seen.get[f"text_parsed.{k}"] for k in ("parsed", "null", "skipped", "chars")))], "n_rows long, n_parsed long, n_null long, n_skipped long, n_chars long")


def log_of_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article_log(parse_single(_articles(spark, sf_dir), steps=STEPS))


def log_of_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skipped_articles(parse_single(_articles(spark, sf_dir), steps=STEPS))


def lookup_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of a table whose row groups hold no ranges of ids: Bloom filters leave few rows to read."""
    path = f"{shared_folder(spark)}/lookup-{uuid.uuid4().hex}"
    indexed(read(spark, sf_dir, "documents").repartition(16, F.xxhash64("doc_id")).write, "doc_id").parquet(path)
    table = spark.read.parquet(path)
    few = 4 * rows_read(table.where("doc_id = 11").select("doc_id")) < table.count()
    return lookup_article(table, 11, "doc_id", ("text", "lang")).withColumn("skipped_most", F.lit(few))


def balanced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bytes, and whether the task that has it got three times the bytes aimed at, at most, or has such documents alone."""
    rows = balanced(read(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], BYTES).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.spark_partition_id().alias("task"))
    task = Window.partitionBy("task")
    even = (F.sum("n_bytes").over(task) <= 3 * BYTES) | (4 * F.min("n_bytes").over(task) >= BYTES // 2)
    return rows.select("doc_id", "n_bytes", even.alias("even"))


def export_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that stand in several files, of which the later ones are larger: the first with a text wins, by file, then row."""
    base = f"{shared_folder(spark)}/order-{uuid.uuid4().hex}"
    part = read(spark, sf_dir, "part")
    for k, texts in enumerate(("CASE WHEN p_partkey % 2 = 0 THEN p_name END", "p_type", "repeat(p_name, 20)")):
        rows = part.where(F.col("p_partkey") % (3 - k) == 0).select(F.col("p_partkey").cast("string").alias("page_id"), F.lit(f"file {k}").alias("page_title"), F.expr(texts).alias("official_text_paragraphs"), F.lit(f"clone {k}").alias("clone_text_paragraphs"))
        rows.coalesce(1).write.parquet(f"{base}/part={k}")
    return export_rows(spark.read.parquet(base)).select("name", "content")


def export_any_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of single texts as files: page and title are detected."""
    rows = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), F.expr("CASE WHEN p_size > 9 THEN p_name END").alias("title"), F.expr("CASE WHEN p_partkey % 4 > 0 THEN '[[x|' || p_type || ']]' END").alias("content"))
    return export_rows(parse_single(rows), {"parsed": "content_parsed"}).select("name", "content")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (step_budget, run_metrics, log_of_articles, log_of_skipped, lookup_indexed, balanced_documents, export_in_order, export_any_columns)}


def oracle_sql() -> dict[str, str]:
    late = skipped(30)
    parsed = f"CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN 2 * (c_custkey % 40) + 1 > {STEPS} THEN '{late}' ELSE c_name END"
    articles = f"SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS page_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS title, {parsed} AS parsed FROM customer"
    log = f"SELECT coalesce(page_id, 'unknown') AS page_id, coalesce(title, 'untitled') AS title, 'text_parsed' AS \"column\", CASE WHEN parsed IS NULL THEN 'null' WHEN parsed = '{late}' THEN 'skipped' ELSE 'parsed' END AS state, length(parsed) AS chars FROM ({articles})"
    shown = lambda t: f"length(coalesce({t}, 'None')) AS {t}_length, substr(coalesce({t}, 'None'), 1, 5000) AS {t}_preview, length(coalesce({t}, 'None')) > 5000 AS {t}_truncated"
    rows = "SELECT p_partkey AS k, 0 AS f, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS text FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 1, p_type FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 2, repeat(p_name, 20) FROM part"
    page = "k || '_{0}.txt' AS name, 'Page ID: ' || k || chr(10) || 'Title: file ' || f || chr(10) || repeat('=', 60) || chr(10) || chr(10) || {1} AS content"
    return {
        "step_budget": articles,
        "run_metrics": f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE state = 'parsed') AS n_parsed, count(*) FILTER (WHERE state = 'null') AS n_null, count(*) FILTER (WHERE state = 'skipped') AS n_skipped, sum(chars)::BIGINT AS n_chars FROM ({log})",
        "log_of_articles": log,
        "log_of_skipped": f"SELECT page_id, title, \"column\" FROM ({log}) WHERE state = 'skipped'",
        "lookup_indexed": f"SELECT doc_id, {shown('text')}, {shown('lang')}, true AS skipped_most FROM documents WHERE doc_id = 11 LIMIT 1",
        "balanced_documents": "SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes, true AS even FROM documents",
        "export_any_columns": "SELECT p_partkey || '_parsed.txt' AS name, 'Page ID: ' || p_partkey || chr(10) || 'Title: ' || CASE WHEN p_size > 9 THEN p_name ELSE 'untitled' END || chr(10) || repeat('=', 60) || chr(10) || chr(10) || p_type AS content FROM part WHERE p_partkey % 4 > 0",
        "export_in_order": f"SELECT {page.format('official', 'text')} FROM (SELECT k, min(f) AS f, arg_min(text, f) AS text FROM ({rows}) WHERE text IS NOT NULL GROUP BY k) UNION ALL SELECT {page.format('clone', chr(39) + 'clone ' + chr(39) + ' || f')} FROM (SELECT k, min(f) AS f FROM ({rows}) GROUP BY k)",
    }
