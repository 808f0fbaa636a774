"""Registered queries over runs that keep files apart, with equivalent SQL. Inputs are written from the tables, as a user's files would be."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import hadoop_path, list_files
from .files import quarantine, results, run_files
from .shared import read, shared_folder


def _put(df: DataFrame, folder: str) -> None:
    df.write.mode("append").parquet(folder)


def _texts(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Files of two kinds in one folder: parts have a `text`, customers a `content`."""
    _put(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr("'''''''' || p_name || ''''''' [[x|' || p_type || ']]'").alias("text")).repartition(2, "id"), folder)
    _put(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr("c_name || ' [[File:a.jpg|b]]' || c_mktsegment").alias("content"), F.col("c_acctbal").alias("more")).repartition(2, "id"), folder)


def _gathered(spark: SparkSession, out: str) -> DataFrame:
    """id, kind, text of all results, whatever their columns."""
    rows = [df.select("id", F.lit(c).alias("kind"), F.col(f"{c}_parsed").alias("text")) for df in results(spark, out).values() for c in ("text", "content") if f"{c}_parsed" in df.columns]
    whole = rows[0]
    for r in rows[1:]:
        whole = whole.unionByName(r)
    return whole


def files_by_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    _texts(spark, sf_dir, f"{base}/in")
    run_files(spark, f"{base}/in", f"{base}/out")
    return _gathered(spark, f"{base}/out")


def files_redone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run after one result was deleted, one input replaced and one added: it does these three alone, and the results are those of all files as they are."""
    base = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    _texts(spark, sf_dir, f"{base}/in")
    run_files(spark, f"{base}/in", f"{base}/out")
    listed = list_files(spark, f"{base}/in", "*.parquet")
    gone = next(df for df in results(spark, f"{base}/out").values() if "content_parsed" in df.columns).inputFiles()[0].rsplit("/", 1)[0]
    kinds = {f: spark.read.parquet(f) for f in listed}
    replaced = next(f for f, df in kinds.items() if "text" in df.columns)
    for path in (gone, replaced):
        p, fs = hadoop_path(spark, path)
        fs.delete(p, True)
    new = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("content")).repartition(2, F.lit(0))
    _put(new.coalesce(1), f"{base}/new")
    p, fs = hadoop_path(spark, replaced)
    fs.rename(hadoop_path(spark, list_files(spark, f"{base}/new", "*.parquet")[0])[0], p)  # an input of other columns under the same name
    _put(read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("text")).coalesce(1), f"{base}/in")
    again = run_files(spark, f"{base}/in", f"{base}/out")
    left = sum(df.count() for f, df in kinds.items() if "text" in df.columns and f != replaced)
    rows = _gathered(spark, f"{base}/out")
    parts = rows.where("kind = 'text' and text like '% %'").count()
    return rows.where("kind = 'content' or text not like '% %'").select("id", "kind", "text", F.lit(again["files_done"]).alias("redone"), F.lit(left == parts).alias("others_stay"))


def files_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which one is torn: the others are parsed, that one is listed."""
    base = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    _texts(spark, sf_dir, f"{base}/in")
    p, fs = hadoop_path(spark, f"{base}/in/torn.parquet")
    torn = fs.create(p)
    torn.write(bytearray(b"PAR1 and nothing that follows"))
    torn.close()
    run_files(spark, f"{base}/in", f"{base}/out")
    bad = [r["path"].rsplit("/", 1)[1] for r in quarantine(spark, f"{base}/out").collect()]
    return _gathered(spark, f"{base}/out").withColumn("bad", F.lit(",".join(bad)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (files_by_columns, files_redone, files_quarantined)}


def oracle_sql() -> dict[str, str]:
    part, customer = "SELECT p_partkey AS id, 'text' AS kind, p_name || ' ' || p_type AS text FROM part", "SELECT c_custkey AS id, 'content' AS kind, c_name || ' ' || c_mktsegment AS text FROM customer"
    both = f"{part} UNION ALL {customer}"
    other = f"{customer} UNION ALL SELECT s_suppkey, 'content', s_name FROM supplier UNION ALL SELECT n_nationkey, 'text', n_name FROM nation WHERE n_name NOT LIKE '% %'"
    return {
        "files_by_columns": both,
        "files_redone": f"SELECT *, 3 AS redone, true AS others_stay FROM ({other})",
        "files_quarantined": f"SELECT *, 'torn.parquet' AS bad FROM ({both})",
    }
