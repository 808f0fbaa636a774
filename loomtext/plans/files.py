"""Runs that keep files apart: each file by its own columns, its result under its own name, and a ledger of what was done with it.

The ledger has a row for each time a file was processed: what it was (path, length, time of change), where its result is, how many
rows, and whether it is done or bad. A run lists the inputs and the results that exist and joins both with the ledger: files
that are new, have changed, or whose result is gone are processed, all else is left alone. A bad file, whose footer can't be
read, whose columns don't fit, or of which rows are lost, stops nothing: it is listed by `quarantine` with the reason.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lookup import indexed
from ..operators.metrics import observed, skipped_articles, totals
from ..operators.parse import clean, parse_dual, parse_single
from ..sources import schema as S
from ..sources.footers import footers, group_name, listing
from ..sources.tables import hadoop_path, list_files

LEDGER = "path string, length long, modified timestamp, file string, columns string, output string, n_rows long, state string, error string, at timestamp, run string"
DONE, BAD = "done", "bad"


def file_key(name: Column) -> Column:
    """The partition that holds a file's result: its name, as `_metadata.file_name` has it, in safe characters, and a hash, as different names may become alike."""
    return F.concat(F.regexp_replace(name, "[^A-Za-z0-9._-]", "_"), F.lit("-"), F.lower(F.lpad(F.hex(F.xxhash64(name)), 16, "0")))


def ledger(spark: SparkSession, output_dir: str) -> DataFrame:
    """The latest row of each file."""
    folder = f"{output_dir}/_ledger"
    p, fs = hadoop_path(spark, folder)
    rows = spark.read.schema(LEDGER).parquet(folder) if fs.exists(p) else spark.createDataFrame([], LEDGER)
    names = StructType.fromDDL(LEDGER).names
    return rows.groupBy("path").agg(F.max_by(F.struct(*names), "at").alias("r")).select("r.*")


def quarantine(spark: SparkSession, output_dir: str) -> DataFrame:
    """path, error, at of the files that are bad as they last were."""
    return ledger(spark, output_dir).where(F.col("state") == BAD).select("path", "error", "at")


def results(spark: SparkSession, output_dir: str) -> dict[str, DataFrame]:
    """The results by columns of their inputs: for each group of files alike a DataFrame with `file`, the partition of the file a row is from."""
    done = ledger(spark, output_dir).where((F.col("state") == DONE) & (F.col("n_rows") > 0)).select(F.regexp_extract("output", "(.*)/[^/]*$", 1).alias("folder")).distinct()
    return {f.rsplit("/", 1)[1]: spark.read.option("basePath", f).parquet(f) for f in sorted(r[0] for r in done.collect())}


def pending(spark: SparkSession, input_dir: str, output_dir: str, glob: str, retry_bad: bool = False) -> DataFrame:
    """The files of input_dir to process: path, length, modified, name, file, and the `output` that an earlier state of the file has."""
    files = listing(spark, input_dir, glob).withColumn("file", file_key(F.col("coded")))
    known = ledger(spark, output_dir).select("path", F.col("length").alias("length0"), F.col("modified").alias("modified0"), "output", "n_rows", "state")
    there = listing(spark, f"{output_dir}/parsed", deep=True).select(F.regexp_extract("path", "(.*)/[^/]*$", 1).alias("output")).distinct().withColumn("there", F.lit(True))
    joined = files.join(known, "path", "left").join(there, "output", "left")
    same = (F.col("length") == F.col("length0")) & (F.col("modified") == F.col("modified0"))
    settled = F.when(F.col("state") == BAD, F.lit(not retry_bad)).otherwise((F.col("n_rows") == 0) | F.coalesce("there", F.lit(False)))
    return joined.where(~F.coalesce(same & settled, F.lit(False))).select("path", "length", "modified", "name", "coded", "file", "output")


def skipped_in(spark: SparkSession, output_dir: str) -> DataFrame:
    """file, page_id, title, column of the articles that were skipped, from the results as they are."""
    found = spark.createDataFrame([], "file string, page_id string, title string, column string")
    for df in results(spark, output_dir).values():
        found = found.unionByName(skipped_articles(df, more=("file",)))
    return found


def _transform(df: DataFrame, mode: str, text_column: str | None, skip_lists: bool, timeout: int, steps: int | None) -> DataFrame:
    parsed = parse_dual(df, skip_lists, timeout, ("file",), steps) if mode == "dual" else parse_single(df, text_column, skip_lists, timeout, steps)
    return clean(parsed)


def _group(spark: SparkSession, batch: list, folder: str, transform, seen: list[dict]) -> dict[str, tuple[str, str | None, int]]:
    """Process files with the same columns; (state, error, rows) by their keys. Adds what was observed to `seen`."""
    try:
        df = spark.read.option("ignoreCorruptFiles", "true").parquet(*[r["path"] for r in batch])
        if "file" in (c.lower() for c in df.columns):
            raise ValueError("the column `file` is taken by the name of the result")
        out = transform(df.withColumn("file", file_key(F.col("_metadata.file_name"))))
    except ValueError as e:
        return {r["file"]: (BAD, str(e), 0) for r in batch}
    articles = Observation()
    writer = observed(out, articles).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file")
    page = S.detect_id_column(out.schema)
    (indexed(writer, page) if page else writer).parquet(folder)
    seen.append(articles.get)
    written = spark.read.schema(out.schema).parquet(folder).where(F.col("file").isin([r["file"] for r in batch])).groupBy("file").count()
    got = {r[0]: r[1] for r in written.collect()}
    lost = lambda r: got.get(r["file"], 0) != r["n_rows"]
    return {r["file"]: (BAD, f"{got.get(r['file'], 0)} of {r['n_rows']} rows could be read", 0) if lost(r) else (DONE, None, r["n_rows"]) for r in batch}


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def run_files(spark: SparkSession, input_dir: str, output_dir: str, mode: str = "single", text_column: str | None = None, skip_lists: bool = False, timeout: int = 30, glob: str | None = None, max_files: int = 1000, retry_bad: bool = False, steps: int | None = None) -> dict:
    """Parse and clean the files of input_dir that need it, each by its own columns; returns counts, of files, rows and texts
    that were parsed, null or skipped, and seconds.

    Results are in output_dir/parsed/<columns>/file=<name>, one folder for each input. `max_files` files at a time are processed
    and entered into the ledger, so a run that is stopped goes on from there; what it did without an entry is done again and
    replaces itself. Footers are read by tasks; files with the same columns are one scan.
    """
    if mode not in ("dual", "single"):
        raise ValueError("mode must be dual or single")
    glob = glob or ("20251001_*" if mode == "dual" else "*.parquet")
    listed, began, run = len(list_files(spark, input_dir, glob)), time.time(), uuid.uuid4().hex
    todo = footers(pending(spark, input_dir, output_dir, glob, retry_bad), input_dir).withColumn("columns_key", group_name(F.col("columns")))
    counts, seen = {DONE: 0, BAD: 0, "rows": 0}, []
    rows = sorted(todo.collect(), key=lambda r: r["path"])
    for i in range(0, len(rows), max_files):
        batch, entries = rows[i : i + max_files], []
        groups: dict[str | None, list] = {}
        for r in batch:
            groups.setdefault(r["columns_key"], []).append(r)
        for key, own in sorted(groups.items(), key=lambda g: g[0] or ""):
            folder = f"{output_dir}/parsed/{key}"
            said = {r["file"]: (BAD, r["error"], 0) for r in own} if key is None else _group(spark, own, folder, lambda df: _transform(df, mode, text_column, skip_lists, timeout, steps), seen)
            full = hadoop_path(spark, folder)
            full = full[1].makeQualified(full[0]).toString()
            for r in own:
                state, error, n = said[r["file"]]
                output = f"{full}/file={r['file']}"
                for gone in {r["output"], output if state == BAD else None} - {None, output if state == DONE else None}:
                    _delete(spark, gone)
                entries.append((r["path"], r["length"], r["modified"], r["file"], r["columns"], output if state == DONE else None, n, state, error))
                counts[state] += 1
                counts["rows"] += n
        entry = spark.createDataFrame(entries, LEDGER.partition(", at ")[0]).withColumns({"at": F.current_timestamp(), "run": F.lit(run)})
        entry.coalesce(1).write.mode("append").parquet(f"{output_dir}/_ledger")
    return totals(seen) | {"files_listed": listed, "files_done": counts[DONE], "files_bad": counts[BAD], "rows": counts["rows"], "total_seconds": time.time() - began}
