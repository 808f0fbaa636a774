"""Whole runs over folders: parse and clean in one pass, with the intermediate kept on request."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from ..operators.export import export_text
from ..operators.lookup import indexed
from ..operators.metrics import observed, totals
from ..operators.parse import clean, parse_dual, parse_single
from ..sources.tables import list_files, read_parquet
from ..streaming.incremental import run_incremental

DUAL_GLOB = "20251001_*"


def parse_then_clean(df: DataFrame, mode: str = "dual", text_column: str | None = None, skip_lists: bool = False, timeout: int = 30) -> DataFrame:
    """Both phases as one plan: scan, one Python stage, projections."""
    parsed = parse_dual(df, skip_lists, timeout) if mode == "dual" else parse_single(df, text_column, skip_lists, timeout)
    return clean(parsed)


def parse_file(spark: SparkSession, input_path: str = "data/sample_wikitext.parquet", output_path: str = "data/output.parquet", skip_lists: bool = False, timeout: int = 30, skip_empty: bool = False, steps: int | None = None) -> int:
    """Phase one over one file or folder of the dual table, with Bloom filters for page_id; returns the rows written."""
    df = read_parquet(spark, input_path)
    if skip_empty and df.isEmpty():
        return 0
    indexed(parse_dual(df, skip_lists, timeout, steps=steps).write.mode("overwrite"), "page_id").parquet(output_path)
    return spark.read.parquet(output_path).count()


def clean_file(spark: SparkSession, input_path: str, output_path: str, skip_empty: bool = False) -> int:
    """Phase two over one file or folder; returns the rows written, 0 without a column to clean."""
    df = read_parquet(spark, input_path)
    out = clean(df)
    if out is None or skip_empty and df.isEmpty():
        return 0
    out.write.mode("overwrite").parquet(output_path)
    return spark.read.parquet(output_path).count()


def run(spark: SparkSession, input_dir: str, output_dir: str, mode: str = "dual", timeout: int = 30, keep_dirty: bool = False, text_column: str | None = None, skip_lists: bool = False, glob: str | None = None, steps: int | None = None) -> dict:
    """Process the files of input_dir that no earlier run did; a second run with nothing new writes nothing.

    Results are in output_dir/parsed, with keep_dirty what phase one gave in output_dir/dirty, which phase two then
    reads. Failures end the run. Returns counts, of files, rows and texts that were parsed, null or skipped, and seconds.
    """
    if mode not in ("dual", "single"):
        raise ValueError("mode must be dual or single")
    glob = glob or (DUAL_GLOB if mode == "dual" else "*.parquet")
    files = len(list_files(spark, input_dir, glob))
    began = time.time()
    dual, single = (lambda df: parse_dual(df, skip_lists, timeout, steps=steps)), (lambda df: parse_single(df, text_column, skip_lists, timeout, steps))
    parse = lambda df: observed(dual(df) if mode == "dual" else single(df), "articles")
    state, out = f"{output_dir}/_state", f"{output_dir}/parsed"
    if keep_dirty:
        one = run_incremental(spark, input_dir, f"{output_dir}/dirty", f"{state}/parse", parse, glob)
        two = run_incremental(spark, f"{output_dir}/dirty", out, f"{state}/clean", clean, "*.parquet")
        phases = {"parse_seconds": one["seconds"], "clean_seconds": two["seconds"]}
        rows = one["rows"]
    else:
        one = run_incremental(spark, input_dir, out, f"{state}/both", lambda df: clean(parse(df)), glob)
        phases, rows = {"seconds": one["seconds"]}, one["rows"]
    return phases | totals([one["observed"]]) | {"files_listed": files, "rows": rows, "total_seconds": time.time() - began, "output": out}


def count_outputs(spark: SparkSession, folder: str) -> int:
    """Parquet files in an output folder."""
    return len(list_files(spark, folder, "*.parquet"))


def run_export(spark: SparkSession, input_dir: str, official_dir: str = "data/parsed_export", clone_dir: str | None = None, glob: str = "*.parquet") -> int:
    """Export all articles of a folder of dual results as text files."""
    return export_text(read_parquet(spark, input_dir, glob), official_dir, clone_dir)
