"""Parquet files of a folder one by one: listing, footers read in parallel, and files grouped by what their footers say."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import hadoop_path
from .textfiles import opened, resolved

FOOTERS = "path string, n_rows long, columns string, error string"


def listing(spark: SparkSession, folder: str, glob: str = "*.parquet", deep: bool = False) -> DataFrame:
    """path, length, modified, name, coded (the name as `_metadata.file_name` has it) of the files of a folder, as a distributed listing without their content; none if there is no such folder.

    Names that begin with `_` or `.`, and files of no bytes, are no data, as everywhere in Spark.
    """
    p, fs = hadoop_path(spark, folder)
    if not fs.exists(p):
        return spark.createDataFrame([], "path string, length long, modified timestamp, name string, coded string")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = (reader.option("recursiveFileLookup", "true") if deep else reader).load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("_metadata.file_name").alias("coded"))


def _read(root: str):
    def run(parts: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.parquet as pq

        fs, base = opened(root)
        for part in parts:
            rows = []
            for path, name in zip(part["path"], part["name"], strict=True):
                try:
                    with fs.open_input_file(f"{base}/{name}") as f:
                        footer = pq.ParquetFile(f)
                        columns = "\n".join(f"{c.name}\t{c.type}" for c in footer.schema_arrow)
                        rows.append((path, footer.metadata.num_rows, columns, None))
                except Exception as e:
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "n_rows", "columns", "error"])

    return run


def footers(files: DataFrame, folder: str) -> DataFrame:
    """files of one folder, as `listing` gives them, with n_rows and columns (a line of name, tab, type for each) from their footers, or error where there is none to read."""
    spark = files.sparkSession
    read = files.repartition(spark.sparkContext.defaultParallelism, "path").select("path", "name").mapInPandas(_read(resolved(spark, folder, make=False)), FOOTERS)
    return files.join(read, "path")


def group_name(columns: Column) -> Column:
    """A short name for all files with the same columns."""
    return F.substring(F.sha2(columns, 256), 1, 12)
