"""Reading Parquet datasets: a file, or a folder of files chosen by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> list[str]:
    """Paths of a folder's own files that match, sorted; no such folder, or nothing in it, is an error."""
    p, fs = hadoop_path(spark, folder)
    if not fs.exists(p):
        raise FileNotFoundError(f"Directory not found: {folder}")
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(p, glob))
    names = sorted(s.getPath().toString() for s in (found or []))
    if not names:
        raise FileNotFoundError(f"No files matching {glob} in {folder}")
    return names


def read_parquet(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """A Parquet file or folder; columns and filters are pruned into the scan by Spark. A path that is missing is an error."""
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"Input not found: {path}") from e
        raise
