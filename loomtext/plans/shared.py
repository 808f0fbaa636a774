"""What registered queries share: the given tables, and a folder that all executors see."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder in local mode where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file:{tempfile.mkdtemp(prefix='loomtext-')}"
