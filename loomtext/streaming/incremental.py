"""Processing only new files: a file stream run until nothing is left, with a checkpoint that remembers what was read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .progress import listening


def run_incremental(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], glob: str = "*", schema: StructType | None = None, max_files: int | None = None) -> dict:
    """Transform the files of input_dir not seen before and append them to output_dir; returns rows, batches, seconds and
    `observed`: the sums of what the transformed rows were observed for, over all batches.

    Exactly once: the checkpoint lists read files and the Parquet sink's log lists written ones, so a run that is stopped
    goes on where it was. `transform` must be row by row; it may observe its rows (`operators.metrics.observed`).
    """
    schema = schema or spark.read.option("pathGlobFilter", glob).parquet(input_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    log = listening(spark)
    try:
        query = transform(reader.parquet(input_dir)).writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        sums = log.wait(str(query.runId))
    finally:
        spark.streams.removeListener(log)
    seen = {k.removeprefix("observed."): v for k, v in sums.items() if k.startswith("observed.")}
    return {"rows": sums["rows"], "batches": sums["batches"], "seconds": sums["milliseconds"] / 1000, "observed": seen}


def pending_files(done: DataFrame, listed: DataFrame, key: str = "name") -> DataFrame:
    """The batch form of the same: names listed and not yet done."""
    return listed.join(done.select(key).distinct(), key, "left_anti")
