"""Shared plumbing: the shared folder, shipping this package, tables cut from their lineage, connected components."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, a temporary one in local mode (tests), else an error: a cluster's machines don't share theirs."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{os.path.join(tempfile.gettempdir(), 'loomtext-' + spark.sparkContext.applicationId)}"
    return base.rstrip("/")


def work_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/loomtext/{tag}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp()) / "loomtext_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "loomtext").rglob("*.py")):
            z.write(p, p.relative_to(root).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


_MADE: list[str] = []

#: Share of the driver's heap from which the next table starts with a collection, before the heap grows for what nothing holds any more.
HEAP_PART = 0.3

#: Tables of hashes, written as they are: a dictionary of what hardly repeats only takes time.
PLAIN = {"lines", "linesegments", "lineparts"}


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: its lineage ends there, so lost executors cost no recomputation."""
    spark = df.sparkSession
    heap = spark._jvm.Runtime.getRuntime()
    if heap.totalMemory() - heap.freeMemory() > HEAP_PART * heap.maxMemory():
        tidy(spark)
    path = work_path(spark, tag)
    _MADE.append(path)
    df.write.option("parquet.enable.dictionary", tag not in PLAIN).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.loomtext_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table that `materialize` made."""
    path = df.loomtext_path
    p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
    _MADE.remove(path)


def tidy(spark: SparkSession) -> None:
    """Let the driver collect its garbage. Spark removes shuffle files and the broadcast copies of bitmaps and task code only
    once the driver has; a driver of many small steps otherwise grows its heap as far as it may first."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession):
    """Deletes the tables made inside when left, but for those put into the yielded list: what a returned plan still reads. What their making left in memory and in shuffle files goes too."""
    first, keep = len(_MADE), []
    try:
        yield keep
    finally:
        kept = {df.loomtext_path for df in keep}
        for path in _MADE[first:]:
            if path not in kept:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _MADE[first:] = [p for p in _MADE[first:] if p in kept]
        tidy(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch, column: int, most_bytes: int = 1 << 20):
    """Cut an Arrow batch into runs of rows of about most_bytes of text in the column, so that a worker's memory stays bounded."""
    import numpy as np

    n = batch.num_rows
    if n == 0:
        return
    if batch.column(column).nbytes <= most_bytes:
        yield batch
        return
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


#: Places of a bitmap for each id, and the least and most of all. Seven to a byte, so 10 MB at most go to all tasks.
FILTER_EACH, FILTER_LEAST, FILTER_MOST = 16, 1 << 16, 1 << 26


def flagged(on: Column, ids: DataFrame, column: str, n: int | None = None) -> Column:
    """Whether `on` (a long hash) may be among the hashes in the column of ids, which has n rows: true for all that are, and for a few others.

    A bitmap of the low bits of the hashes, sized by their number, goes to all tasks; past 4 * FILTER_MOST places it would
    hold nearly every one, so then it is true throughout. Callers join with ids afterwards: this only spares them rows.
    It is a binary value: element access to an array from a subquery costs microseconds a row. It comes as a local relation,
    which takes no job; seven places to a byte keep all bytes ASCII, as those are what SQL can turn into a number.
    """
    import numpy as np
    import pyarrow as pa

    places, wanted = FILTER_LEAST, (ids.count() if n is None else n) * FILTER_EACH
    while places < wanted and places < FILTER_MOST:
        places *= 2
    if wanted > 4 * FILTER_MOST:
        return F.lit(True)
    at = F.col(column).bitwiseAND(F.lit(places - 1))
    got = ids.select(at.alias("at")).groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS int))")).alias("bits")).toArrow()
    words = np.zeros(places // 64 + 7, "<u8")
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    held = ids.sparkSession.createDataFrame(pa.table({"bits": pa.array([_sevens(words.view(np.uint8))], pa.binary())})).scalar()
    mine = on.bitwiseAND(F.lit(places - 1))
    byte = F.call_function("div", mine, F.lit(7))
    held = F.ascii(F.substring(held, byte.cast("int") + 1, F.lit(1)).cast("string"))
    return F.call_function("shiftright", held, (mine - byte * 7).cast("int")).bitwiseAND(F.lit(1)) == 1


def _sevens(raw) -> bytes:
    """The bits of an array of bytes, lowest first, seven to a byte; what is left after groups of seven bytes is cut off. By blocks, as bits take a byte each meanwhile."""
    import numpy as np

    step, weights = 7 << 13, np.left_shift(1, np.arange(7)).astype(np.uint8)
    raw = raw[: len(raw) // 7 * 7]
    return b"".join((np.unpackbits(raw[i : i + step], bitorder="little").reshape(-1, 7) * weights).sum(axis=1, dtype=np.uint8).tobytes() for i in range(0, len(raw), step))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of the undirected edges; component is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each is a grouped minimum, combined before the
    shuffle, joined back to the edges, so a node with very many edges is never gathered into one task. Each round is
    written to the shared folder. The number of rounds grows with the logarithm of the longest path; they end once the edges
    are stars, as a further round would leave these as they are. Nulls and self-loops are dropped.
    """
    with scratch(edges.sparkSession) as keep:
        e = _stars(edges, a, b)
        keep.append(e)
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    out.loomtext_path = e.loomtext_path
    return out


def _stars(edges: DataFrame, a: str, b: str) -> DataFrame:
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(e, "cc")
    while not _are_stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        last, e = e, materialize(small, "cc")
        drop(last)
    return e


def _are_stars(e: DataFrame) -> bool:
    """Whether each node of the distinct edges u > v has one edge down and none up, or none down: v is then the least node of its component."""
    down = e.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = down.union(e.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 or down = 1 and up = 1").agg(F.count("*")).first()[0] == 0
