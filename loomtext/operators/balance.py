"""Rows dealt to tasks by the bytes of their texts, so that long articles neither share a task nor delay short ones."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .parse import quoted

#: Classes of sizes to each doubling.
STEPS = 2
#: Tasks for each target's worth of bytes in classes whose rows are large themselves: fewer of them meet.
SPREAD = 4


def size_classes(df: DataFrame, columns: list[str]) -> list[tuple[int, int, int]]:
    """(class, rows, bytes) of rows by the logarithm of their texts' bytes: a histogram of at most 64 * STEPS lines."""
    size = sum((F.coalesce(F.octet_length(quoted(c)), F.lit(0)).cast("long") for c in columns), F.lit(0).cast("long"))
    sized = df.select(size.alias("size")).select(_class(F.col("size")).alias("c"), "size")
    return sorted((r["c"], r["n"], r["b"]) for r in sized.groupBy("c").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect())


def _class(size):
    return F.floor(F.log2(F.greatest(size, F.lit(1))) * STEPS).cast("int")


def plan(classes: list[tuple[int, int, int]], target: int) -> dict[int, tuple[int, int]]:
    """(first task, number of tasks) of each class. Classes whose rows are under a quarter of the target share tasks; a larger one has tasks of its own."""
    small = [(c, n, b) for c, n, b in classes if b < n * target / 4]
    out, at = {}, 0
    if small:
        at = max(1, math.ceil(sum(b for _, _, b in small) / target))
        out = {c: (0, at) for c, _, _ in small}
    for c, n, b in classes:
        if c not in out:
            tasks = min(SPREAD * n, SPREAD * math.ceil(b / target))
            out[c] = (at, tasks)
            at += tasks
    return out


def balanced(df: DataFrame, columns: list[str], target: int = 64 << 20) -> DataFrame:
    """The rows of df, dealt to tasks that have about `target` bytes of the columns' texts each; a row of more has a task with few others of its size.

    Two passes: a histogram of sizes, of which some hundred lines go to the driver, then one shuffle, by `repartitionById`,
    that AQE leaves as it is. Within a class rows are dealt by a hash of their place in the input. Worth its shuffle where
    few rows hold much of the bytes; Arrow batches are cut by bytes by Spark itself
    (spark.sql.execution.arrow.maxBytesPerBatch). Null texts have no bytes. No rows: one empty task.
    """
    tasks = plan(size_classes(df, columns), target)
    if not tasks:
        return df.coalesce(1)
    row, place, size = (f"{n}_{uuid.uuid4().hex}" for n in ("row", "place", "size"))
    total = sum((F.coalesce(F.octet_length(quoted(c)), F.lit(0)).cast("long") for c in columns), F.lit(0).cast("long"))
    held = df.select(F.struct(*[quoted(c) for c in df.columns]).alias(row), total.alias(size), F.monotonically_increasing_id().alias(place))
    of = lambda k: F.coalesce(*[F.when(_class(F.col(size)) == c, F.lit(t[k])) for c, t in tasks.items()])
    dealt = held.repartitionById(max(a + n for a, n in tasks.values()), (of(0) + F.pmod(F.xxhash64(place), of(1))).cast("int"))
    return dealt.select(f"{row}.*")
