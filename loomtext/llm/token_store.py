"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on doc_id, in ascending doc_id order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def _encoder(tokenizer: str, end_id: int | None):
    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from loomtext.llm.chunks import ragged
        from loomtext.llm.wordbpe import word_bpe

        bpe, part, done = word_bpe(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in common.slices(whole, 1, 4 << 20):
                flat, counts = ragged(*bpe.encode(b.column(1)), None, end_id)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0),
                        pa.array(np.full(len(counts), part, np.int32)),
                        pa.array(done + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat)),
                    ],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                done += int(counts.sum())

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, stripe_mb: int = 16, compression: str = "zstd") -> None:
    """Encode doc_id, text and write ids to ORC at path, a file for each range of doc_id, rows in ascending (doc_id, text
    hash) order within and across files.

    Each row also holds its file's number and its start among the file's ids, so a reader turns the per-file totals into
    global places without sorting again. Integer columns are written with ORC's run-length encoding; row-group indexes
    and Bloom filters on doc_id let a reader skip stripes and row groups (see `lookup`). One shuffle, of texts, by range.
    Null text: no ids but the end id. Null doc_id: sorted first, kept. Repeated rows stay. No rows: files without rows.
    Other columns are ignored.
    """
    common.ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tie = F.xxhash64("text")
    (
        rows.repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
        .mapInArrow(_encoder(tokenizer, end_id), SCHEMA)
        .write.option("orc.compress", compression.upper())
        .option("compression", compression)
        .option("orc.stripe.size", stripe_mb << 20)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", 5000)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, part_start, n_tokens, ids of a store; stripes are read in parallel."""
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of a few documents: the filter reaches ORC's statistics and Bloom filters, which rule out most row groups."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(list(doc_ids)))


def part_offsets(spark: SparkSession, path: str) -> list[int]:
    """Ids before each file's first; a number for each file, summed from the file's counts alone (ids aren't read)."""
    totals = dict(read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens")).collect())
    out, before = [], 0
    for part in range(max(totals, default=-1) + 1):
        out.append(before)
        before += totals.get(part, 0)
    return out


def _digest(offsets: list[int]):
    def digest(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        base = np.asarray(offsets or [0], np.int64)
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
            at = ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            part = b.column(b.schema.get_field_index("part")).to_numpy()
            start = base[part] + b.column(b.schema.get_field_index("part_start")).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(start), b.column(b.schema.get_field_index("n_tokens")), pa.array(np.asarray(crcs, np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return digest


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (unsigned, of little-endian 32-bit ids) of a store."""
    return read_tokens(spark, path).mapInArrow(_digest(part_offsets(spark, path)), "doc_id long, start long, n_tokens long, ids_crc32 long")
