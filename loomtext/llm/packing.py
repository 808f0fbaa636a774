"""Best-fit packing of documents into sequences of at most `capacity` tokens, planned over the histogram of lengths.

Which document of a length goes where makes no difference, so the packing itself runs over counts by length: at most
`capacity` numbers, however large the corpus. Items above a third of the capacity are matched greedily, at most two to a
sequence, the longest with the longest that still fits; shorter ones then go best-fit, longest first, into the gaps.
The plan is a list of runs (length, first rank, first sequence, items a sequence, place); every document finds its run
from its rank among documents of its length, which is the sum of a per-task counter and a prefix sum of per-task counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, part_rank long"


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first sequence, items a sequence, offset) that place counts[length] items of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be between 1 and the capacity")
    rank = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    sequences = 0

    def put(length: int, items: int, first: int, each: int, offset: int) -> None:
        runs.append((length, rank[length], first, each, offset))
        rank[length] += items
        left[length] -= items

    def opened(n: int, gap: int) -> int:
        nonlocal sequences
        first = sequences
        sequences += n
        if gap:
            gaps.setdefault(gap, []).append((first, n))
        return first

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            b = next((n for n in large if n <= min(a, capacity - a) and left[n] > (n == a)), None)
            if b is None:
                n = left[a]
                put(a, n, opened(n, capacity - a), 1, 0)
            elif b == a:
                n = left[a] // 2
                put(a, 2 * n, opened(n, capacity - 2 * a), 2, 0)
            else:
                n = min(left[a], left[b])
                first = opened(n, capacity - a - b)
                put(a, n, first, 1, 0)
                put(b, n, first, 1, a)
    for a in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[a]:
            gap = min((g for g in gaps if g >= a), default=None)
            if gap is None:
                each = capacity // a
                n = max(1, left[a] // each)
                gap = capacity
                gaps[gap] = [(sequences, n)]
                sequences += n
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            each = gap // a
            full = min(n, left[a] // each)
            if full:
                put(a, full * each, first, each, capacity - gap)
                if gap - each * a:
                    gaps.setdefault(gap - each * a, []).append((first, full))
            elif left[a]:
                full, each = 1, left[a]
                put(a, each, first, each, capacity - gap)
                if gap - each * a:
                    gaps.setdefault(gap - each * a, []).append((first, 1))
            if full < n:
                gaps.setdefault(gap, []).append((first + full, n - full))
    return runs


def _cut(tokenizer: str, capacity: int, end_id: int):
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from loomtext.llm.chunks import ragged
        from loomtext.llm.wordbpe import word_bpe

        bpe, part = word_bpe(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for b in common.slices(whole, 1, 4 << 20):
                flat, counts = ragged(*bpe.encode(b.column(1)), None, end_id)
                flat = flat.astype("<u4")
                n = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                at = np.repeat(np.cumsum(counts) - counts, n) + start
                crc = [zlib.crc32(flat[i:j]) for i, j in zip(at.tolist(), (at + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                by = length[order]
                new = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
                size = np.diff(np.concatenate([new, [len(by)]]))
                rank = np.empty(len(by), np.int64)
                rank[order] = np.arange(len(by)) - np.repeat(new, size) + seen[by]
                seen[by[new]] += size
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(np.asarray(crc, np.int64)), pa.array(np.full(len(row), part, np.int32)), pa.array(rank)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "part_rank"],
                )

    return cut


def _place(runs: list[tuple[int, int, int, int, int]]):
    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        r = np.asarray(sorted(runs), np.int64).reshape(-1, 5)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for b in batches:
            get = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
            length, rank = get("length"), get("rank")
            run = np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            lo = np.searchsorted(r[:, 0], length[order], "left")
            hi = np.searchsorted(r[:, 0], length[order], "right")
            cuts = np.flatnonzero(np.concatenate([[True], lo[1:] != lo[:-1]])) if len(lo) else np.zeros(0, np.int64)
            for i, j in zip(cuts, [*cuts[1:], len(lo)], strict=True):
                rows = order[i:j]
                run[rows] = lo[i] + np.searchsorted(r[lo[i] : hi[i], 1], rank[rows], "right") - 1
            among = rank - r[run, 1]
            each = r[run, 3]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(r[run, 2] + among // each), pa.array(r[run, 4] + among % each * length)], [*names, "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of doc_id, text.

    A document is its ids and the end id; one longer than the capacity is cut into pieces of the capacity, the last may
    be shorter. Pieces are encoded once and written to the shared folder with a per-task rank among pieces of their
    length; no document is shuffled. The plan and the histogram have at most about `capacity` lengths, so both are
    bounded and go to the driver and back; per-task counts, which grow with the tasks, are joined by (task, length) in a
    shuffle of the pieces' numbers, never broadcast. Null text: the end id alone.
    Null doc_id: packed like any other. Repeated rows are packed each. No rows: no rows. Other columns are ignored.
    """
    common.ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = common.materialize(rows.mapInArrow(_cut(tokenizer, capacity, end_id), PIECES), "pieces")
    tasks = common.materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r[0]: r[1] for r in tasks.groupBy("length").agg(F.sum("n")).collect()}
    runs = plan_packing(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets.hint("merge"), ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("part_rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_place(runs), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
