"""Best-fit decreasing packing of token sequences (operator 10).

1. Every whole text is tokenized where it is read; only piece sizes and
   checksums go on.  A piece knows its rank among the pieces of its length in
   its partition.
2. Best-fit decreasing treats pieces of one length alike, so the whole corpus
   is packed from the count of each length: at most ``capacity`` numbers,
   whatever the input's size.  A segment tree over remaining capacities finds
   the tightest open bin in logarithmic time; a step places all pieces that
   best fit would place alike.  The result is that of placing the pieces one by
   one.
3. The plan (its size depends on the capacity alone) is broadcast and every
   piece looks up its place by (length, rank).

Defined results: a null or empty text is one piece holding the end id; repeated
rows and equal or null ids are separate documents; an empty table gives an
empty result; columns other than the id and the text are not read, so their
names can't clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from jobsheet.llm.common import keep, small_batches
from jobsheet.llm.tokens import default_tokenizer, encoder


RANK_BITS = 44  #: of a lookup key; the rest holds the length


class CapacityTree:
    """Open bins by remaining capacity; ``tightest(n)`` is the least capacity of n or more that has one."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.open = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def put(self, remaining: int, start: int, bins: int) -> None:
        if remaining and bins:
            self.runs[remaining].append((start, bins))
            self._add(remaining, bins)

    def take(self, remaining: int) -> tuple[int, int]:
        start, bins = self.runs[remaining].pop()
        self._add(remaining, -bins)
        return start, bins

    def _add(self, i: int, bins: int) -> None:
        i += self.size
        while i:
            self.open[i] += bins
            i >>= 1

    def tightest(self, n: int) -> int | None:
        i = n + self.size
        if self.open[i]:
            return n
        while i > 1:  # up, until a right neighbour holds an open bin
            if not i & 1 and self.open[i + 1]:
                i += 1
                break
            i >>= 1
        if i <= 1:
            return None
        while i < self.size:  # down, to its leftmost
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, first bin, pieces a bin, first offset)``: the piece of rank r from the
    first rank on lies in bin ``first bin + (r - first rank) // pieces`` at the place of the remainder."""
    tree, plan, bins = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                start, n = bins, -(-left // each)
                bins += n
            else:
                each = room // length
                start, n = tree.take(room)
            plan.append((length, rank, start, each, capacity - room))
            full, rest = min(n, left // each), 0
            tree.put(room - each * length, start, full)
            placed = full * each
            if full < n and left > placed:
                rest = left - placed
                tree.put(room - rest * length, start + full, 1)
                placed, full = placed + rest, full + 1
            tree.put(room, start + full, n - full)
            left, rank = left - placed, rank + placed
    return plan


def _pieces(path: str, capacity: int, end_id: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("part", pa.int32()), ("local_rank", pa.int64())])

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        seen: dict[int, int] = {}
        for batch in batches:
            rows = [[] for _ in range(6)]
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate([np.frombuffer(enc.encode(text), enc.dtype).astype("<u4"), end])
                for k, lo in enumerate(range(0, len(ids), capacity)):
                    piece = ids[lo:lo + capacity]
                    n = len(piece)
                    rank = seen.get(n, 0)
                    seen[n] = rank + 1
                    for col, v in zip(rows, (at, k, lo, n, zlib.crc32(piece.tobytes()), rank), strict=True):
                        col.append(v)
            at, k, lo, n, crc, rank = rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(k, pa.int32()), pa.array(lo, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(at), pa.int32()),
                 pa.array(rank, pa.int64())], schema=schema)

    return run


def _place(plan, id_type: pa.DataType):
    """Look up (length, rank) in the plan, which is sorted by both."""
    schema = pa.schema([("id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        lengths, ranks, bins, each, offsets = plan.value
        keys = lengths << RANK_BITS | ranks
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(keys, length << RANK_BITS | rank, "right") - 1
            k = rank - ranks[i]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), b.column(4),
                 pa.array(bins[i] + k // each[i]), pa.array(offsets[i] + k % each[i] * length)], schema=schema)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0,
         tokenizer: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_tokenizer()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType
    id_type = to_arrow_type(kind)
    ddl = kind.simpleString()
    pieces = keep(source.mapInArrow(
        _pieces(path, capacity, end_id, id_type),
        f"id {ddl}, piece int, start long, length long, ids_crc32 long, part int, local_rank long"), "pieces")
    counted = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    # at most one number per length: bounded by the capacity
    counts = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)
    a = np.array(sorted(plan), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(a[:, i]) for i in range(5)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(offsets, ["part", "length"]).select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("local_rank")).alias("rank"))
    placed = ranked.mapInArrow(
        _place(shared, id_type),
        f"id {ddl}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
