"""Length-delimited binary records with a separate offset index (operator 2).

A record is: payload length (8 bytes, little-endian), masked CRC-32C of those
8 bytes, the payload, masked CRC-32C of the payload.  The payload is a
document's ids in ascending places, as unsigned little-endian integers of 2
bytes where the vocabulary has at most 65,536 entries, else 4.

Documents are range-partitioned by id; each task writes one file to the shared
folder and returns one index row per record.  A file's name holds a fresh
uuid, and only what the index table names is part of the data set: a task that
runs again after a lost executor leaves an orphan, never a wrong record.

Defined results: a null or empty text gives a record of the end id alone;
equal ids are ordered by text hash, then by place in the input; null ids come
first; an empty table gives no file and an empty index.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from jobsheet.llm.common import keep, make_folder, open_fs, partitions, run_folder, small_batches
from jobsheet.llm.crc32c import crc32c, masked
from jobsheet.llm.tokens import default_tokenizer, encoder

HEADER, FOOTER = 12, 4
READ_AT_ONCE = 16 << 20  #: bytes that one read of adjoining records takes at most (or one record)


class BadRecord(ValueError):
    pass


def frame(payloads: list[bytes]) -> list[bytes]:
    sizes = [len(p).to_bytes(8, "little") for p in payloads]
    heads, feet = masked(crc32c(sizes)), masked(crc32c(payloads))
    return [s + h.tobytes() + p + f.tobytes() for s, h, p, f in zip(sizes, heads, payloads, feet, strict=True)]


def unframe(records: list[bytes]) -> list[bytes]:
    """The payloads; raises :class:`BadRecord` where a length or a checksum doesn't hold."""
    sizes, payloads = [r[:8] for r in records], [r[HEADER:-FOOTER] for r in records]
    heads = masked(crc32c(sizes)).astype("<u4").tolist()
    feet = masked(crc32c(payloads)).astype("<u4").tolist()
    for r, s, p, h, f in zip(records, sizes, payloads, heads, feet, strict=True):
        if int.from_bytes(s, "little") != len(p) or int.from_bytes(r[8:HEADER], "little") != h \
                or int.from_bytes(r[-FOOTER:], "little") != f:
            raise BadRecord("a record's length or checksum does not hold")
    return payloads


def _writer(folder: str, path: str, end_id: int, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("file_no", pa.int32()), ("file", pa.string()), ("offset", pa.int64()),
                        ("n_bytes", pa.int64()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        enc, part, out, at, start = encoder(path), TaskContext.get().partitionId(), None, 0, 0
        end = np.array([end_id], enc.dtype).tobytes()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        fs, base = open_fs(folder)
        try:
            for b in batches:
                if not b.num_rows:
                    continue
                out = out or fs.open_output_stream(os.path.join(base, name))
                framed = frame([enc.encode(t) + end for t in b.column(1).to_pylist()])
                sizes = np.array([len(r) for r in framed], np.int64)
                tokens = (sizes - HEADER - FOOTER) // enc.dtype.itemsize
                out.write(b"".join(framed))
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([part] * n, pa.int32()), pa.array([name] * n),
                     pa.array(at + np.cumsum(sizes) - sizes), pa.array(sizes),
                     pa.array(start + np.cumsum(tokens) - tokens), pa.array(tokens)], schema=schema)
                at, start = at + int(sizes.sum()), start + int(tokens.sum())
        finally:
            if out is not None:
                out.close()

    return run


def write_records(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                  tokenizer: str | None = None) -> DataFrame:
    """Write every document's ids in ascending id order to ``folder``; the index, one row per record
    (id, file_no, file, offset, n_bytes, start, n_tokens), is written beside it and returned."""
    spark = docs.sparkSession
    small_batches(spark)
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    # Hash and place split equal ids, so that no key of the range partitioning is hot.
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumns(
        {"h": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = ["id", "h", "place"]
    sorted_docs = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("id", "text")
    index = keep(sorted_docs.mapInArrow(
        _writer(make_folder(spark, folder), tokenizer or default_tokenizer(), end_id, id_type),
        f"id {docs.schema[id_col].dataType.simpleString()}, file_no int, file string, offset long, n_bytes long,"
        " start_in_file long, n_tokens long"), "record-index")
    totals = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))  # one row per file
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("file_start"))
    return index.join(starts, "file_no").select(
        "id", "file_no", "file", "offset", "n_bytes", (F.col("file_start") + F.col("start_in_file")).alias("start"),
        "n_tokens")


def read_ranges(fs, path: str, offsets: list[int], sizes: list[int]):
    """The records at these offsets, in their order; adjoining ones are read together."""
    with fs.open_input_file(path) as f:
        i = 0
        while i < len(offsets):
            j, end = i, offsets[i]
            while j < len(offsets) and offsets[j] == end and (j == i or end + sizes[j] - offsets[i] <= READ_AT_ONCE):
                end += sizes[j]
                j += 1
            data = f.read_at(end - offsets[i], offsets[i])
            at = 0
            for k in range(i, j):
                yield data[at:at + sizes[k]]
                at += sizes[k]
            i = j


def _reader(folder: str, dtype: str, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        fs, base = open_fs(folder)
        for b in batches:
            if not b.num_rows:
                continue
            b = b.take(pc.sort_indices(b, [("file", "ascending"), ("offset", "ascending")]))
            files, offsets, sizes = (b.column(c).to_pylist() for c in ("file", "offset", "n_bytes"))
            counts, crcs, lo = [], [], 0
            while lo < len(files):
                hi, size = lo, 0
                while hi < len(files) and files[hi] == files[lo] and (hi == lo or size + sizes[hi] <= READ_AT_ONCE):
                    size += sizes[hi]
                    hi += 1
                records = list(read_ranges(fs, os.path.join(base, files[lo]), offsets[lo:hi], sizes[lo:hi]))
                for payload in unframe(records):
                    ids = np.frombuffer(payload, dtype).astype("<u4")
                    counts.append(len(ids))
                    crcs.append(zlib.crc32(ids.tobytes()))
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("start"), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())],
                schema=schema)

    return run


def read_records(index: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Read the records that ``index`` names, in any order and any subset, check both checksums
    of each, and return id, start, n_tokens, ids_crc32 (of the ids as unsigned 32-bit integers)."""
    spark = index.sparkSession
    small_batches(spark)
    dtype = encoder(tokenizer or default_tokenizer()).dtype.str
    kind = index.schema["id"].dataType
    # Runs of one file stay together, in blocks of offsets, so a large file is no one task's.
    spread = index.repartition(partitions(spark), "file", F.shiftright("offset", 24)).sortWithinPartitions("file", "offset")
    return spread.mapInArrow(_reader(make_folder(spark, folder), dtype, to_arrow_type(kind)),
                             f"id {kind.simpleString()}, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
               tokenizer: str | None = None) -> DataFrame:
    folder = run_folder(spark, "records")
    index = write_records(docs, folder, id_col, text_col, end_id, tokenizer)
    return read_records(index, folder, tokenizer).withColumnRenamed("id", id_col)
