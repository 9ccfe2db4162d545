"""Streaming sources and a bounded runner.

The driver tables are replayed as file streams.  Event time must be a
``TIMESTAMP`` for watermarks; the tables carry ``TIMESTAMP_NTZ`` wall
times, which are read as UTC instants (appending an explicit zone keeps this
independent of the session time zone).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsheet.sources.sinks import shared_path


def utc_instant(ntz: Column) -> Column:
    return F.concat(ntz.cast("string"), F.lit("Z")).cast("timestamp")


def day_of(instant: Column) -> Column:
    """yyyy-MM-dd of a UTC instant, independent of the session time zone."""
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM-dd")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """File stream over one driver table (schema taken from the table)."""
    path = f"{sf_dir.rstrip('/')}/{name}*.parquet"
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def replay_files(spark: SparkSession, df: DataFrame, ts: str, name: str, spans: int = 5) -> str:
    """``df`` as files in order of ``ts``: equal spans of time, written one after another, since a file stream
    reads files by their age.  Within a span the order is open, so a replay needs a watermark delay beyond one span."""
    path = shared_path(spark, "replays", f"{name}-{uuid.uuid4().hex}")
    lo, hi = df.select(F.unix_micros(utc_instant(F.min(ts))), F.unix_micros(utc_instant(F.max(ts)))).first()
    if lo is None:
        df.write.parquet(path)
        return path
    at = F.col(ts).cast("timestamp_ntz")  # against constants: no row's time becomes a text, and the reader can skip what lies outside
    step = (hi - lo) // spans + 1
    edges = [F.lit("1970-01-01").cast("timestamp_ntz") + F.lit(dt.timedelta(microseconds=lo + k * step)) for k in range(spans + 1)]
    for since, until in zip(edges[:-1], edges[1:], strict=True):
        df.where((at >= since) & (at < until)).write.mode("append").parquet(path)
    return path


#: Micro-batches that a replay in time order is dealt into, as many as its spans.
REPLAY_BATCHES = 5


def replay_stream(spark: SparkSession, path: str, batches: int = REPLAY_BATCHES) -> DataFrame:
    """The files of :func:`replay_files` as a stream of some ``batches`` micro-batches, however many files the spans have
    (each micro-batch commits every partition of the state); two files a micro-batch at least."""
    files = len(spark.read.parquet(path).inputFiles())
    return file_stream(spark, path, max(2, -(-files // batches)))


def file_stream(spark: SparkSession, path: str, files: int) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


def run_closed(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Run an aggregating stream in append mode over everything available: (what closed windows hold, rows that came
    too late for their window).  Open windows stay in the state; the file sink is exactly-once."""
    spark = df.sparkSession
    base = shared_path(spark, "streams", f"{name}-{uuid.uuid4().hex}")
    spark.createDataFrame([], df.schema).write.parquet(f"{base}/none")
    q = df.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).outputMode("append") \
        .format("parquet").option("path", f"{base}/out").start()
    q.awaitTermination()
    late = sum(int(o["numRowsDroppedByWatermark"]) for p in q.recentProgress for o in p["stateOperators"])
    return spark.read.schema(df.schema).parquet(f"{base}/out", f"{base}/none"), late


def run_available(df: DataFrame, name: str, mode: str = "append", run_id: str | None = None) -> DataFrame:
    """Run a streaming query over everything available (``availableNow``),
    write it to a parquet table in the shared folder, return that table.

    ``append`` uses the exactly-once file sink; ``complete`` / ``update``
    re-write the table from each micro-batch (foreachBatch)."""
    spark = df.sparkSession
    run_id = run_id if run_id is not None else uuid.uuid4().hex[:12]
    base = shared_path(spark, "streams", f"{name}-{run_id}")
    out, ck = f"{base}/out", f"{base}/checkpoint"
    w = df.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
    if mode == "append":
        q = w.outputMode("append").format("parquet").option("path", out).start()
    else:
        def sink(batch: DataFrame, _epoch: int) -> None:
            batch.write.mode("overwrite").parquet(out)
        q = w.outputMode(mode).foreachBatch(sink).start()
    q.awaitTermination()
    return spark.read.parquet(out)
