"""Replays in time order: every row in its span, micro-batches that don't grow in number with the files."""

import datetime as dt

from jobsheet.streaming import sources as SS


def test_replay_spans_hold_every_row_and_batches_do_not_grow(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(minutes=37 * k, microseconds=k)) for k in range(1000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").repartition(8)
    path = SS.replay_files(spark, df, "ts", "growth")
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == list(range(1000))
    files = len(spark.read.parquet(path).inputFiles())
    assert files > 20
    q = SS.replay_stream(spark, path).writeStream.format("noop").option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) <= SS.REPLAY_BATCHES
