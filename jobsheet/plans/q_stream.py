"""Streaming queries (H7, M6, M9-M11, M13).  Each replays a driver table as
a file stream with ``availableNow``, lands the result in the shared
folder and returns it; the oracle is the batch SQL of the same signal, so
every check is "stream result == batch result"."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_monitor import LOG
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import json_orders as A
from jobsheet.sources import order_view as V
from jobsheet.sources import sinks as K
from jobsheet.streaming import monitor as SM
from jobsheet.sources.tables import table
from jobsheet.streaming.sources import replay_files, replay_stream, run_available, run_closed, table_stream

CFG = part_catalog()
r, big = S.r, S.big


def _events(spark, sf):
    return SM.log_stream(table_stream(spark, sf, "events"))


STREAM_FEATURES = ["n_positions", "n_useful", "n_zero_time", "n_zero_price", "total_time", "total_price",
                   "max_time", "mean_time", "median_time", "max_price", "mean_price", "std_time", "std_price"] + \
    [f"{p}_{c}" for c in CFG.cost_centers for p in ("time", "price", "n")] + list(CFG.keyword_flags)


def _score_stream_sql():
    sel = []
    for c in STREAM_FEATURES:
        if c.startswith("n_") or c.startswith("kw_"):
            sel.append(f"{big(c) if c.startswith('n_') else c} AS {c}")
        else:
            sel.append(f"{r(c)} AS {c}")
    return S.feature_ctes(CFG) + "\nSELECT order_id, " + ", ".join(sel) + \
        " FROM feat WHERE order_id % 101 <> 0 AND order_id % 103 <> 0 AND order_id % 107 <> 0"


def order_files(spark, sf) -> str:
    """The order documents of the view as JSON files, written once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _FILES:
        path = K.shared_path(spark, "fixtures", f"orders-{uuid.uuid4().hex}")
        K.order_documents(V.positions(spark, sf), V.headers(spark, sf), V.targets_wide(spark, sf, CFG), CFG.targets) \
            .write.option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)
        _FILES[key] = path
    return _FILES[key]


_FILES: dict[tuple[str, str], str] = {}
#: Documents in one file: the files grow in number with the orders, not in size.
FILE_DOCUMENTS = 50_000
#: Micro-batches that a replay of the order documents is dealt into.
BATCHES = 4


def order_replay(spark, path: str):
    """The files as a stream of some :data:`BATCHES` micro-batches, whatever their number."""
    return order_stream(spark, path, max(1, -(-len(spark.read.text(path).inputFiles()) // BATCHES)))


def order_stream(spark, path: str, files: int = 1):
    return (spark.readStream.schema(A.ORDER_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("maxFilesPerTrigger", files).json(path))


@query("score_stream", _score_stream_sql, "H")
def q_score_stream(spark, sf):
    """H7 features: order documents arriving as files are featurised per document
    (stateless) and land in a parquet sink; equals the batch features."""
    out = run_available(SM.feature_stream(order_replay(spark, order_files(spark, sf)), CFG), "score_stream")
    return round_doubles(out.select("order_id", *STREAM_FEATURES))


@query("score_stream_orders", None, "H")
def q_score_stream_orders(spark, sf):
    """H7: order documents arriving as files are scored by the bundle that is current for their micro-batch."""
    from jobsheet.plans.q_models import Workspace, bundle_root
    root, base = bundle_root(spark, sf), K.shared_path(spark, "streams", f"scores-{uuid.uuid4().hex}")
    SM.score_order_stream(order_replay(spark, order_files(spark, sf)), root, f"{base}/out", f"{base}/checkpoint", CFG).awaitTermination()
    scored = spark.read.parquet(f"{base}/out")
    targets = Workspace.of(spark, sf).training.targets
    return scored.select("order_id", F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"), "response", "model_version").select(
        "order_id", "target", F.col("response.predictions")[F.col("target")]["probability"].alias("probability"),
        F.col("response.predictions")[F.col("target")]["threshold"].alias("threshold"),
        F.col("response.predictions")[F.col("target")]["predicted_hours"].alias("predicted_hours"), "model_version")


@query("stream_error_rate", lambda: LOG + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n,
       {r("100.0 * avg(CAST(target = 'error' AS DOUBLE))")} AS error_pct,
       100.0 * avg(CAST(target = 'error' AS DOUBLE)) > 5 AS alert FROM lg GROUP BY day""", "M")
def q_stream_error_rate(spark, sf):
    """M9 on the stream: tumbling daily windows with a watermark."""
    return round_doubles(run_available(SM.error_rate_stream(_events(spark, sf)), "error_rate", mode="complete"))


@query("stream_latency_p95", lambda: LOG + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, {r('quantile_cont(latency_ms, 0.95)')} AS p95_ms,
       quantile_cont(latency_ms, 0.95) > 500 AS alert, quantile_cont(latency_ms, 0.95) > 200 AS above_target
FROM lg GROUP BY day""", "M")
def q_stream_latency_p95(spark, sf):
    """M10 on the stream: exact daily p95 latency."""
    return round_doubles(run_available(SM.latency_p95_stream(_events(spark, sf)), "latency_p95", mode="complete"))


@query("stream_rolling_prevalence", lambda: LOG + f"""
, dd AS (SELECT target, day, count(*) AS n, count_if(active) AS n_active FROM lg GROUP BY target, day),
ends AS (SELECT DISTINCT target, day + CAST(k AS INTEGER) AS e FROM dd, range(0, 7) t(k))
SELECT e.target, strftime(e.e, '%Y-%m-%d') AS end_day, {big('sum(d.n)')} AS n, {big('sum(d.n_active)')} AS n_active,
       {r('100.0 * sum(d.n_active) / sum(d.n)')} AS active_pct
FROM ends e JOIN dd d ON d.target = e.target AND d.day BETWEEN e.e - 6 AND e.e GROUP BY e.target, e.e""", "M")
def q_stream_rolling_prevalence(spark, sf):
    """M6 on the stream: 7-day windows sliding by one day."""
    return round_doubles(run_available(SM.prevalence_sliding(_events(spark, sf)), "prevalence", mode="complete"))


@query("stream_outcome_join", lambda: LOG + """
SELECT strftime(day, '%Y-%m-%d') AS day, target, CAST(count_if(active AND y = 1) AS BIGINT) AS tp,
       CAST(count_if(active AND y = 0) AS BIGINT) AS fp, CAST(count_if(NOT active AND y = 1) AS BIGINT) AS fn,
       count(*) AS n FROM lg GROUP BY day, target""", "M")
def q_stream_outcome_join(spark, sf):
    """M11 input on the stream: predictions joined to outcomes within one
    hour of event time (stream-stream join, both sides watermarked)."""
    preds = _events(spark, sf)
    outs = _events(spark, sf)
    j = run_available(SM.outcome_join(preds, outs), "outcome_join")
    return j.groupBy("day", "target").agg(
        F.count_if(F.col("active") & (F.col("y") == 1)).alias("tp"),
        F.count_if(F.col("active") & (F.col("y") == 0)).alias("fp"),
        F.count_if(~F.col("active") & (F.col("y") == 1)).alias("fn"), F.count(F.lit(1)).alias("n"))


@query("stream_dedup", lambda: LOG + """
SELECT request_id, any_value(user_id) AS user_id, any_value(target) AS target FROM lg GROUP BY request_id""", "M")
def q_stream_dedup(spark, sf):
    """The request log arriving twice; each request stays once."""
    log = SM.log_stream(table_stream(spark, sf, "events").unionByName(table_stream(spark, sf, "events")))
    return run_available(SM.dedup_stream(log), "dedup").select("request_id", "user_id", "target")


@query("stream_rolling_prevalence_28d", lambda: LOG + f"""
, dd AS (SELECT target, day, count(*) AS n, count_if(active) AS n_active FROM lg GROUP BY target, day),
ends AS (SELECT DISTINCT target, day + CAST(k AS INTEGER) AS e FROM dd, range(0, 28) t(k))
SELECT e.target, strftime(e.e, '%Y-%m-%d') AS end_day, {big('sum(d.n)')} AS n, {big('sum(d.n_active)')} AS n_active,
       {r('100.0 * sum(d.n_active) / sum(d.n)')} AS active_pct
FROM ends e JOIN dd d ON d.target = e.target AND d.day BETWEEN e.e - 27 AND e.e GROUP BY e.target, e.e""", "M")
def q_stream_rolling_prevalence_28d(spark, sf):
    """M6 baseline on the stream: 28-day windows sliding by one day."""
    return round_doubles(run_available(SM.prevalence_sliding(_events(spark, sf), "28 days", "1 day"),
                                       "prevalence28", mode="complete"))


# ---------------------------------------------------------------- append mode: closed windows of a replay in time order
DELAY = "8 days"  # beyond one span of the replay
CLOSED = ", closed AS (SELECT max(ts) - INTERVAL 8 DAY AS wm FROM events)"


def event_files(spark, sf) -> str:
    key = (spark.sparkContext.applicationId, sf.rstrip("/") + "#events")
    if key not in _FILES:
        _FILES[key] = replay_files(spark, table(spark, sf, "events"), "ts", "events")
    return _FILES[key]


def _replay(spark, sf):
    return SM.log_stream(replay_stream(spark, event_files(spark, sf)), delay=DELAY)


@query("stream_latency_sketch", lambda: LOG + CLOSED + f"""
, b AS (SELECT day, CASE WHEN latency_ms > 0 THEN CAST(ceil(ln(latency_ms) / ln(1.01::DOUBLE / 0.99::DOUBLE)) AS INTEGER) END AS bucket, count(*) AS n
        FROM lg, closed WHERE day + INTERVAL 1 DAY <= wm GROUP BY ALL),
c AS (SELECT day, bucket, sum(n) OVER (PARTITION BY day ORDER BY bucket NULLS FIRST) AS below, sum(n) OVER (PARTITION BY day) AS total FROM b),
v AS (SELECT day, any_value(total) AS n, min(coalesce(2 * pow(1.01::DOUBLE / 0.99::DOUBLE, bucket) / (1.01::DOUBLE / 0.99::DOUBLE + 1), 0)) AS value
      FROM c WHERE below >= ceil(0.95::DOUBLE * total) GROUP BY day)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(n AS BIGINT) AS n, {r('value')} AS p95_ms, value > 500 AS alert, value > 200 AS above_target FROM v""", "M")
def q_stream_latency_sketch(spark, sf):
    """M10 in append mode: p95 of closed days from a bounded sketch (values to 1 %)."""
    buckets, _ = run_closed(SM.latency_sketch_stream(_replay(spark, sf)), "latency-sketch")
    v = SM.sketch_quantile(buckets, "day", 0.95)
    return round_doubles(v.select("day", "n", F.col("value").alias("p95_ms"), (F.col("value") > 500).alias("alert"), (F.col("value") > 200).alias("above_target")))


@query("stream_error_rate_closed", lambda: LOG + CLOSED + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n, {r("100.0 * avg(CAST(target = 'error' AS DOUBLE))")} AS error_pct,
       100.0 * avg(CAST(target = 'error' AS DOUBLE)) > 5 AS alert FROM lg, closed WHERE day + INTERVAL 1 DAY <= wm GROUP BY day""", "M")
def q_stream_error_rate_closed(spark, sf):
    """M9 in append mode: a day is reported once, when the watermark has passed it."""
    return round_doubles(run_closed(SM.error_rate_stream(_replay(spark, sf)), "error-rate")[0])


@query("stream_prevalence_closed", lambda: LOG + CLOSED + f"""
, dd AS (SELECT target, day, count(*) AS n, count_if(active) AS n_active FROM lg GROUP BY target, day),
ends AS (SELECT DISTINCT target, day + CAST(k AS INTEGER) AS e FROM dd, range(0, 7) t(k))
SELECT e.target, strftime(e.e, '%Y-%m-%d') AS end_day, {big('sum(d.n)')} AS n, {big('sum(d.n_active)')} AS n_active,
       {r('100.0 * sum(d.n_active) / sum(d.n)')} AS active_pct
FROM ends e JOIN dd d ON d.target = e.target AND d.day BETWEEN e.e - 6 AND e.e, closed WHERE e.e + INTERVAL 1 DAY <= wm GROUP BY e.target, e.e""", "M")
def q_stream_prevalence_closed(spark, sf):
    """M6 in append mode: 7-day windows sliding by one day, reported once they are closed."""
    return round_doubles(run_closed(SM.prevalence_sliding(_replay(spark, sf)), "prevalence")[0])


@query("stream_delayed_outcomes", lambda: LOG + f"""
, j AS (SELECT *, (request_id * 7919) % 2160 AS minutes FROM lg)
SELECT strftime(day, '%Y-%m-%d') AS day, target, CAST(count_if(active AND y = 1) AS BIGINT) AS tp, CAST(count_if(active AND y = 0) AS BIGINT) AS fp,
       CAST(count_if(NOT active AND y = 1) AS BIGINT) AS fn, count(*) AS n,
       {r('CASE WHEN 2*count_if(active AND y = 1) + count_if(active AND y = 0) + count_if(NOT active AND y = 1) > 0 THEN 2.0*count_if(active AND y = 1)/(2*count_if(active AND y = 1) + count_if(active AND y = 0) + count_if(NOT active AND y = 1)) ELSE 0.0 END')} AS f1
FROM j WHERE minutes <= 1440 GROUP BY day, target""", "M")
def q_stream_delayed_outcomes(spark, sf):
    """Outcomes up to 36 hours after their prediction; those beyond 24 hours come too late."""
    events = table(spark, sf, "events")
    moved = events.withColumn("ts", F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") * 7919 % 2160).cast("int")))
    later = replay_files(spark, moved, "ts", "outcomes")
    base = K.shared_path(spark, "streams", f"outcomes-{uuid.uuid4().hex}")
    outcomes = SM.log_stream(replay_stream(spark, later), delay=DELAY)
    SM.delayed_outcomes(_replay(spark, sf), outcomes, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return round_doubles(SM.outcome_f1(spark, f"{base}/out"))
