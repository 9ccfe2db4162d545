"""Monitoring operators (M1-M14) over a prediction log.

Log schema: ``(request_id, ts, target, prob, threshold, active, hours,
latency_ms, y?)``.  Everything is a grouped aggregation or a window over a
*pre-aggregated* per-day table (at most #days rows per target), so the
windows never see raw events.  Streaming forms live in
:mod:`jobsheet.streaming`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsheet.functions.stats import f1

# FIXED VALUES - alert thresholds named by the original monitoring notes
PREVALENCE_SHIFT_PP = 15.0
LOW_CONFIDENCE_BAND = 0.05
ZSCORE_LIMIT = 3.0
ERROR_RATE_LIMIT = 5.0
LATENCY_P95_LIMIT_MS = 500.0
LATENCY_P95_TARGET_MS = 200.0
ROLLING_F1_FLOOR = 0.80
KS_C_ALPHA_05 = 1.358


def prediction_log(events: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The driver's ``events`` table read as a prediction log: event_type is
    the target, props.k/100 the probability, value the latency (ms) and,
    for active predictions, value/10 the predicted hours; the outcome y is
    value >= 100."""
    prob = F.get_json_object("props", "$.k").cast("double") / 100.0
    active = prob >= threshold
    return events.select(
        F.col("event_id").alias("request_id"), "ts", "user_id", F.col("event_type").alias("target"),
        prob.alias("prob"), F.lit(threshold).alias("threshold"), active.alias("active"),
        F.when(active, F.col("value") / 10.0).otherwise(F.lit(0.0)).alias("hours"),
        F.col("value").alias("latency_ms"), (F.col("value") >= 100).cast("int").alias("y"),
        F.to_date("ts").alias("day"), "props", "value")


def prevalence_report(log: DataFrame) -> DataFrame:
    """M1: active %, mean probability (all rows), mean hours of active rows."""
    return log.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), (100.0 * F.avg(F.col("active").cast("double"))).alias("active_pct"),
        F.avg("prob").alias("avg_prob"),
        F.coalesce(F.avg(F.when(F.col("active"), F.col("hours"))), F.lit(0.0)).alias("avg_active_hours"))


def batch_stats(log: DataFrame) -> DataFrame:
    """M2: min / avg / max of total hours and active steps per (user, day)
    request batch, and of the latency."""
    per = log.groupBy("user_id", "day").agg(F.sum("hours").alias("total_hours"),
                                            F.count_if("active").alias("active_steps"))
    a = per.agg(F.min("total_hours").alias("min_total_hours"), F.avg("total_hours").alias("avg_total_hours"),
                F.max("total_hours").alias("max_total_hours"), F.min("active_steps").alias("min_active_steps"),
                F.avg("active_steps").alias("avg_active_steps"), F.max("active_steps").alias("max_active_steps"))
    lat = log.agg(F.min("latency_ms"), F.avg("latency_ms"), F.max("latency_ms"))
    return a.select("*", *[lat.select(c).scalar().alias(n) for c, n in
                           zip(lat.columns, ("min_latency_ms", "avg_latency_ms", "max_latency_ms"))])


def zero_hour_alert(log: DataFrame) -> DataFrame:
    """M3: targets that are active but whose active hours average 0."""
    g = log.groupBy("target").agg(F.count_if("active").alias("n_active"),
                                  F.coalesce(F.avg(F.when(F.col("active"), F.col("hours"))), F.lit(0.0))
                                  .alias("avg_active_hours"))
    return g.withColumn("zero_hour_alert", (F.col("n_active") > 0) & (F.col("avg_active_hours") == 0))


def low_confidence_share(log: DataFrame, band: float = LOW_CONFIDENCE_BAND) -> DataFrame:
    """M4: share of predictions within ``band`` of their threshold."""
    near = F.abs(F.col("prob") - F.col("threshold")) < band
    return log.groupBy("target").agg((100.0 * F.avg(near.cast("double"))).alias("low_confidence_pct"))


def prevalence_shift(log: DataFrame, ref_end: str, cur_start: str, limit_pp: float = PREVALENCE_SHIFT_PP) -> DataFrame:
    """M5: active % in the current window vs the reference window."""
    t = F.col("ts")
    ref = t < F.lit(ref_end).cast("timestamp_ntz")
    cur = t >= F.lit(cur_start).cast("timestamp_ntz")
    g = log.groupBy("target").agg(
        (100.0 * F.avg(F.when(ref, F.col("active").cast("double")))).alias("ref_pct"),
        (100.0 * F.avg(F.when(cur, F.col("active").cast("double")))).alias("cur_pct"))
    return g.withColumn("shift_pp", F.col("cur_pct") - F.col("ref_pct")).withColumn(
        "alert", F.abs(F.col("shift_pp")) > limit_pp)


def daily(log: DataFrame) -> DataFrame:
    """Per (target, day) counts - the small table every rolling signal reads."""
    return log.groupBy("target", "day").agg(F.count(F.lit(1)).alias("n"), F.count_if("active").alias("n_active"))


def rolling_prevalence_drift(log: DataFrame, short_days: int = 7, long_days: int = 28,
                             limit_pp: float = PREVALENCE_SHIFT_PP) -> DataFrame:
    """M6: pooled active % over the trailing 7 days vs the trailing 28 days."""
    d = daily(log).withColumn("dn", F.datediff("day", F.lit("1970-01-01")))
    ws = Window.partitionBy("target").orderBy("dn").rangeBetween(-(short_days - 1), 0)
    wl = Window.partitionBy("target").orderBy("dn").rangeBetween(-(long_days - 1), 0)
    d = d.withColumns({"short_pct": 100.0 * F.sum("n_active").over(ws) / F.sum("n").over(ws),
                       "long_pct": 100.0 * F.sum("n_active").over(wl) / F.sum("n").over(wl)})
    return d.select("target", F.date_format("day", "yyyy-MM-dd").alias("day"), "short_pct", "long_pct",
                    (F.abs(F.col("short_pct") - F.col("long_pct")) > limit_pp).alias("alert"))


def ks_two_sample(values: DataFrame, group: Sequence[str], sample: str, x: str,
                  c_alpha: float = KS_C_ALPHA_05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per group.

    ``sample`` holds 'a' / 'b'.  Counts per distinct value (partial
    aggregation), exact ECDFs from distributed running sums (no window over
    a whole group), then the max gap; the drift flag compares with
    c(alpha) * sqrt((n+m)/(n*m))."""
    from jobsheet.operators.prefix import prefix_sums
    c = values.groupBy(*group, F.col(x).alias("x")).agg(
        F.count_if(F.col(sample) == "a").alias("ca"), F.count_if(F.col(sample) == "b").alias("cb"))
    c = prefix_sums(c, group, "x", ["ca", "cb"])
    g = c.groupBy(*group).agg(
        F.max(F.abs(F.col("cum_ca") / F.col("tot_ca") - F.col("cum_cb") / F.col("tot_cb"))).alias("ks"),
        F.first("tot_ca").alias("n_a"), F.first("tot_cb").alias("n_b"))
    crit = F.lit(c_alpha) * F.sqrt((F.col("n_a") + F.col("n_b")) / (F.col("n_a") * F.col("n_b")))
    return g.withColumn("critical", crit).withColumn("drift", F.col("ks") > F.col("critical"))


def confidence_ks(log: DataFrame, split_ts: str) -> DataFrame:
    """M7: probability distribution before vs after ``split_ts`` per target."""
    s = F.when(F.col("ts") < F.lit(split_ts).cast("timestamp_ntz"), "a").otherwise("b")
    return ks_two_sample(log.withColumn("sample", s), ["target"], "sample", "prob")


def duration_zscore(log: DataFrame, limit: float = ZSCORE_LIMIT) -> DataFrame:
    """M8: active-row durations with |z| > 3 per target."""
    act = log.where("active")
    st = act.groupBy("target").agg(F.avg("hours").alias("mu"), F.stddev_samp("hours").alias("sd"))
    j = act.join(st, "target")
    z = (F.col("hours") - F.col("mu")) / F.col("sd")
    return j.groupBy("target", "mu", "sd").agg(F.count(F.lit(1)).alias("n"),
                                               F.count_if(F.abs(z) > limit).alias("n_outliers"))


def error_rate(log: DataFrame, error_target: str = "error", limit_pct: float = ERROR_RATE_LIMIT) -> DataFrame:
    """M9: share of rejected requests per day (tumbling 1-day windows)."""
    g = log.groupBy("day").agg((100.0 * F.avg((F.col("target") == error_target).cast("double"))).alias("error_pct"),
                               F.count(F.lit(1)).alias("n"))
    return g.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "error_pct",
                    (F.col("error_pct") > limit_pct).alias("alert"))


def latency_p95(log: DataFrame) -> DataFrame:
    """Exact p95 latency per day vs the 500 ms alert and 200 ms target."""
    g = log.groupBy("day").agg(F.percentile("latency_ms", F.lit(0.95)).alias("p95_ms"))
    return g.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "p95_ms",
                    (F.col("p95_ms") > LATENCY_P95_LIMIT_MS).alias("alert"),
                    (F.col("p95_ms") > LATENCY_P95_TARGET_MS).alias("above_target"))


def rolling_f1(log: DataFrame, days: int = 7, floor: float = ROLLING_F1_FLOOR) -> DataFrame:
    """Trailing-7-day F1 per target from daily confusion counts, macro
    over targets per day, alert below the floor."""
    d = log.groupBy("target", "day").agg(F.count_if(F.col("active") & (F.col("y") == 1)).alias("tp"),
                                         F.count_if(F.col("active") & (F.col("y") == 0)).alias("fp"),
                                         F.count_if(~F.col("active") & (F.col("y") == 1)).alias("fn"))
    d = d.withColumn("dn", F.datediff("day", F.lit("1970-01-01")))
    w = Window.partitionBy("target").orderBy("dn").rangeBetween(-(days - 1), 0)
    d = d.withColumn("f1", f1(F.sum("tp").over(w), F.sum("fp").over(w), F.sum("fn").over(w)))
    g = d.groupBy("day").agg(F.avg("f1").alias("macro_f1"))
    return g.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "macro_f1",
                    (F.col("macro_f1") < floor).alias("alert"))


def null_rate(log: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Null share per field and day."""
    g = log.groupBy("day").agg(*[(100.0 * F.avg(F.col(c).isNull().cast("double"))).alias(f"null_pct_{c}")
                                 for c in fields])
    return g.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def feature_drift(feats: DataFrame, sample: Column, feature_cols: Sequence[str], key: str = "order_id") -> DataFrame:
    """KS per feature between two samples of orders (e.g. train vs test)."""
    lg = feats.select(key, sample.alias("sample"), *[F.col(c).cast("double").alias(c) for c in feature_cols]) \
        .unpivot([key, "sample"], list(feature_cols), "feature", "x")
    return ks_two_sample(lg, ["feature"], "sample", "x")
