"""Monitoring queries (M1-M12, M14) over the ``events`` prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import monitor as M
from jobsheet.plans import sqlbase as S
from jobsheet.plans.q_eval import SPLIT, splits_frame
from jobsheet.plans.q_orders import features_frame
from jobsheet.plans.q_profile import ROLL
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources.tables import table

CFG = part_catalog()
r, big, q = S.r, S.big, S.q
REF_END, CUR_START, KS_SPLIT = "2024-01-08", "2024-01-24", "2024-01-16"
DRIFT_FEATURES = ("n_positions", "total_time", "total_price", "mean_time", "max_price", "n_useful")

LOG = """
WITH lg0 AS (SELECT event_id AS request_id, ts, user_id, event_type AS target,
                    CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0::DOUBLE AS prob, value, props
             FROM events),
lg AS (SELECT *, 0.5::DOUBLE AS threshold, prob >= 0.5 AS active,
              CASE WHEN prob >= 0.5 THEN value / 10.0::DOUBLE ELSE 0.0 END AS hours, value AS latency_ms,
              CAST(value >= 100 AS INTEGER) AS y, CAST(ts AS DATE) AS day FROM lg0)"""


def _log(spark, sf):
    return M.prediction_log(table(spark, sf, "events"))


@query("prevalence_report", lambda: LOG + f"""
SELECT target, count(*) AS n, {r('100.0 * avg(CAST(active AS DOUBLE))')} AS active_pct, {r('avg(prob)')} AS avg_prob,
       {r('coalesce(avg(CASE WHEN active THEN hours END), 0.0)')} AS avg_active_hours FROM lg GROUP BY target""", "M")
def q_prevalence_report(spark, sf):
    """M1: per target active %, mean probability, mean active hours."""
    return round_doubles(M.prevalence_report(_log(spark, sf)))


@query("batch_stats", lambda: LOG + f"""
, per AS (SELECT user_id, day, sum(hours) AS total_hours, count_if(active) AS active_steps FROM lg GROUP BY ALL)
SELECT {r('min(total_hours)')} AS min_total_hours, {r('avg(total_hours)')} AS avg_total_hours,
       {r('max(total_hours)')} AS max_total_hours, {big('min(active_steps)')} AS min_active_steps,
       {r('avg(active_steps)')} AS avg_active_steps, {big('max(active_steps)')} AS max_active_steps,
       (SELECT {r('min(latency_ms)')} FROM lg) AS min_latency_ms, (SELECT {r('avg(latency_ms)')} FROM lg) AS avg_latency_ms,
       (SELECT {r('max(latency_ms)')} FROM lg) AS max_latency_ms FROM per""", "M")
def q_batch_stats(spark, sf):
    """M2: statistics of the per-request-batch totals and of the latency."""
    return round_doubles(M.batch_stats(_log(spark, sf)))


@query("zero_hour_alert", lambda: LOG + f"""
SELECT target, {big('count_if(active)')} AS n_active,
       {r('coalesce(avg(CASE WHEN active THEN hours END), 0.0)')} AS avg_active_hours,
       count_if(active) > 0 AND coalesce(avg(CASE WHEN active THEN hours END), 0.0) = 0 AS zero_hour_alert
FROM lg GROUP BY target""", "M")
def q_zero_hour_alert(spark, sf):
    """M3: active targets whose hours average zero."""
    return round_doubles(M.zero_hour_alert(_log(spark, sf)))


@query("low_confidence_flag", lambda: LOG + f"""
SELECT target, {r('100.0 * avg(CAST(abs(prob - threshold) < 0.05 AS DOUBLE))')} AS low_confidence_pct
FROM lg GROUP BY target""", "M")
def q_low_confidence_flag(spark, sf):
    """M4: share of predictions within 0.05 of their threshold."""
    return round_doubles(M.low_confidence_share(_log(spark, sf)))


@query("prevalence_shift_alert", lambda: LOG + f"""
SELECT target, {r(f"100.0 * avg(CASE WHEN ts < TIMESTAMP '{REF_END}' THEN CAST(active AS DOUBLE) END)")} AS ref_pct,
       {r(f"100.0 * avg(CASE WHEN ts >= TIMESTAMP '{CUR_START}' THEN CAST(active AS DOUBLE) END)")} AS cur_pct,
       {r(f"100.0 * avg(CASE WHEN ts >= TIMESTAMP '{CUR_START}' THEN CAST(active AS DOUBLE) END) - 100.0 * avg(CASE WHEN ts < TIMESTAMP '{REF_END}' THEN CAST(active AS DOUBLE) END)")} AS shift_pp,
       abs(100.0 * avg(CASE WHEN ts >= TIMESTAMP '{CUR_START}' THEN CAST(active AS DOUBLE) END)
           - 100.0 * avg(CASE WHEN ts < TIMESTAMP '{REF_END}' THEN CAST(active AS DOUBLE) END)) > 15 AS alert
FROM lg GROUP BY target""", "M")
def q_prevalence_shift_alert(spark, sf):
    """M5: current week vs first week active %, alert beyond 15 points."""
    return round_doubles(M.prevalence_shift(_log(spark, sf), REF_END, CUR_START))


DAILY = """
, dd AS (SELECT target, day, count(*) AS n, count_if(active) AS n_active, day - DATE '1970-01-01' AS dn
         FROM lg GROUP BY target, day)"""


@query("rolling_prevalence_drift", lambda: LOG + DAILY + f"""
, rw AS (SELECT target, day,
                100.0 * sum(n_active) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)
                      / sum(n) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS short_pct,
                100.0 * sum(n_active) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 27 PRECEDING AND CURRENT ROW)
                      / sum(n) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 27 PRECEDING AND CURRENT ROW) AS long_pct
         FROM dd)
SELECT target, strftime(day, '%Y-%m-%d') AS day, {r('short_pct')} AS short_pct, {r('long_pct')} AS long_pct,
       abs(short_pct - long_pct) > 15 AS alert FROM rw""", "M")
def q_rolling_prevalence_drift(spark, sf):
    """M6: trailing 7-day vs 28-day active % per target and day."""
    return round_doubles(M.rolling_prevalence_drift(_log(spark, sf)))


def _ks_sql(src: str, group: str) -> str:
    return f"""
, kc AS (SELECT {group}, x, count_if(sample = 'a') AS ca, count_if(sample = 'b') AS cb FROM {src} GROUP BY {group}, x),
kw AS (SELECT {group}, x,
              sum(ca) OVER (PARTITION BY {group} ORDER BY x ROWS UNBOUNDED PRECEDING) AS fa,
              sum(cb) OVER (PARTITION BY {group} ORDER BY x ROWS UNBOUNDED PRECEDING) AS fb,
              sum(ca) OVER (PARTITION BY {group}) AS na, sum(cb) OVER (PARTITION BY {group}) AS nb FROM kc),
kg AS (SELECT {group}, max(abs(fa / na - fb / nb)) AS ks, CAST(first(na) AS BIGINT) AS n_a,
              CAST(first(nb) AS BIGINT) AS n_b FROM kw GROUP BY {group})
SELECT {group}, {r('ks')} AS ks, n_a, n_b, {r('1.358 * sqrt((n_a + n_b) / (n_a * n_b))')} AS critical,
       ks > 1.358 * sqrt((n_a + n_b) / (n_a * n_b)) AS drift FROM kg"""


@query("confidence_ks", lambda: LOG + f"""
, ks_in AS (SELECT target, prob AS x, CASE WHEN ts < TIMESTAMP '{KS_SPLIT}' THEN 'a' ELSE 'b' END AS sample FROM lg)"""
       + _ks_sql("ks_in", "target"), "M")
def q_confidence_ks(spark, sf):
    """M7: two-sample KS of the probabilities, first half vs second half."""
    return round_doubles(M.confidence_ks(_log(spark, sf), KS_SPLIT))


@query("duration_zscore", lambda: LOG + f"""
, st AS (SELECT target, avg(hours) AS mu, stddev_samp(hours) AS sd FROM lg WHERE active GROUP BY target)
SELECT l.target, {r('st.mu')} AS mu, {r('st.sd')} AS sd, count(*) AS n,
       {big('count_if(abs((l.hours - st.mu) / st.sd) > 3)')} AS n_outliers
FROM lg l JOIN st ON l.target = st.target WHERE l.active GROUP BY l.target, st.mu, st.sd""", "M")
def q_duration_zscore(spark, sf):
    """M8: predicted durations more than 3 standard deviations out."""
    return round_doubles(M.duration_zscore(_log(spark, sf)))


@query("error_rate", lambda: LOG + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS n,
       {r("100.0 * avg(CAST(target = 'error' AS DOUBLE))")} AS error_pct,
       100.0 * avg(CAST(target = 'error' AS DOUBLE)) > 5 AS alert FROM lg GROUP BY day""", "M")
def q_error_rate(spark, sf):
    """M9: rejected share per day, alert above 5%."""
    return round_doubles(M.error_rate(_log(spark, sf)))


@query("latency_p95", lambda: LOG + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, {r('quantile_cont(latency_ms, 0.95)')} AS p95_ms,
       quantile_cont(latency_ms, 0.95) > 500 AS alert, quantile_cont(latency_ms, 0.95) > 200 AS above_target
FROM lg GROUP BY day""", "M")
def q_latency_p95(spark, sf):
    """Exact daily p95 latency vs 500 ms (alert) and 200 ms (target)."""
    return round_doubles(M.latency_p95(_log(spark, sf)))


@query("rolling_f1", lambda: LOG + f"""
, d AS (SELECT target, day, day - DATE '1970-01-01' AS dn, count_if(active AND y = 1) AS tp,
               count_if(active AND y = 0) AS fp, count_if(NOT active AND y = 1) AS fn FROM lg GROUP BY target, day),
w AS (SELECT target, day,
             sum(tp) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS tp7,
             sum(fp) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS fp7,
             sum(fn) OVER (PARTITION BY target ORDER BY dn RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS fn7 FROM d),
f AS (SELECT day, avg(CASE WHEN 2*tp7+fp7+fn7 > 0 THEN 2.0*tp7/(2*tp7+fp7+fn7) ELSE 0.0 END) AS macro_f1
      FROM w GROUP BY day)
SELECT strftime(day, '%Y-%m-%d') AS day, {r('macro_f1')} AS macro_f1, macro_f1 < 0.8 AS alert FROM f""", "M")
def q_rolling_f1(spark, sf):
    """Trailing 7-day macro F1 per day, alert under 0.80."""
    return round_doubles(M.rolling_f1(_log(spark, sf)))


@query("null_rate", lambda: LOG + f"""
SELECT strftime(day, '%Y-%m-%d') AS day,
       {r('100.0 * avg(CAST(props IS NULL AS DOUBLE))')} AS null_pct_props,
       {r('100.0 * avg(CAST(value IS NULL AS DOUBLE))')} AS null_pct_value,
       {r('100.0 * avg(CAST(user_id IS NULL AS DOUBLE))')} AS null_pct_user_id,
       {r('100.0 * avg(CAST(prob IS NULL AS DOUBLE))')} AS null_pct_prob FROM lg GROUP BY day""", "M")
def q_null_rate(spark, sf):
    """Null share per input field and day."""
    return round_doubles(M.null_rate(_log(spark, sf), ["props", "value", "user_id", "prob"]))


def _drift_sql():
    unp = " UNION ALL ".join(f"SELECT {q(c)} AS feature, CAST(f.{c} AS DOUBLE) AS x, "
                             f"CASE WHEN s.split = 'train' THEN 'a' ELSE 'b' END AS sample "
                             f"FROM feat f JOIN split s ON f.order_id = s.order_id WHERE s.split IN ('train', 'test')"
                             for c in DRIFT_FEATURES)
    return S.with_(S.POS_RAW, S.HDR, S.pos_clean(CFG), S.order_aggs(CFG), S.features(CFG),
                   S.targets_wide(CFG), ROLL, SPLIT) + f", fd AS ({unp})" + _ks_sql("fd", "feature")


@query("feature_drift", _drift_sql, "M")
def q_feature_drift(spark, sf):
    """KS of each input feature, training vs test orders."""
    f = features_frame(spark, sf).join(splits_frame(spark, sf).select("order_id", "split"), "order_id") \
        .where(F.col("split").isin("train", "test"))
    s = F.when(F.col("split") == "train", "a").otherwise("b")
    return round_doubles(M.feature_drift(f, s, DRIFT_FEATURES))
