"""Profiling queries K1-K23 and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import labels as L
from jobsheet.operators import positions as P
from jobsheet.operators import profile as K
from jobsheet.plans import sqlbase as S
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import order_view as V

CFG = part_catalog()
r, big, q = S.r, S.big, S.q


def _long(spark, sf):
    return V.targets_long(spark, sf, CFG)


def _rollups(spark, sf):
    return L.target_rollups(V.targets_wide(spark, sf, CFG), CFG.targets)


def T(*extra):
    """targets CTEs (+ optional extra CTEs)."""
    return S.with_(S.targets_wide(CFG), S.targets_long(CFG), *extra)


ROLL = """
roll AS (
  SELECT order_id, CAST(""" + " + ".join(f"CAST({t} > 0 AS INTEGER)" for t in CFG.targets) + """ AS INTEGER) AS n_active,
         """ + " + ".join(CFG.targets) + """ AS total_hours
  FROM tw
)"""


# ---------------------------------------------------------------- K1
@query("target_sparsity", lambda: T() + f"""
SELECT target, {big('count_if(hours = 0)')} AS n_zero, {big('count_if(hours > 0)')} AS n_nonzero,
       {r('100.0 * count_if(hours = 0) / count(*)')} AS pct_zero
FROM tl GROUP BY target""", "K")
def q_target_sparsity(spark, sf):
    return round_doubles(K.target_sparsity(_long(spark, sf)))


# ---------------------------------------------------------------- K2
@query("nonzero_distribution", lambda: T() + f"""
SELECT target, count(*) AS count, {r('avg(hours)')} AS mean, {r('median(hours)')} AS median,
       {r('stddev_samp(hours)')} AS std, {r('max(hours)')} AS max,
       CASE WHEN count(*) >= 3 THEN {r('skewness(hours)')} END AS skew,
       CASE WHEN count(*) >= 4 THEN {r('kurtosis(hours)')} END AS kurt
FROM tl WHERE hours > 0 GROUP BY target HAVING count(*) >= 2""", "K")
def q_nonzero_distribution(spark, sf):
    return round_doubles(K.nonzero_distribution(_long(spark, sf)))


# ---------------------------------------------------------------- K3
def _hist_sql(src: str, group: str | None, value: str, bins: int) -> str:
    g = f"{group}, " if group else ""
    on = f"USING ({group})" if group else "ON TRUE"
    return f"""
hp AS (SELECT {g}{value} AS v FROM {src}),
hr AS (SELECT {g}min(v) AS lo, max(v) AS hi FROM hp {'GROUP BY ' + group if group else ''})
SELECT {g}CAST(CASE WHEN hi - lo > 0 THEN least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END
               AS INTEGER) AS bin, count(*) AS n
FROM hp JOIN hr {on} GROUP BY ALL"""


@query("target_histogram", lambda: T("""
pos_t AS (SELECT target, hours FROM tl WHERE hours > 0)""") + "," + _hist_sql("pos_t", "target", "log10(hours)", 30), "K")
def q_target_histogram(spark, sf):
    return K.target_histogram(_long(spark, sf))


# ---------------------------------------------------------------- K4
@query("total_time_stats", lambda: S.with_(S.targets_wide(CFG), ROLL) + f"""
SELECT {r('avg(total_hours)')} AS mean, {r('median(total_hours)')} AS median,
       {r('max(total_hours)')} AS max, {r('min(total_hours)')} AS min FROM roll""", "K")
def q_total_time_stats(spark, sf):
    return round_doubles(K.total_time_stats(_rollups(spark, sf)))


@query("total_time_histogram", lambda: S.with_(S.targets_wide(CFG), ROLL, """
rp AS (SELECT total_hours FROM roll WHERE total_hours > 0)""") + "," + _hist_sql("rp", None, "total_hours", 50), "K")
def q_total_time_histogram(spark, sf):
    return K.total_time_histogram(_rollups(spark, sf))


# ---------------------------------------------------------------- K5
@query("cooccurrence", lambda: T() + """
SELECT a.target AS target_a, b.target AS target_b,
       CAST(CASE WHEN a.target = b.target THEN 0 ELSE count_if(a.hours > 0 AND b.hours > 0) END AS BIGINT) AS n_both
FROM tl a JOIN tl b ON a.order_id = b.order_id GROUP BY a.target, b.target""", "K")
def q_cooccurrence(spark, sf):
    return K.cooccurrence(V.targets_wide(spark, sf, CFG), CFG.targets)


# ---------------------------------------------------------------- K6
@query("active_steps_stats", lambda: S.with_(S.targets_wide(CFG), ROLL) + f"""
SELECT {r('avg(n_active)')} AS mean, {r('median(n_active)')} AS median,
       max(n_active) AS max, min(n_active) AS min FROM roll""", "K")
def q_active_steps_stats(spark, sf):
    return round_doubles(K.active_steps_stats(_rollups(spark, sf)))


@query("active_steps_counts", lambda: S.with_(S.targets_wide(CFG), ROLL) + """
SELECT n_active, count(*) AS n_orders FROM roll GROUP BY n_active""", "K")
def q_active_steps_counts(spark, sf):
    return K.active_steps_counts(_rollups(spark, sf))


# ---------------------------------------------------------------- K7
@query("make_distribution", lambda: S.with_(S.HDR) + """
SELECT make, count(*) AS n_orders FROM hdr GROUP BY make
ORDER BY n_orders DESC, make ASC NULLS FIRST LIMIT 20""", "K")
def q_make_distribution(spark, sf):
    return K.make_distribution(V.headers(spark, sf))


@query("unknown_make_count", lambda: S.with_(S.HDR) + f"""
SELECT {big("count_if(make IS NULL OR make IN ('unknown', 'Unknown'))")} AS n_unknown FROM hdr""", "K")
def q_unknown_make_count(spark, sf):
    return K.unknown_make_count(V.headers(spark, sf))


# ---------------------------------------------------------------- K8
PPO = """
ppo AS (SELECT order_id, count(*) AS n_positions FROM pos_raw GROUP BY order_id)"""


@query("positions_per_order_stats", lambda: S.with_(S.POS_RAW, PPO) + f"""
SELECT {r('avg(n_positions)')} AS mean, {r('median(n_positions)')} AS median,
       min(n_positions) AS min, max(n_positions) AS max FROM ppo""", "K")
def q_positions_per_order_stats(spark, sf):
    return round_doubles(K.positions_per_order_stats(K.positions_per_order(V.positions(spark, sf))))


@query("positions_per_order_histogram", lambda: S.with_(S.POS_RAW, PPO) + "," + _hist_sql(
    "ppo", None, "n_positions::DOUBLE", 40), "K")
def q_positions_per_order_histogram(spark, sf):
    ppo = K.positions_per_order(V.positions(spark, sf))
    return K.equal_width_histogram(ppo, [], F.col("n_positions").cast("double"), 40)


# ---------------------------------------------------------------- K9
def _sql_breakdown():
    t = S.strip("coalesce(text, '')")
    return S.with_(S.POS_RAW) + f"""
, k AS (
  SELECT count(*) AS n,
         count_if({t} = '') AS empty_text,
         count_if(total_price = 0 AND total_time = 0 AND {t} <> '') AS header_row,
         count_if(total_price > 0 OR total_time > 0) AS useful,
         count_if(cost_center IS NULL) AS null_cost_center
  FROM pos_raw)
SELECT 'empty_text' AS kind, {big('empty_text')} AS n, {r('100.0 * empty_text / n')} AS pct FROM k UNION ALL
SELECT 'header_row', {big('header_row')}, {r('100.0 * header_row / n')} FROM k UNION ALL
SELECT 'useful', {big('useful')}, {r('100.0 * useful / n')} FROM k UNION ALL
SELECT 'null_cost_center', {big('null_cost_center')}, {r('100.0 * null_cost_center / n')} FROM k"""


@query("position_type_breakdown", _sql_breakdown, "K")
def q_position_type_breakdown(spark, sf):
    return round_doubles(K.position_type_breakdown(V.positions(spark, sf)))


# ---------------------------------------------------------------- K10
@query("cost_center_distribution", lambda: S.with_(S.POS_RAW) + f"""
SELECT cost_center, count(*) AS n_positions,
       {r('coalesce(sum(CASE WHEN total_time > 0 THEN total_time END), 0.0)')} AS time_positive
FROM pos_raw GROUP BY cost_center""", "K")
def q_cost_center_distribution(spark, sf):
    return round_doubles(K.cost_center_distribution(V.positions(spark, sf)))


# ---------------------------------------------------------------- K11-K13
UT = """
ut AS (SELECT order_id, coalesce(text, '') AS text FROM pos_raw
       WHERE """ + S.strip("coalesce(text, '')") + """ <> '' AND (total_price > 0 OR total_time > 0))"""


@query("text_encoding_audit", lambda: S.with_(S.POS_RAW, UT) + f"""
SELECT count(*) AS n_texts,
       {big("count_if(regexp_matches(text, '[äöüÄÖÜß]'))")} AS n_umlaut,
       {big("count_if(regexp_matches(text, '\\b(AE|OE|UE|SS)\\b'))")} AS n_ascii_umlaut,
       {r("100.0 * count_if(regexp_matches(text, '[äöüÄÖÜß]')) / greatest(count(*), 1)")} AS pct_umlaut,
       {r("100.0 * count_if(regexp_matches(text, '\\b(AE|OE|UE|SS)\\b')) / greatest(count(*), 1)")} AS pct_ascii_umlaut
FROM ut""", "K")
def q_text_encoding_audit(spark, sf):
    return round_doubles(K.text_encoding_audit(K.useful_texts(V.positions(spark, sf))))


@query("text_length_stats", lambda: S.with_(S.POS_RAW, UT) + f"""
SELECT {r('avg(length(text))')} AS mean_len, {r('median(length(text))')} AS median_len,
       CAST(max(length(text)) AS INTEGER) AS max_len FROM ut""", "K")
def q_text_length_stats(spark, sf):
    return round_doubles(K.text_length_stats(K.useful_texts(V.positions(spark, sf))))


TOK = """
tok AS (
  SELECT unnest(list_filter(regexp_split_to_array(
           regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s+]', ' ', 'g'), '\\s+'), lambda x: x <> '')) AS token
  FROM ut)"""


@query("token_frequency", lambda: S.with_(S.POS_RAW, UT, TOK) + """
SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token ASC LIMIT 30""", "K")
def q_token_frequency(spark, sf):
    return K.token_frequency(K.useful_texts(V.positions(spark, sf)))


@query("distinct_token_count", lambda: S.with_(S.POS_RAW, UT, TOK) + """
SELECT count(DISTINCT token) AS n_distinct_tokens FROM tok""", "K")
def q_distinct_token_count(spark, sf):
    return K.distinct_token_count(K.useful_texts(V.positions(spark, sf)))


# ---------------------------------------------------------------- K14
@query("numeric_distribution", lambda: S.with_(S.POS_RAW) + f"""
, v AS (SELECT CASE WHEN total_price > 0 THEN total_price END AS pp,
               CASE WHEN total_time > 0 THEN total_time END AS tt, total_price FROM pos_raw)
SELECT count(pp) AS n_price, {r('avg(pp)')} AS mean_price, {r('median(pp)')} AS median_price,
       {r('max(pp)')} AS max_price, {r('min(pp)')} AS min_price,
       count(tt) AS n_time, {r('avg(tt)')} AS mean_time, {r('median(tt)')} AS median_time,
       {r('max(tt)')} AS max_time, {r('min(tt)')} AS min_time,
       {big('count_if(total_price < 0)')} AS n_negative_price
FROM v""", "K")
def q_numeric_distribution(spark, sf):
    return round_doubles(K.numeric_distribution(V.positions(spark, sf)))


# ---------------------------------------------------------------- K15-K17
def _pairs_sql():
    rows = " UNION ALL ".join(f"SELECT {q(cc)} AS cost_center, {q(t)} AS target"
                              for cc, ts in CFG.cc_to_targets.items() for t in ts)
    return f"\npairs AS ({rows})"


CCIN = """
ccin AS (SELECT order_id, cost_center, sum(total_time) AS input_time FROM pos_raw GROUP BY order_id, cost_center)"""


@query("unit_ratio", lambda: S.with_(S.POS_RAW, S.targets_wide(CFG), S.targets_long(CFG), CCIN, _pairs_sql()) + f"""
SELECT c.cost_center, p.target, count(*) AS n, {r('median(tl.hours / c.input_time)')} AS median_ratio,
       {r('1.0 / median(tl.hours / c.input_time)')} AS factor
FROM ccin c JOIN pairs p ON c.cost_center = p.cost_center
     JOIN tl ON tl.order_id = c.order_id AND tl.target = p.target
WHERE c.input_time > 0 AND tl.hours > 0
GROUP BY c.cost_center, p.target HAVING count(*) >= 10""", "K")
def q_unit_ratio(spark, sf):
    return round_doubles(K.unit_ratio(V.positions(spark, sf), _long(spark, sf), CFG))


@query("price_time_regression", lambda: S.with_(S.POS_RAW) + f"""
SELECT cost_center, count(*) AS n, {r('regr_slope(total_price, total_time)')} AS slope,
       {r('regr_intercept(total_price, total_time)')} AS intercept,
       {r('corr(total_price, total_time)')} AS r
FROM pos_raw WHERE cost_center IS NOT NULL AND total_price > 0 AND total_time > 0
GROUP BY cost_center HAVING count(*) >= 6""", "K")
def q_price_time_regression(spark, sf):
    return round_doubles(K.price_time_regression(V.positions(spark, sf)))


@query("paint_time_regression", lambda: S.with_(S.POS_RAW, S.targets_wide(CFG), S.targets_long(CFG), CCIN) + f"""
SELECT tl.target, count(*) AS n, {r('regr_slope(tl.hours, c.input_time)')} AS slope,
       {r('corr(tl.hours, c.input_time)')} AS r
FROM ccin c JOIN tl ON c.order_id = tl.order_id
WHERE c.cost_center = {q(CFG.paint_cc)} AND tl.target IN ({', '.join(q(t) for t in CFG.paint_targets)})
  AND tl.hours > 0
GROUP BY tl.target HAVING count(*) >= 6""", "K")
def q_paint_time_regression(spark, sf):
    return round_doubles(K.paint_time_regression(V.positions(spark, sf), _long(spark, sf), CFG))


# ---------------------------------------------------------------- K18
SPEARMAN_FEATURES = ("n_positions", "n_useful", "total_time_input", "total_price_input",
                     "max_time_pos", "mean_time_pos", "ratio_large_time", "ratio_small_time")


def _sql_spearman():
    eda = q_eda_sql_frame()
    unp = " UNION ALL ".join(f"SELECT order_id, {q(c)} AS feature, CAST({c} AS DOUBLE) AS x FROM eda"
                             for c in SPEARMAN_FEATURES)
    return S.with_(S.targets_wide(CFG), S.targets_long(CFG), S.POS_RAW, S.HDR, eda) + f"""
, fl AS ({unp}),
tp AS (SELECT order_id, target, hours AS y FROM tl WHERE hours > 0),
tpn AS (SELECT target FROM tp GROUP BY target HAVING count(*) >= 10),
j AS (SELECT fl.feature, tp.target, fl.x, tp.y FROM fl JOIN tp ON fl.order_id = tp.order_id
      WHERE tp.target IN (SELECT target FROM tpn)),
rk AS (SELECT feature, target,
              rank() OVER (PARTITION BY feature, target ORDER BY x)
                + (count(*) OVER (PARTITION BY feature, target, x) - 1) / 2.0 AS rx,
              rank() OVER (PARTITION BY feature, target ORDER BY y)
                + (count(*) OVER (PARTITION BY feature, target, y) - 1) / 2.0 AS ry
       FROM j)
SELECT feature, target, count(*) AS n,
       CASE WHEN stddev_pop(rx) > 0 AND stddev_pop(ry) > 0 THEN {r('corr(rx, ry)')} END AS spearman_r
FROM rk GROUP BY feature, target"""


def q_eda_sql_frame():
    from jobsheet.plans.q_orders import _sql_eda_features
    body = _sql_eda_features()
    sel = body[body.index("SELECT h.order_id"):]
    pre = body[:body.index("SELECT h.order_id")]
    pr = pre[pre.index(", pr AS"):].lstrip(", ")
    return pr + ",\neda AS (" + sel + ")"


@query("spearman_matrix", _sql_spearman, "K")
def q_spearman_matrix(spark, sf):
    feats = P.eda_order_features(V.positions(spark, sf), V.headers(spark, sf), CFG)
    return round_doubles(K.spearman_matrix(feats, _long(spark, sf), SPEARMAN_FEATURES))


# ---------------------------------------------------------------- K19
def _sql_box():
    tg = ", ".join(q(t) for t in CFG.box_targets)
    return S.with_(S.HDR, S.targets_wide(CFG), S.targets_long(CFG)) + f"""
, top AS (SELECT make FROM hdr WHERE make IS NOT NULL GROUP BY make ORDER BY count(*) DESC, make LIMIT 8),
d AS (SELECT h.make, tl.target, tl.hours FROM hdr h JOIN tl ON h.order_id = tl.order_id
      WHERE h.make IN (SELECT make FROM top) AND tl.target IN ({tg}) AND tl.hours > 0),
qs AS (SELECT make, target, count(*) AS n, quantile_cont(hours, 0.25) AS q1, median(hours) AS med,
              quantile_cont(hours, 0.75) AS q3 FROM d GROUP BY make, target HAVING count(*) >= 5)
SELECT qs.make, qs.target, qs.n, {r('qs.q1')} AS q1, {r('qs.med')} AS median, {r('qs.q3')} AS q3,
       {r('min(CASE WHEN d.hours >= qs.q1 - 1.5 * (qs.q3 - qs.q1) THEN d.hours END)')} AS whisker_lo,
       {r('max(CASE WHEN d.hours <= qs.q3 + 1.5 * (qs.q3 - qs.q1) THEN d.hours END)')} AS whisker_hi
FROM qs JOIN d ON qs.make = d.make AND qs.target = d.target
GROUP BY qs.make, qs.target, qs.n, qs.q1, qs.med, qs.q3"""


@query("make_target_box", _sql_box, "K")
def q_make_target_box(spark, sf):
    return round_doubles(K.make_target_box(V.headers(spark, sf), _long(spark, sf), CFG))


# ---------------------------------------------------------------- K20-K22
def rule_num_sql() -> str:
    """CTE ``rn(order_id, all_time, target, matched, matched_time)``."""
    t = S.strip("coalesce(text, '')")
    ms = ",\n         ".join(
        f"sum(CASE WHEN {S.search('lower(coalesce(text, ' + chr(39) + chr(39) + '))', pat)} THEN total_time ELSE 0.0 END) AS m_{tg}"
        for tg, pat in CFG.rule_patterns.items())
    parts = " UNION ALL\n  ".join(
        f"SELECT h.order_id, coalesce(g.all_time, 0.0) AS all_time, {q(tg)} AS target, "
        f"coalesce({S.search('g.rule_text', pat)}, false) AS matched, coalesce(g.m_{tg}, 0.0) AS matched_time "
        f"FROM hdr h LEFT JOIN rg g ON h.order_id = g.order_id"
        for tg, pat in CFG.rule_patterns.items())
    return f"""
rg AS (
  SELECT order_id, sum(total_time) AS all_time,
         coalesce(string_agg(CASE WHEN {t} <> '' THEN lower({t}) END, ' '
                             ORDER BY line_no, part_key, supp_key), '') AS rule_text,
         {ms}
  FROM pos_raw GROUP BY order_id),
rn AS (
  {parts}
)"""


def _rule_pred(f: str) -> str:
    n = float(len(CFG.rule_patterns))
    return (f"CASE WHEN NOT matched THEN 0.0 WHEN matched_time > 0 THEN matched_time / {f} "
            f"ELSE all_time / {f} / {n} END")


def _rn(spark, sf):
    return K.rule_numerators(V.positions(spark, sf), V.order_keys(spark, sf), CFG)


def _rule_rows(spark, sf):
    return K.rule_rows(V.positions(spark, sf), V.order_keys(spark, sf), CFG)


@query("rule_baseline", lambda: S.with_(S.POS_RAW, S.HDR, rule_num_sql()) + f"""
SELECT order_id, target, {r(_rule_pred('10.0'))} AS rule_hours FROM rn""", "K")
def q_rule_baseline(spark, sf):
    return round_doubles(K.rule_baseline(_rn(spark, sf), CFG, 10.0))


def _grid_sql():
    fac = " UNION ALL ".join(f"SELECT {float(f)}::DOUBLE AS conversion_factor, {i} AS factor_idx"
                             for i, f in enumerate(CFG.conversion_factors))
    return f"""
fac AS ({fac}),
gp AS (SELECT f.conversion_factor, f.factor_idx, tl.hours,
              {_rule_pred('f.conversion_factor')} AS pred
       FROM rn JOIN tl ON rn.order_id = tl.order_id AND rn.target = tl.target CROSS JOIN fac f),
grid AS (
  SELECT conversion_factor, factor_idx, avg(abs(pred - hours)) AS mae,
         sqrt(avg((pred - hours) * (pred - hours))) AS rmse,
         count_if(pred > 0 AND hours > 0) AS tp, count_if(pred > 0 AND NOT hours > 0) AS fp,
         count_if(NOT pred > 0 AND hours > 0) AS fn
  FROM gp GROUP BY conversion_factor, factor_idx)"""


@query("conversion_grid", lambda: S.with_(S.POS_RAW, S.HDR, S.targets_wide(CFG), S.targets_long(CFG),
                                          rule_num_sql(), _grid_sql()) + f"""
SELECT conversion_factor, factor_idx, {r('mae')} AS mae, {r('rmse')} AS rmse,
       {r('CASE WHEN 2*tp+fp+fn > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0.0 END')} AS f1,
       {r('CASE WHEN tp+fp > 0 THEN tp/(tp+fp) ELSE 0.0 END')} AS precision,
       {r('CASE WHEN tp+fn > 0 THEN tp/(tp+fn) ELSE 0.0 END')} AS recall
FROM grid""", "K")
def q_conversion_grid(spark, sf):
    return round_doubles(K.conversion_grid(_rule_rows(spark, sf), V.targets_wide(spark, sf, CFG), CFG))


@query("rule_scores_per_target", lambda: S.with_(S.POS_RAW, S.HDR, S.targets_wide(CFG), S.targets_long(CFG),
                                                 rule_num_sql(), _grid_sql()) + f"""
, bf AS (SELECT arg_min(conversion_factor, (mae, factor_idx)) AS best_factor FROM grid),
pp AS (SELECT rn.target, tl.hours, bf.best_factor, {_rule_pred('bf.best_factor')} AS pred
       FROM rn JOIN tl ON rn.order_id = tl.order_id AND rn.target = tl.target CROSS JOIN bf)
SELECT target, best_factor, {r('avg(abs(pred - hours))')} AS mae,
       {r('CASE WHEN 2*count_if(pred > 0 AND hours > 0) + count_if(pred > 0 AND NOT hours > 0) + count_if(NOT pred > 0 AND hours > 0) > 0 THEN 2.0*count_if(pred > 0 AND hours > 0) / (2*count_if(pred > 0 AND hours > 0) + count_if(pred > 0 AND NOT hours > 0) + count_if(NOT pred > 0 AND hours > 0)) ELSE 0.0 END')} AS f1
FROM pp GROUP BY target, best_factor""", "K")
def q_rule_scores_per_target(spark, sf):
    return round_doubles(K.rule_scores_per_target(_rule_rows(spark, sf), V.targets_wide(spark, sf, CFG), CFG))


# ---------------------------------------------------------------- K23
@query("dataset_summary", lambda: S.with_(S.POS_RAW, S.HDR, S.targets_wide(CFG), S.targets_long(CFG), ROLL, PPO) + f"""
, sp AS (SELECT target, 100.0 * count_if(hours = 0) / count(*) AS pct_zero FROM tl GROUP BY target)
SELECT 'records' AS metric, CAST(count(*) AS DOUBLE) AS value, NULL::VARCHAR AS label FROM hdr
UNION ALL SELECT 'avg_positions', {r('avg(n_positions)')}, NULL FROM ppo
UNION ALL SELECT 'avg_active', {r('avg(n_active)')}, NULL FROM roll
UNION ALL SELECT 'most_sparse', {r('max(pct_zero)')}, arg_min(target, (-pct_zero, target)) FROM sp
UNION ALL SELECT 'least_sparse', {r('min(pct_zero)')}, arg_min(target, (pct_zero, target)) FROM sp""", "K")
def q_dataset_summary(spark, sf):
    long = _long(spark, sf)
    return round_doubles(K.dataset_summary(V.headers(spark, sf), V.positions(spark, sf),
                                           _rollups(spark, sf), K.target_sparsity(long)))
