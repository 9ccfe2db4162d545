"""Queries for positions, order features and target shaping (B*, C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsheet.config import part_catalog
from jobsheet.operators import labels as L
from jobsheet.operators import positions as P
from jobsheet.plans import sqlbase as S
from jobsheet.plans.registry import query, round_doubles
from jobsheet.sources import order_view as V

CFG = part_catalog()


def features_frame(spark, sf):
    clean = P.clean_positions(V.positions(spark, sf), CFG)
    return P.order_features(clean, V.headers(spark, sf), CFG)


def texts_frame(spark, sf):
    """Order texts + keyword flags for all orders (no header / make joins)."""
    clean = P.clean_positions(V.positions(spark, sf), CFG)
    return P.order_text_frame(clean, V.order_keys(spark, sf), CFG)


# ---------------------------------------------------------------- B1 / nested
def nested_orders(spark, sf):
    """The view in document form: one row per order with its position list."""
    pos = V.positions(spark, sf)
    lists = pos.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct(
        "line_no", "part_key", "supp_key", "text", "total_price", "total_time",
        "cost_center"))).alias("positions"))
    return V.headers(spark, sf).join(lists, "order_id", "left")


def _sql_explode():
    return S.with_(S.POS_RAW, S.HDR) + """
SELECT h.order_id, h.make,
       CASE WHEN p.order_id IS NULL THEN NULL ELSE
       CAST(row_number() OVER (PARTITION BY h.order_id ORDER BY p.line_no, p.part_key, p.supp_key) - 1
            AS INTEGER) END AS pos,
       p.line_no, p.part_key, p.supp_key, p.text, p.total_price, p.total_time, p.cost_center
FROM hdr h LEFT JOIN pos_raw p ON h.order_id = p.order_id"""


@query("explode_positions", _sql_explode, "B")
def q_explode_positions(spark, sf):
    """B1 on the nested form; orders without positions keep one null row."""
    ex = P.explode_positions(nested_orders(spark, sf))
    ex = ex.withColumn("pos", F.when(F.col("line_no").isNull(), F.lit(None)).otherwise(F.col("pos")))
    return ex


def _sql_clean():
    return S.with_(S.POS_RAW, S.pos_clean(CFG)) + """
SELECT order_id, line_no, part_key, supp_key, text, total_price, total_time, cost_center FROM pos_clean"""


@query("clean_positions", _sql_clean, "B")
def q_clean_positions(spark, sf):
    """B2: coerced positions, fully empty rows removed."""
    return P.clean_positions(V.positions(spark, sf), CFG).select(
        "order_id", "line_no", "part_key", "supp_key", "text", "total_price", "total_time", "cost_center")


def _sql_useful():
    return S.with_(S.POS_RAW, S.pos_clean(CFG)) + """
SELECT order_id, count(*) AS n_useful_rows, sum(total_time) AS useful_time
FROM pos_clean WHERE total_price > 0 OR total_time > 0 GROUP BY order_id"""


@query("useful_positions", _sql_useful, "B")
def q_useful_positions(spark, sf):
    """Positions with price > 0 or time > 0, counted per order."""
    c = P.clean_positions(V.positions(spark, sf), CFG)
    return c.where(P.useful(F.col("total_price"), F.col("total_time"))).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_useful_rows"), F.sum("total_time").alias("useful_time"))


def _sql_texts():
    return S.feature_ctes(CFG) + f"""
SELECT order_id, order_text, full_text,
       CASE WHEN trim(order_text) = '' THEN {S.q(CFG.empty_placeholder)} ELSE order_text END AS doc_text
FROM feat"""


@query("order_texts", _sql_texts, "B")
def q_order_texts(spark, sf):
    """B4 order text, B5 full text, B6 placeholder for blank documents."""
    f = texts_frame(spark, sf)
    return f.select("order_id", "order_text", "full_text",
                    L.with_placeholder(F.col("order_text"), CFG.empty_placeholder).alias("doc_text"))


def _sql_features():
    cols = ["order_id", "make"] + P.feature_columns(CFG)
    dbl = set(P.NUMERIC_ZERO_FILL[4:]) | {f"{p}_{c}" for c in CFG.cost_centers for p in ("time", "price")} \
        | {f"ratio_{c}_time" for c in CFG.ratio_time_ccs} | {f"ratio_{c}_price" for c in CFG.ratio_price_ccs}
    cnt = {"n_positions", "n_useful", "n_zero_time", "n_zero_price", "make_freq"} | {f"n_{c}" for c in CFG.cost_centers}
    sel = []
    for c in cols:
        if c in dbl:
            sel.append(f"{S.r(c)} AS {c}")
        elif c in cnt:
            sel.append(f"{S.big(c)} AS {c}")
        else:
            sel.append(c)
    return S.feature_ctes(CFG) + "\nSELECT " + ", ".join(sel) + " FROM feat"


@query("order_features", _sql_features, "C")
def q_order_features(spark, sf):
    """One numeric feature row per order (flagship query)."""
    return round_doubles(features_frame(spark, sf).drop("full_text", "order_text"))


def _sql_make_freq():
    return S.with_(S.HDR) + f"""
SELECT {S.clean_make('make')} AS make_clean, count(*) AS make_freq FROM hdr GROUP BY 1"""


@query("make_frequency", _sql_make_freq, "C")
def q_make_frequency(spark, sf):
    """Make -> order count (unseen makes default to 1 at lookup)."""
    return P.make_frequency(V.headers(spark, sf))


def _sql_eda_features():
    ccs = CFG.cost_centers[:-1]
    cc = []
    for c in ccs:
        cc += [f"{S.r(f'coalesce(sum(CASE WHEN coalesce(cost_center, {chr(39)}{chr(39)}) = {S.q(c)} THEN t END), 0.0)')} AS time_{c}",
               f"{S.r(f'coalesce(sum(CASE WHEN coalesce(cost_center, {chr(39)}{chr(39)}) = {S.q(c)} THEN p END), 0.0)')} AS price_{c}",
               f"{S.big(f'count_if(coalesce(cost_center, {chr(39)}{chr(39)}) = {S.q(c)})')} AS n_{c}"]
    ratios = [f"{S.r(f'CASE WHEN sum(t) > 0 THEN coalesce(sum(CASE WHEN coalesce(cost_center, {chr(39)}{chr(39)}) = {S.q(c)} THEN t END), 0.0) / sum(t) ELSE 0.0 END')} AS ratio_{c}_time"
              for c in P.eda_ratio_ccs(CFG)]
    return S.with_(S.POS_RAW, S.HDR) + f"""
, pr AS (SELECT order_id, cost_center, coalesce(TRY_CAST(total_time AS DOUBLE), 0.0) AS t,
                coalesce(TRY_CAST(total_price AS DOUBLE), 0.0) AS p FROM pos_raw)
SELECT h.order_id, coalesce(h.make, 'unknown') AS make, g.* EXCLUDE (order_id)
FROM hdr h JOIN (
  SELECT order_id, count(*) AS n_positions, {S.big('count_if(p > 0 OR t > 0)')} AS n_useful,
         {S.big('count_if(t = 0)')} AS n_zero_time, {S.big('count_if(p = 0)')} AS n_zero_price,
         {S.r('sum(t)')} AS total_time_input, {S.r('sum(p)')} AS total_price_input,
         {S.r('max(t)')} AS max_time_pos, {S.r('avg(t)')} AS mean_time_pos,
         {S.r('max(p)')} AS max_price_pos, {S.r('avg(p)')} AS mean_price_pos,
         {', '.join(cc)}, {', '.join(ratios)}
  FROM pr GROUP BY order_id) g ON h.order_id = g.order_id"""


@query("eda_order_features", _sql_eda_features, "C")
def q_eda_order_features(spark, sf):
    """Profiling variant on raw rows."""
    return round_doubles(P.eda_order_features(V.positions(spark, sf), V.headers(spark, sf), CFG))


# ------------------------------------------------------------ targets
def _sql_targets_long():
    return S.with_(S.targets_wide(CFG), S.targets_long(CFG)) + "\nSELECT order_id, target, hours FROM tl"


@query("unpivot_targets", _sql_targets_long, "B")
def q_unpivot_targets(spark, sf):
    """Wide targets -> long (order_id, target, hours)."""
    return V.targets_long(spark, sf, CFG)


def _sql_targets_wide():
    return S.with_(S.targets_wide(CFG)) + "\nSELECT * FROM tw"


@query("pivot_targets", _sql_targets_wide, "B")
def q_pivot_targets(spark, sf):
    """Long -> wide with an explicit value list (no distinct pass)."""
    return L.pivot_targets(V.targets_long(spark, sf, CFG), CFG.targets)


def _sql_binarise():
    cols = ", ".join(f"CAST({t} > 0 AS INTEGER) AS {t}" for t in CFG.targets)
    return S.with_(S.targets_wide(CFG)) + f"\nSELECT order_id, {cols} FROM tw"


@query("binarise_targets", _sql_binarise, "B")
def q_binarise_targets(spark, sf):
    """Hours > 0 -> 1/0 per target."""
    return L.binarise(V.targets_wide(spark, sf, CFG), CFG.targets)


def _sql_rollups():
    act = " + ".join(f"CAST({t} > 0 AS INTEGER)" for t in CFG.targets)
    tot = " + ".join(CFG.targets)
    return S.with_(S.targets_wide(CFG)) + f"""
SELECT order_id, n_active,
       {S.r('total_hours')} AS total_hours,
       CASE WHEN n_active <= 3 THEN 'low' WHEN n_active <= 6 THEN 'medium'
            WHEN n_active <= 9 THEN 'high' ELSE 'very_high' END AS complexity
FROM (SELECT order_id, CAST({act} AS INTEGER) AS n_active, {tot} AS total_hours FROM tw)"""


@query("order_target_rollups", _sql_rollups, "C")
def q_order_target_rollups(spark, sf):
    """C10 n_active / total hours per order, C11 complexity band."""
    r = L.target_rollups(V.targets_wide(spark, sf, CFG), CFG.targets)
    return round_doubles(r.withColumn("complexity", L.complexity_band(F.col("n_active"))))


def _sql_align():
    cols = P.feature_columns(CFG)
    saved = ["total_time", "ratio_standard_time", "kw_anvil", "n_hail", "make_other"]
    sel = [f"{S.r(c) if c.startswith(('total', 'ratio')) else (S.big(c) if c.startswith('n_') else c)} AS {c}"
           if c in cols else f"0.0::DOUBLE AS {c}" for c in saved]
    return S.feature_ctes(CFG) + "\nSELECT order_id, " + ", ".join(sel) + " FROM feat"


@query("align_features", _sql_align, "B")
def q_align_features(spark, sf):
    """Re-index to a saved feature order; missing -> 0, extras dropped."""
    saved = ["total_time", "ratio_standard_time", "kw_anvil", "n_hail", "make_other"]
    f = features_frame(spark, sf)
    return round_doubles(L.align_features(f, saved, key="order_id"))


def _sql_clip():
    return S.with_(S.POS_RAW) + """
SELECT order_id, line_no, part_key, supp_key, greatest(0.0, total_price) AS clipped_price
FROM pos_raw"""


@query("clip_nonnegative", _sql_clip, "B")
def q_clip_nonnegative(spark, sf):
    """max(0, x) on the raw prices."""
    return V.positions(spark, sf).select("order_id", "line_no", "part_key", "supp_key",
                                         L.clip_nonnegative(F.col("total_price")).alias("clipped_price"))
